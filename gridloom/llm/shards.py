"""Sharding by proportional stratified interleaving. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows that one sorted bucket holds on average, and the fewest buckets.
BUCKET, LEAST = 20_000, 64


def interleave(rows: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """Adds ``frac, position, shard, slot`` to rows of ``doc_id, source, size, text_crc32``.

    The rows of each source are shuffled by a seeded hash (MD5 of seed, id and checksum, so that SQL can say it too); the r-th of n gets the fractional rank (r + 1/2) / n. All
    rows are sorted by it and cut into ``shards`` runs whose counts differ by one at most, so each holds the sources
    in proportion, to within one row a source. A null source is a source of its own. Equal rows are interchangeable.
    An empty table gives none.

    Neither the ranks in a source nor the global sort runs in one task: rows are dealt to buckets by hash, or by
    fractional rank, sorted there, and numbered from the sums of the buckets before. Only these sums are gathered.
    """
    total = rows.count()
    buckets = max(LEAST, -(-total // BUCKET))
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"))
    base = rows.select("doc_id", "source", "size", "text_crc32", F.md5(name).alias("h"))
    at = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")  # buckets are ranges of the hash, so that their order is its own
    base = base.withColumn("b", F.floor(at * buckets / 2**32).cast("long"))
    order = ("h", "doc_id", "text_crc32", "size")
    counts = base.groupBy("source", "b").agg(F.count("*").alias("c"))
    source = Window.partitionBy("source")
    counts = counts.select(F.col("source").alias("s_"), F.col("b").alias("b_"), (F.sum("c").over(source.orderBy("b")) - F.col("c")).alias("before"), F.sum("c").over(source).alias("n"))
    here = base.withColumn("r", F.row_number().over(Window.partitionBy("source", "b").orderBy(*order)))
    ranked = here.join(counts, F.col("source").eqNullSafe(F.col("s_")) & (F.col("b") == F.col("b_")))
    frac = (F.col("before") + F.col("r") - 0.5) / F.col("n")
    ranked = cut(ranked.select("doc_id", "source", "size", "text_crc32", "h", frac.alias("frac"), F.least(F.floor(frac * buckets), F.lit(buckets - 1)).alias("f")))
    sums = ranked.groupBy("f").agg(F.count("*").alias("c")).select(F.col("f").alias("f_"), (F.sum("c").over(Window.orderBy("f")) - F.col("c")).alias("before"))
    here = ranked.withColumn("r", F.row_number().over(Window.partitionBy("f").orderBy("frac", "source", *order)))
    placed = here.join(sums, F.col("f") == F.col("f_")).withColumn("position", F.col("before") + F.col("r") - 1)
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    placed = placed.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("slot", (F.col("position") - first).cast("long")).select("doc_id", "source", "size", "text_crc32", "frac", "position", "shard", "slot")
