"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Parts that the neighbours of a node are dealt to where they meet its least, so that no hub is one task's.
PARTS = 16


def _star(edges: DataFrame, to_smaller: bool) -> DataFrame:
    """Links each node's neighbours to the least of them and itself: larger ones (large star) or smaller ones."""
    if to_smaller:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    dealt = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("s"))
    joined = around.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int")).join(dealt, ["u", "s"])
    if to_smaller:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, v`` edges of long ids in any direction give ``node, component``, the component's least id, for each node
    of an edge. Self-loops and repeats are ignored. Ends when a round changes nothing; each is checkpointed."""
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    for _ in range(rounds):
        e = cut(_star(_star(e, False), True))
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
