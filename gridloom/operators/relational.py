"""Joins, deduplication, unions and sorts with the null rules of the sources: null keys match, nulls sort last."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join on several keys where null matches null; the keys come once, from the left."""
    mark = {k: f"_r_{k}" for k in keys}
    right = right.select(*[F.col(f"`{c}`").alias(mark.get(c, c)) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{m}`")) for k, m in mark.items()])
    return left.join(right, on, how).drop(*mark.values())


def with_dimension(facts: DataFrame, dimension: DataFrame, key: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Facts with their dimension's columns, projected, and sorted if an order is given (a range shuffle of all facts).
    Spark broadcasts the dimension if it is small."""
    joined = facts.join(dimension, key).select(*columns)
    return sort_nulls_last(joined, *order) if order else joined


def sort_nulls_last(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in columns])


def align(parts: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Several series of one value by time, side by side: one column each, a row for any time in any of them.

    One union and one grouped aggregate, so one shuffle however many parts; a time comes once in each part.
    """
    long = reduce(DataFrame.unionByName, [p.select(key, F.lit(n).alias("_part"), F.col(value).alias("_value")) for n, p in parts.items()])
    return long.groupBy(key).agg(*[F.max(F.when(F.col("_part") == n, F.col("_value"))).alias(n) for n in parts])


def lookup_or_same(df: DataFrame, mapping: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """Replaces a column by what a mapping has for it, and keeps it where that has nothing."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return df.join(m, F.col(column) == F.col("_k"), "left").withColumn(column, F.coalesce("_v", column)).drop("_k", "_v")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by an explicit order, as Spark's rows have none of their own."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(name: str, *columns: tuple[DataFrame, str]) -> DataFrame:
    """The values of several columns as one column, each once; null is a value too."""
    return reduce(DataFrame.unionAll, [df.select(F.col(f"`{c}`").alias(name)).distinct() for df, c in columns]).distinct()


def differs(c: Column, value) -> Column:
    """Not equal, true for null."""
    return ~c.eqNullSafe(F.lit(value))


#: Ids that batches() takes as splitters; their number is fixed, so the driver gets no more.
SPLITTERS = 255


def batches(ids: DataFrame, column: str, size: int) -> DataFrame:
    """Adds ``batch``, from 1: as few as hold ``size`` each, of sizes that differ by one at most, the larger first.

    Ids are dealt to ranges between splitters (those of least hash), numbered there, and offset by the counts of the
    ranges before, so no task sorts them all. Splitters are literals: a task that runs again deals alike.
    """
    some = ids.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(F.xxhash64(column), column).limit(SPLITTERS).collect()
    splitters = F.array(*[F.lit(v) for v in sorted(r[0] for r in some)]) if some else F.array(F.lit(None))
    dealt = ids.withColumn("_p", F.size(F.filter(splitters, lambda s: F.coalesce(s <= F.col(column), F.lit(False)))))
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_c"))
    total = counts.agg(F.sum("_c")).first()[0] or 0
    if not total:
        return ids.withColumn("batch", F.lit(1))
    before = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_b"))
    n = -(-total // size)
    low, more = divmod(total, n)
    i = F.col("_b") + F.row_number().over(Window.partitionBy("_p").orderBy(column)) - 1
    batch = F.when(i < more * (low + 1), F.floor(i / (low + 1))).otherwise(more + F.floor((i - more * (low + 1)) / low))
    return dealt.join(before, "_p").withColumn("batch", (batch + 1).cast("int")).drop("_p", "_b")


def missing(wanted: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``wanted`` whose keys are unknown."""
    return wanted.join(known.select(*keys).distinct(), keys, "left_anti")


def distinct_in_order(df: DataFrame, column: str, position: str) -> DataFrame:
    """Each value once, with the first ``position`` it is seen at; null is a value too."""
    return df.groupBy(column).agg(F.min(position).alias(position))


def first_match(df: DataFrame, matches: Column, position: str) -> DataFrame:
    """The one row of least position that matches; none if none does."""
    return df.filter(matches).orderBy(position).limit(1)


def as_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """A small dimension as one row with one map; of repeated keys the least value, null keys drop out."""
    once = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    return once.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias("map"))


def members_missing(df: DataFrame, column: str, wanted: list[str]) -> list[str]:
    """Which of the wanted values a column lacks; only the wanted ones that are there come to the driver."""
    have = {r[0] for r in df.filter(F.col(column).isin(wanted)).select(column).distinct().collect()}
    return [w for w in wanted if w not in have]
