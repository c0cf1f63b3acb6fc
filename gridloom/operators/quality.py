"""Continuity, completeness and availability of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gaps(df: DataFrame, keys: list[str], ts: str, seconds: Column | None = None) -> DataFrame:
    """Adds ``gap``: seconds since the row before in its series."""
    w = Window.partitionBy(*keys).orderBy(ts)
    sec = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6 if seconds is None else seconds
    return df.withColumn("gap", sec - F.lag(sec).over(w))


def mode_gap(df: DataFrame, keys: list[str], ts: str, unit: int = 60) -> DataFrame:
    """``keys, gap``: the commonest step of each series in whole units; of equally common ones the least."""
    g = gaps(df, keys, ts).filter("gap IS NOT NULL").select(*keys, F.floor(F.col("gap") / unit).cast("long").alias("gap"))
    return g.groupBy(*keys).agg(F.mode("gap", True).alias("gap"))


def continuity(df: DataFrame, keys: list[str], ts: str, position: str) -> DataFrame:
    """``keys, n, ordered``: rows of a series, and whether stamps never fall in order of position (two rows at least)."""
    w = Window.partitionBy(*keys).orderBy(position)
    steps = df.withColumn("_ok", F.coalesce(F.col(ts) >= F.lag(ts).over(w), F.lit(True)))
    return steps.groupBy(*keys).agg(F.count("*").alias("n"), (F.every("_ok") & (F.count("*") >= 2)).alias("ordered"))


def irregular(df: DataFrame, keys: list[str], ts: str, unit: int = 60) -> DataFrame:
    """Adds whether any step of a series differs from its commonest."""
    g = gaps(df, keys, ts).filter("gap IS NOT NULL").withColumn("gap", F.floor(F.col("gap") / unit).cast("long"))
    return g.groupBy(*keys).agg(F.mode("gap", True).alias("gap"), (F.min("gap") != F.max("gap")).alias("irregular"))


def tally(df: DataFrame, keys: list[str], counts: dict[str, Column], any_of: dict[str, Column], all_of: dict[str, Column]) -> DataFrame:
    """One row a key: how many rows meet a condition, whether any does, whether all do. A null condition is not met when it
    is counted and says nothing for any and all."""
    found = [F.count_if(c).alias(n) for n, c in counts.items()]
    return df.groupBy(*keys).agg(*found, *[F.bool_or(c).alias(n) for n, c in any_of.items()], *[F.every(c).alias(n) for n, c in all_of.items()])


def availability(probes: DataFrame, zone: str = "zone", date: str = "date", hit: str = "has_data", error: str = "status") -> DataFrame:
    """One row a zone: hits, misses, errors by kind, dates with data, first and last and their years (null without hits).

    One scan: probes are summed up by zone and kind of error, then these few rows by zone.
    """
    d, h = F.col(date), F.coalesce(F.col(hit), F.lit(False))
    kinds = probes.groupBy(zone, F.col(error).alias("_kind")).agg(
        F.count("*").alias("_n"),
        F.count_if(h).alias("_hits"),
        F.collect_list(F.when(h, d)).alias("_dates"),
        F.min(F.when(h, d)).alias("_first"),
        F.max(F.when(h, d)).alias("_last"),
    )
    error_row = F.when(F.col("_kind").isNotNull(), F.struct(F.col("_kind").alias(error), F.col("_n").alias("n")))
    stats = kinds.groupBy(zone).agg(
        (F.sum("_hits") > 0).alias("has_any_data"),
        F.sort_array(F.flatten(F.collect_list("_dates"))).alias("hit_dates"),
        F.sum("_hits").alias("n_hits"),
        F.sum(F.when(F.col("_kind").isNull(), F.col("_n") - F.col("_hits")).otherwise(0)).alias("n_misses"),
        F.min("_first").alias("first_hit"),
        F.max("_last").alias("last_hit"),
        F.map_from_entries(F.sort_array(F.collect_list(error_row))).alias("errors"),
    )
    year = lambda c: F.substring(c, 1, 4).cast("int")
    return stats.withColumns({"first_year": year("first_hit"), "last_year": year("last_hit")})


def zone_listing(stats: DataFrame, this_year: int) -> DataFrame:
    """Zones with data, by first year (none last) and name; ``end`` only if it is over."""
    rows = stats.filter("has_any_data").select("zone", F.col("first_year").alias("start"), F.when(F.col("last_year") != this_year, F.col("last_year")).alias("end"))
    return rows.orderBy(F.coalesce("start", F.lit(9999)), "zone")
