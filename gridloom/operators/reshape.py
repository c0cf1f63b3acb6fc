"""Wide to long, long to wide, nested to flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: list[str], name: str, value: str, columns: list[str] | None = None) -> DataFrame:
    """One row for each value column, nulls included."""
    return df.unpivot(ids, columns or [c for c in df.columns if c not in ids], name, value)


def hours_wide(long: DataFrame, keys: list[str], hour: str, value: str, hours: range = range(1, 25), position: list[str] | None = None) -> DataFrame:
    """A column ``Hour n`` for each hour. Repeated key and hour: the first by ``position`` counts. Groups without any
    value stay. The list of hours is fixed, so no job is needed to find it and the schema is stable."""
    here = lambda h, c: F.when(F.col(hour) == h, c)
    if position:
        order = F.struct(*[x for c in position for x in (F.col(c).isNull(), F.col(c))])
        cells = [F.min_by(F.col(value), here(h, order)) for h in hours]
    else:
        cells = [F.first(here(h, F.col(value)), ignorenulls=True) for h in hours]
    return long.groupBy(*keys).agg(*[c.alias(f"Hour {h}") for h, c in zip(hours, cells, strict=True)])


def standardise_hourly(wide: DataFrame, date: str, hour: str, hours: range = range(1, 25), drop: str = r"(?i)unnamed: *\d+") -> DataFrame:
    """Columns by generator, rows by date and hour, to rows by date and generator, columns by hour.

    Headers are upper-cased and nameless ones dropped; rows without a date go; of repeated hours the first stays.
    """
    import re

    wide = wide.toDF(*[c.strip().upper() for c in wide.columns])
    date, hour = date.upper(), hour.upper()
    wide = wide.select(*[f"`{c}`" for c in wide.columns if not re.fullmatch(drop, c)]).filter(F.col(date).isNotNull())
    long = melt(wide.withColumn("_at", F.monotonically_increasing_id()), [date, hour, "_at"], "Generator", "Value")
    return hours_wide(long, [date, "Generator"], hour, "Value", hours, ["_at"])


def explode_records(df: DataFrame, records: str, prefix: str, keep: list[str]) -> DataFrame:
    """A row for each struct of an array, its fields prefixed; empty or null arrays give none."""
    got = df.select(*keep, F.explode(records).alias("_r"))
    fields = df.schema[records].dataType.elementType.names
    return got.select(*keep, *[F.col(f"_r.`{f}`").alias(f"{prefix}{f}") for f in fields])


def flatten_points(df: DataFrame, series: str, results: str, data: str, keep: list[str]) -> DataFrame:
    """Three levels of arrays, series, results and points, to a row a point: ``keep``, fields of results, points."""
    flat = F.flatten(F.flatten(F.transform(series, lambda s: F.transform(s[results], lambda r: F.transform(r[data], lambda p: F.struct(r["unit_code"].alias("unit_code"), p.alias("point")))))))
    return df.select(*keep, F.inline(flat)).select(*keep, "unit_code", "point.*")


def long_from_arrays(df: DataFrame, epochs: str, regions: str, in_range: Column | None = None) -> DataFrame:
    """A document of arrays by region and fuel, aligned with ``epochs``, to rows ``epoch, region, fuel, value``."""
    rows = df.select(epochs, F.explode(regions).alias("region", "_fuels")).select(epochs, "region", F.explode("_fuels").alias("fuel", "_v"))
    rows = rows.select("region", "fuel", F.explode(F.arrays_zip(F.col(epochs).alias("epoch"), F.col("_v").alias("value"))).alias("z")).select("z.epoch", "region", "fuel", "z.value")
    return rows if in_range is None else rows.filter(in_range)


def slice_arrays(df: DataFrame, epochs: str, columns: list[str], first: Column, last: Column) -> DataFrame:
    """Cuts aligned arrays from the first to the last epoch in [first, last]; what lies between stays, matching or not."""
    inside = F.transform(epochs, lambda e: (e >= first) & (e <= last))
    at = F.array_position(inside, F.lit(True)).cast("int")
    length = F.size(epochs) - F.array_position(F.reverse(inside), F.lit(True)).cast("int") + 1 - at + 1
    cut = lambda c: F.when(at > 0, F.slice(c, at, length)).otherwise(F.slice(c, F.lit(1), F.lit(0)))
    return df.withColumns({c: cut(F.col(c)) for c in [epochs, *columns]})


def lengths_agree(epochs: Column, *arrays: Column) -> Column:
    out = F.lit(True)
    for a in arrays:
        out = out & F.coalesce(F.size(a) == F.size(epochs), F.lit(False))
    return out


def reorder(df: DataFrame, expected: list[str]) -> DataFrame:
    """Expected columns first, in their order, others after them in theirs."""
    return df.select(*[f"`{c}`" for c in [c for c in expected if c in df.columns] + [c for c in df.columns if c not in expected]])


def by_position(rows: DataFrame, column: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Arrays of strings to named columns."""
    return rows.select(*(keep or []), *[F.get(F.col(column), F.lit(i)).alias(n) for i, n in enumerate(names)])


def json_fields(df: DataFrame, column: str, fields: dict[str, str], default: str | None = None) -> DataFrame:
    """Adds a text column for each field of JSON documents, by its path; the default where a document lacks it."""
    get = lambda path: F.get_json_object(column, path) if default is None else F.coalesce(F.get_json_object(column, path), F.lit(default))
    return df.withColumns({name: get(path) for name, path in fields.items()})
