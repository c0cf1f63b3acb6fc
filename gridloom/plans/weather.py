"""Plans, requests and paths of gridded reanalyses. Grids themselves stay opaque files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import tables
from ..errors import RequestError
from ..functions import time as tf


def months(spark: SparkSession, years: list[int], today: dt.date, first: int) -> DataFrame:
    kept = sorted({y for y in years if first <= y <= today.year})
    if not kept:
        raise RequestError(f"no data for {years}")
    m = tf.spine(spark, kept, "month", today)
    return m.select(F.substring("date", 1, 4).alias("year"), F.substring("date", 6, 2).alias("month"))


def _each(df: DataFrame, name: str, values: list) -> DataFrame:
    """Each row with each of the values; none without any."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(str(v)) for v in values]).cast("array<string>")))


def default_levels(pressure: list | None, model: list | None) -> tuple[list | None, list | None]:
    """Neither given: the default pressure levels; an empty list: the defaults of its kind."""
    if pressure is None and model is None:
        pressure = []
    return (
        None if pressure is None else [str(x) for x in pressure] or tables.ERA5_DEFAULT_PRESSURE,
        None if model is None else [str(x) for x in model] or tables.ERA5_DEFAULT_MODEL,
    )


def era5_plan(spark: SparkSession, years: list[int], today: dt.date, pressure: list | None = None, model: list | None = None, first: int = 1940) -> DataFrame:
    pressure, model = default_levels(pressure, model)
    kinds = ["single", *(["pressure"] if pressure else []), *(["model"] if model else [])]
    return _each(months(spark, years, today, first), "level_type", kinds)


def barra_plan(spark: SparkSession, years: list[int], today: dt.date, single: list[str], pressure: list[str], levels: list[int], invariant: list[str], model: str) -> DataFrame:
    """Invariant fields once, then single-level, then pressure-level tasks; ``ord`` gives that order."""
    m = months(spark, years, today, tables.BARRA_MODELS[model][3])
    fixed = _each(spark.range(1), "variable", invariant).select(F.lit(0).alias("ord"), F.lit("fx").alias("year"), F.lit("fx").alias("month"), "variable", F.lit("").alias("level"))
    flat = _each(m, "variable", single).select(F.lit(1).alias("ord"), "year", "month", "variable", F.lit("").alias("level"))
    deep = _each(_each(m, "variable", pressure), "level", levels).select(F.lit(2).alias("ord"), "year", "month", "variable", "level")
    return fixed.unionByName(flat).unionByName(deep)


def icon_plan(spark: SparkSession, years: list[int], today: dt.date, variables: list[str], first: int = 2010) -> DataFrame:
    return _each(months(spark, years, today, first), "variable", variables)


def short_codes(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Names to codes; what is a code already stays."""
    from ..operators.relational import lookup_or_same

    return lookup_or_same(df, catalogue, "variable", "variable", "code")


def barra_path(model: str) -> Column:
    """Local name of a file; invariant ones have a folder of their own."""
    step = tables.BARRA_MODELS[model][2]
    dated = F.format_string(f"barra2_{model}_{step}_%s%s_%s%s.nc", "year", "month", "variable", "level")
    return F.when(F.col("year") == "fx", F.format_string(f"invariant/barra2_{model}_fx_%s.nc", "variable")).otherwise(dated)


def barra_url(base: str, model: str) -> Column:
    """Download address of a task; catalogue bases serve metadata under ``dodsC`` and files under ``fileServer``."""
    grid, label, step, _ = tables.BARRA_MODELS[model]
    root, stem = base.replace("/dodsC/", "/fileServer/").rstrip("/"), f"{grid}_ERA5_historical_hres_BOM_{label}_v1"
    code, month = F.concat("variable", "level"), F.concat("year", "month")
    dated = F.format_string(f"{root}/{step}/%s/latest/%s_{stem}_{step}_%s-%s.nc", code, code, month, month)
    return F.when(F.col("year") == "fx", F.format_string(f"{root}/fx/%s/latest/%s_{stem}.nc", "variable", "variable")).otherwise(dated)


def icon_path(label: str) -> Column:
    return F.format_string(f"{label}_%s%s_%s_hourly.grb", "year", "month", "variable")


def icon_url(base: str, label: str) -> Column:
    return F.concat(F.lit(f"{base.rstrip('/')}/"), "variable", F.lit("/"), icon_path(label))


def era5_path(codes: list[str], levels: list[str] | None, every: list[str]) -> Column:
    """Local name of a month's file: levels are named unless they are all there are."""
    some = f"_{'-'.join(levels)}" if levels and levels != every else ""
    kind = F.when(F.col("level_type") == "single", "sl").when(F.col("level_type") == "pressure", "pl").otherwise("ml")
    return F.format_string(f"era5_%s_%s_%s{some}_{'-'.join(codes)}.grib", "year", "month", kind)


def era5_requests(plan: DataFrame, codes: list[str], pressure: list[str] | None, model: list[str] | None, area: list[float] | None = None) -> DataFrame:
    """Adds ``dataset`` and ``request``, JSON for the archive's interface: lists of days and hours for single and
    pressure levels, slash-separated ranges for model levels. The key of the level type is ``leveltype``, as in the
    requests that this replaces; the archive's own documentation calls it ``levtype``."""
    first = F.to_date(F.concat_ws("-", "year", "month", F.lit("01")))
    days = tf.days_of_month(first)
    range_ = F.concat(F.date_format(first, "yyyy-MM-dd"), F.lit("/to/"), F.date_format(F.last_day(first), "yyyy-MM-dd"))
    texts = lambda xs: F.array(*[F.lit(str(x)) for x in xs])
    common = [F.lit("reanalysis").alias("product_type"), texts(codes).alias("variable"), F.array("year").alias("year"), F.array("month").alias("month"), days.alias("day"), tf.hours_of_day().alias("time"), F.lit("grib").alias("data_format"), F.lit("unarchived").alias("download_format")]
    box = [texts(area).alias("area")] if area else []
    single, deep = F.to_json(F.struct(*common, *box)), F.to_json(F.struct(*common, texts(pressure or []).alias("pressure_level"), *box))
    mars = [F.lit("ea").alias("class"), range_.alias("date"), F.lit("1").alias("expver"), F.lit("/".join(model or [])).alias("levellist"), F.lit("ml").alias("leveltype"), F.lit("/".join(codes)).alias("param"), F.lit("oper").alias("stream"), F.lit("/".join(f"{h:02d}:00:00" for h in range(24))).alias("time"), F.lit("an").alias("type")]
    mars += [F.lit("/".join(map(str, area))).alias("area")] if area else []
    kind = F.col("level_type")
    return plan.withColumns(
        {
            "dataset": F.when(kind == "model", "reanalysis-era5-complete").when(kind == "pressure", "reanalysis-era5-pressure-levels").otherwise("reanalysis-era5-single-levels"),
            "request": F.when(kind == "model", F.to_json(F.struct(*mars))).when(kind == "pressure", deep).otherwise(single),
        }
    )


def barra_variables(chosen: list[str] | None, defaults: list[str], of_model: list[str], invariant: list[str]) -> list[str]:
    """Given names, or the defaults that the model has, with the invariant fields; each once, in order."""
    names = chosen or [v for v in defaults if v in set(of_model)]
    return list(dict.fromkeys([*names, *invariant]))


def variables_by_level(plan: DataFrame, names: list[str], catalogue: DataFrame) -> DataFrame:
    """Adds ``variables`` and ``codes`` to tasks: those of the names that the task's level type has, in the order given.
    Tasks without any are left out: there is nothing to ask for."""
    wanted = plan.sparkSession.createDataFrame([(i, n) for i, n in enumerate(dict.fromkeys(names))], "i int, variable string")
    of = wanted.join(catalogue.select("variable", "code", "level_type"), "variable").groupBy("level_type").agg(F.sort_array(F.collect_list(F.struct("i", "variable", "code"))).alias("v"))
    take = lambda field: F.transform("v", lambda x: x[field])
    return plan.join(of, "level_type").select(*plan.columns, take("variable").alias("variables"), take("code").alias("codes"))
