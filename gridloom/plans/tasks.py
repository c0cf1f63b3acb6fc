"""Task plans as tables: which (date, resolution, zone) slices are wanted, which are done, what becomes of an attempt."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RequestError
from ..functions import time as tf

# Sources with the unit and resolutions of their plans and their first year.
SOURCES = """
entsoe day - 2014
eia day 1h 2019
epias day 1h 2013
cen day 1h 2000
adme month 1h 2009
aeso month 1h,5min 2015
ieso month 1h 2010
ons month 1h 2000
rei month - 2016
eat month 30min 1997
aemo mixed 1h,5min 1998
"""
#: Retries and waits in seconds: after server errors, and the n-th after a refusal.
RETRIES, PAUSE, REFUSALS = 3, 5, 6


def refusal_wait(n: int) -> int:
    return int(15 * n**1.5)


def identifier(date: Column, resolution: Column, zone: Column | None = None) -> Column:
    parts = [F.concat(F.lit("date="), date), F.concat(F.lit("temporal_resolution="), resolution)]
    return F.concat_ws("|", *parts, *([] if zone is None else [F.concat(F.lit("bidding_zone="), zone)]))


def with_identity(tasks: DataFrame) -> DataFrame:
    """Adds identifier, year and month to ``date, temporal_resolution, bidding_zone``."""
    zone = F.col("bidding_zone") if "bidding_zone" in tasks.columns else None
    return tasks.withColumns(
        {
            "identifier": identifier(F.col("date"), F.col("temporal_resolution"), zone),
            "year": F.substring("date", 1, 4).cast("int"),
            "month": F.when(F.length("date") > 4, F.substring("date", 6, 2).cast("int")),
        }
    )


def valid(tasks: DataFrame) -> DataFrame:
    """Fails on dates that no calendar has and on malformed resolutions."""
    bad = tasks.filter(~tf.valid_date(F.col("date")) | ~tf.valid_resolution(F.col("temporal_resolution"))).limit(5).collect()
    if bad:
        raise RequestError(f"no such tasks: {[(r['date'], r['temporal_resolution']) for r in bad]}")
    return tasks


def source_rules() -> dict[str, tuple[str, list[str], int]]:
    return {s: (unit, [] if res == "-" else res.split(","), int(first)) for s, unit, res, first in (x.split() for x in SOURCES.strip().splitlines())}


def source_plan(spark: SparkSession, source: str, years: list[int], today: dt.date, resolutions: list[str] | None = None, zones: DataFrame | None = None) -> DataFrame:
    """The tasks of a source, with identity: years before its first or after this one are dropped.

    A mixed source has months for its hourly and days for its five-minute tasks. Zones multiply a plan, and drop out
    of years before their start.
    """
    unit, known, first = source_rules()[source]
    if wrong := sorted(set(resolutions or []) - set(known)):
        raise RequestError(f"invalid resolutions {wrong}")
    chosen = resolutions or known or ["1h"]
    years = [y for y in years if first <= y <= today.year]
    if not years:
        raise RequestError(f"{source} has none of these years")
    parts = [tf.spine(spark, years, ("day" if r == "5min" else "month") if unit == "mixed" else unit, today).withColumn("temporal_resolution", F.lit(r)) for r in chosen]
    plan = parts[0]
    for p in parts[1:]:
        plan = plan.unionByName(p)
    if zones is not None:
        known_from = zones.select(F.col("zone").alias("bidding_zone"), "start")
        plan = plan.join(known_from, F.substring("date", 1, 4).cast("int") >= F.col("start")).drop("start")
    return with_identity(plan)


def remaining(plan: DataFrame, state: DataFrame) -> DataFrame:
    """Tasks that are not settled: those without status 1."""
    return plan.join(state.filter("status = 1").select("identifier").distinct(), "identifier", "left_anti")


def route(source: str, date: Column) -> Column:
    """Which of a source's two publications a month comes from."""
    split = {"adme": "2019-01", "ieso": "2019-05", "ons": "2022-01"}
    return F.when(date < split[source], F.lit("yearly")).otherwise(F.lit("monthly")) if source in split else F.lit("monthly")


def fiscal_source_year(date: Column) -> Column:
    """The year file, April to March, that a month of ``YYYY-MM`` is in."""
    return tf.fiscal_year(F.to_date(F.concat(date, F.lit("-01"))))


def outcome(kind: Column, code: Column, year: Column, this_year: int) -> tuple[Column, Column, Column]:
    """Status (1: settled, 0: again next time), waits and whether the run ends, for an attempt that ended in ``kind``:
    success, structure, invalid, missing, http (with a code), or anything else."""
    refused, client = code.isin(401, 429), (code >= 400) & (code < 500)
    status = F.when(kind == "success", 1).when(kind == "missing", F.when(year == this_year, 0).otherwise(1)).when((kind == "http") & client & ~refused, 1).otherwise(0)
    server = (kind == "timeout") | ((kind == "http") & (code.isNull() | (code >= 500)))
    waits = F.when((kind == "http") & refused, REFUSALS).when(server, RETRIES).otherwise(0)
    return status, waits, kind.isin("structure", "invalid")


def merge_state(state: DataFrame, attempts: DataFrame) -> DataFrame:
    """The latest status of each task: new attempts replace old ones, a settled task stays so."""
    both = state.select("identifier", "status").unionByName(attempts.select("identifier", "status"))
    return both.groupBy("identifier").agg(F.max("status").alias("status"))


def probe_dates(spark: SparkSession, zones: DataFrame, years: list[int], per_year: int) -> DataFrame:
    """One, two or three fixed days a year for each zone, to ask whether there are data."""
    if per_year not in (1, 2, 3):
        raise RequestError("one, two or three days a year")
    days = {1: ["12-15"], 2: ["03-15", "09-15"], 3: ["01-15", "06-15", "12-15"]}[per_year]  # fixed values
    dates = F.array(*[F.lit(f"{y}-{d}") for y in years for d in days]).cast("array<string>")
    return zones.select("zone", F.explode(dates).alias("date"))


def day_windows(plan: DataFrame, zones: DataFrame) -> DataFrame:
    """Daily tasks by zone with what is asked for, ``period_start`` and ``period_end`` as YYYYMMDDhhmm from 00:00 to 23:59;
    ``known`` is false where the year is before the zone's first, or the zone has none."""
    day = F.replace("date", F.lit("-"), F.lit(""))
    first = zones.select(F.col("zone").alias("bidding_zone"), F.col("start").alias("_start"))
    rows = plan.join(first, "bidding_zone", "left")
    known = F.coalesce(F.substring("date", 1, 4).cast("int") >= F.col("_start"), F.lit(False))
    return rows.withColumns({"period_start": F.concat(day, F.lit("0000")).cast("long"), "period_end": F.concat(day, F.lit("2359")).cast("long"), "known": known}).drop("_start")


def file_lookup(listing: DataFrame) -> DataFrame:
    """``temporal_resolution, date, id, name`` of a folder listing ``temporal_resolution, position, kind, id, name``: the
    months that a file's name holds, one or every one from the first to the second. A later file replaces an earlier one
    of a month; folders are left out, and a file name with no month, or more than two, is an error when it is read."""
    from ..operators.relational import keep_first
    from ..sources.readers import months_in_name

    name = F.col("name")
    found = F.regexp_count(name, F.lit(r"\d{4}-\d{2}(?=[^0-9])"))
    months = F.when(found.isin(1, 2), months_in_name(name)).otherwise(F.raise_error(F.concat(F.lit("no month or too many in "), name)))
    rows = listing.filter("kind = 'file'").select("temporal_resolution", F.explode(months).alias("date"), "position", "id", "name")
    return keep_first(rows.withColumn("_late", -F.col("position")), ["temporal_resolution", "date"], ["_late"]).drop("_late", "position")


def find_files(plan: DataFrame, lookup: DataFrame) -> DataFrame:
    """Tasks with the ``id`` and ``name`` of the file that holds them; ``kind`` is ``missing`` where there is none, as
    ``outcome`` takes it, else null."""
    rows = plan.join(lookup, ["temporal_resolution", "date"], "left")
    return rows.withColumn("kind", F.when(F.col("id").isNull(), F.lit("missing")))


def stored_as(plan: DataFrame, seen: DataFrame) -> DataFrame:
    """Tasks with the resolution that their data turned out to have (``identifier, temporal_resolution``), for the path
    they are written to; the identifier, by which their state is kept, stays that of the plan."""
    actual = seen.select("identifier", F.col("temporal_resolution").alias("_actual"))
    rows = plan.join(actual, "identifier", "left").withColumn("temporal_resolution", F.coalesce("_actual", "temporal_resolution"))
    return rows.select(*plan.columns)
