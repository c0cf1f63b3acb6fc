"""Plans and catalogues from the command line: ``python -m gridloom plan entsoe --years 2024 --state DIR``."""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from . import config
from .catalog import tables
from .errors import RequestError
from .plans import tasks, weather
from .sources import sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    kinds = p.add_subparsers(dest="what", required=True)
    plan = kinds.add_parser("plan", help="tasks of an energy source that are not settled; nothing is read (a dry run)")
    plan.add_argument("source", choices=sorted(tasks.source_rules()))
    plan.add_argument("--years", type=int, nargs="+", required=True)
    plan.add_argument("--zones", nargs="*", help="only these bidding zones")
    plan.add_argument("--resolutions", nargs="*")
    plan.add_argument("--state", help="folder of task states")
    plan.add_argument("--no-resume", action="store_true", help="settled tasks count too")
    grid = kinds.add_parser("weather", help="tasks of a reanalysis")
    grid.add_argument("source", choices=sorted(tables.DEFAULTS))
    grid.add_argument("--years", type=int, nargs="+", required=True)
    grid.add_argument("--variables", nargs="*", help="names or codes; by default those of the catalogue that are marked so")
    grid.add_argument("--pressure-levels", nargs="*")
    grid.add_argument("--model-levels", nargs="*")
    grid.add_argument("--area", type=float, nargs=4, metavar=("NORTH", "WEST", "SOUTH", "EAST"))
    grid.add_argument("--model", default="R2", choices=sorted(tables.BARRA_MODELS))
    grid.add_argument("--requests", action="store_true", help="what each task would ask for, and the file it goes to (a dry run)")
    listed = kinds.add_parser("variables", help="the variables of a reanalysis, by level type, with the default ones marked")
    listed.add_argument("source", choices=sorted(tables.DEFAULTS))
    kinds.add_parser("zones", help="bidding zones")
    for sub in (plan, grid):
        sub.add_argument("--today", type=dt.date.fromisoformat, default=dt.date.today())
        sub.add_argument("-o", "--options", action="append", default=[], help="overrides of the configuration, as a.b=value")
        sub.add_argument("--config", help="configuration file; urls.base is where a reanalysis is fetched from, paths.state the state folder")
    return p


def settings(a: argparse.Namespace) -> dict:
    """The configuration file, if there is one, with the overrides merged in."""
    return config.load(a.config, a.options) if a.config else config.parse_pairs(a.options)


def frame(spark: SparkSession, a: argparse.Namespace):
    if a.what == "zones":
        return tables.listing(tables.zones(spark), "start", "zone")
    if a.what == "variables":
        return tables.variables(spark, a.source)
    if a.what == "plan":
        zones = tables.zones(spark) if a.source == "entsoe" else None
        if zones is not None and a.zones:
            tables.validate(a.zones, zones, "zone", "zones")
            zones = zones.filter(zones.zone.isin(a.zones))
        state = a.state or settings(a).get("paths", {}).get("state")
        plan = tasks.source_plan(spark, a.source, a.years, a.today, a.resolutions, zones)
        return tasks.remaining(plan, sinks.read_state(spark, state)) if state and not a.no_resume else plan
    return _weather(spark, a, settings(a).get("urls", {}).get("base", ""))


def _weather(spark: SparkSession, a: argparse.Namespace, base: str):
    known = {"era5": tables.era5_variables, "icon": tables.icon_variables, "barra": tables.barra_variables}[a.source](spark)
    if a.source == "barra":
        known = tables.for_model(known, a.model)
    wanted = _codes(known, a.variables, tables.DEFAULTS[a.source])
    codes = [r["code"] for r in wanted]
    if a.source == "icon":
        plan = weather.icon_plan(spark, a.years, a.today, codes)
        return plan.select("*", weather.icon_url(base, "ICON-DREAM-EU").alias("url"), weather.icon_path("ICON-DREAM-EU").alias("path")) if a.requests else plan
    if a.source == "barra":
        of = lambda kind: [r["code"] for r in wanted if r["level_type"] == kind]
        levels = [int(x) for x in a.pressure_levels or []] or tables.BARRA_DEFAULT_LEVELS[a.model]
        tables.validate([str(x) for x in levels], tables.for_model(tables.barra_levels(spark), a.model), "level", "pressure levels")
        plan = weather.barra_plan(spark, a.years, a.today, of("single"), of("pressure"), levels, tables.BARRA_INVARIANT, a.model)
        return plan.select("*", weather.barra_url(base, a.model).alias("url"), weather.barra_path(a.model).alias("path")) if a.requests else plan
    plan = weather.era5_plan(spark, a.years, a.today, a.pressure_levels, a.model_levels)
    if not a.requests:
        return plan
    pressure, model = weather.default_levels(a.pressure_levels, a.model_levels)
    parts = []
    for kind in ("single", "pressure", "model"):
        if some := [r["code"] for r in wanted if r["level_type"] == kind]:
            levels, every = {"single": (None, []), "pressure": (pressure, tables.ERA5_PRESSURE_LEVELS), "model": (model, tables.ERA5_MODEL_LEVELS)}[kind]
            rows = weather.era5_requests(plan.filter(plan.level_type == kind), some, pressure, model, a.area)
            parts.append(rows.withColumn("path", weather.era5_path(some, levels, every)))
    if not parts:
        raise RequestError(f"none of {codes} has a level type of the plan")
    return reduce(DataFrame.unionByName, parts)


def _codes(known: DataFrame, names: list[str] | None, defaults: list[str]) -> list:
    """Rows of the catalogue for names or codes, in the order asked for; defaults that a model lacks are left out."""
    rows = known.select("variable", "code", "level_type").collect()  # a catalogue: some hundred rows
    if names:
        have = {r["variable"] for r in rows} | {r["code"] for r in rows}
        if bad := sorted(set(names) - have):
            raise RequestError(f"unknown variables: {bad}")
    chosen = list(dict.fromkeys(names or defaults))
    return [r for n in chosen for r in rows if n in (r["variable"], r["code"])]


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("gridloom").getOrCreate()
    frame(spark, a).show(1000, truncate=False)


if __name__ == "__main__":
    main()
