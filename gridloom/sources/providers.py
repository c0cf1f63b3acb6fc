"""What each operator's publication becomes: transforms of DataFrames, with the declared columns of each.

Two contracts differ on purpose: some project to their columns, others only require them and keep the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError
from ..functions import text
from ..functions import time as tf
from ..operators import contracts, quality, relational, reshape

# The columns of each source.
COLUMNS = {
    "entsoe": [
        "timestamp",
        "time_series.mkt_psrtype.power_system_resources.name",
        "time_series.mkt_psrtype.power_system_resources.m_rid.value",
        "time_series.mkt_psrtype.psr_type",
        "time_series.mkt_psrtype.power_system_resources.nominal_p",
        "time_series.period.point.quantity",
        "time_series.period.point.secondary_quantity",
        "time_series.quantity_measure_unit_name",
        "time_series.period.resolution",
    ],
    "aemo": "timestamp code name network_id network_region description location unit_code unit_fueltech_id unit_status_id unit_dispatch_type unit_capacity_registered unit_capacity_maximum unit_capacity_storage unit_data_first_seen unit_data_last_seen unit_commencement_date value".split(),
    "aeso": ["Date (MST)", "Date (MPT)", "Asset Short Name", "Asset Name", "Asset Grouping", "Volume", "Maximum Capability", "System Capability", "Fuel Type", "Sub Fuel Type", "Planning Area", "Region"],
    "cen": "id_opreal llave_opreal id_central central gen_real_mw fecha_hora hora potencia_maxima id_propietario propietario id_coordinado coordinado tipo_tecnologia subtipo_tecnologia factor_ernc alcance valor_ernc".split(),
    "eat": ["site_code", "poc_code", "nwk_code", "gen_code", "fuel_code", "tech_code", "trading_date", *[f"tp{i}" for i in range(1, 51)]],
    "eia": ["period", "respondent", "respondent-name", "fueltype", "type-name", "value", "value-units"],
    "epias": "date hour total powerPlantName naturalGas dammedHydro lignite river importCoal wind sun fueloil geothermal asphaltiteCoal blackCoal biomass naphta lng importExport wasteheat".split(),
    "ieso": ["Delivery Date", "Generator", "Fuel Type", "Measurement", *[f"Hour {h}" for h in range(1, 25)]],
    "ons": "din_instante id_subsistema nom_subsistema id_estado nom_estado cod_modalidadeoperacao nom_tipousina nom_tipocombustivel nom_usina id_ons ceg val_geracao".split(),
}
FUELS = {"adme": ["/", "Hidráulico", "Biomasa", "Térmico", "Eólico", "Solar"]}
SHEETS = {"adme": ["GPF", "Eólica", "Solar", "Térmica", "Biomasa"]}
REGIONS = {"rei": ["hokkaido", "tohoku", "tokyo", "chubu", "hokuriku", "kansai", "chugoku", "shikoku", "kyushu"]}
#: Hours that networks are ahead of UTC, without daylight saving, and the year their data begin.
NETWORKS, FIRST_YEAR = {"NEM": 10, "WEM": 8, "AU": 10}, 1998


def _in_order(ordered: bool, df: DataFrame, *columns: str) -> DataFrame:
    """Sorted, for a month or a day that is written as one file; a table of years has no use for a global sort."""
    return relational.sort_nulls_last(df, *columns) if ordered else df


def entsoe_records(series: DataFrame, keep: list[str]) -> DataFrame:
    """``period_start, resolution_minutes, points array<struct<position,quantity>>`` to stamped rows of points."""
    rows = series.select(*keep, "period_start", "resolution_minutes", F.inline("points"))
    return rows.withColumn("timestamp", F.col("period_start") + F.make_dt_interval(mins=((F.col("position") - 1) * F.col("resolution_minutes")).cast("int"))).drop("period_start")


def entsoe(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows with a production type and a unit's name or code, by time and name."""
    name, code, kind = COLUMNS["entsoe"][1:4]
    df = contracts.project(df, COLUMNS["entsoe"], "entsoe").filter(F.col(f"`{kind}`").isNotNull())
    return _in_order(ordered, df.filter(F.col(f"`{name}`").isNotNull() | F.col(f"`{code}`").isNotNull()), "timestamp", name)


def aemo_units(facilities: DataFrame) -> DataFrame:
    """Facilities with a row a unit, null-safe on what names a facility, tags stripped, with the unit's first year."""
    keys = ["code", "name", "network_region"]
    units = reshape.explode_records(facilities, "units", "unit_", keys)
    rows = relational.join_null_safe(facilities.drop("units"), units, keys)
    first = F.coalesce(F.year("unit_data_first_seen"), F.year("unit_commencement_date"), F.lit(FIRST_YEAR))
    return rows.withColumns({"description": text.strip_tags(F.col("description")), "start_year": first})


def aemo_start(first_seen, commencement):
    """Start of the year of a unit's first sign of life: of its data, else of its commencement, else of the market."""
    return tf.year_start(first_seen, commencement, default=F.lit(f"{FIRST_YEAR}-01-01"))


def aemo_offsets(network_id):
    """Hours ahead of UTC; an unknown network is an error when it is evaluated."""
    out = F.raise_error(F.concat(F.lit("unknown network "), F.coalesce(network_id, F.lit("null"))))
    for n, h in NETWORKS.items():
        out = F.when(network_id == n, F.lit(h)).otherwise(out.cast("int"))
    return out


def aemo(facts: DataFrame, units: DataFrame, ordered: bool = True) -> DataFrame:
    """Readings with their unit's columns; units without readings and readings of unknown units drop out."""
    joined = facts.select("timestamp", "unit_code", "value").join(units.withColumnRenamed("unit_unit_code", "unit_code"), "unit_code")
    return _in_order(ordered, contracts.project(joined, COLUMNS["aemo"], "aemo"), "timestamp")


def aemo_active(units: DataFrame, year: int) -> DataFrame:
    return units.filter(F.col("start_year") <= year)


def aeso(df: DataFrame, year: int, month: int, ordered: bool = True) -> DataFrame:
    """A month by local time; a stamp that cannot be read ends the job."""
    df = contracts.require(df, COLUMNS["aeso"], "aeso")
    raw = F.col("`Date (MPT)`")
    at = F.coalesce(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(raw), F.raise_error(F.concat(F.lit("no time: "), F.coalesce(raw, F.lit("null")))).cast("timestamp"))
    rows = df.withColumn("_at", at.cast("timestamp_ntz")).filter(tf.in_month(F.col("_at"), year, month)).drop("_at")
    return _in_order(ordered, rows, "Date (MST)", "Date (MPT)", "Asset Short Name")


def cen(df: DataFrame, ordered: bool = True) -> DataFrame:
    return _in_order(ordered, contracts.require(df, COLUMNS["cen"], "cen"), "fecha_hora")


def eat(df: DataFrame) -> DataFrame:
    return contracts.require(df.toDF(*[c.strip().lower() for c in df.columns]), COLUMNS["eat"], "eat")


def eat_long(df: DataFrame, zone: str = "Pacific/Auckland") -> DataFrame:
    """An extension: a row a half hour, with its UTC start; days have 46, 48 or 50 periods."""
    ids = COLUMNS["eat"][:7]
    long = reshape.melt(df.select(*COLUMNS["eat"]), ids, "period", "kwh", COLUMNS["eat"][7:]).filter(F.col("kwh").isNotNull())
    return long.withColumns({"period": F.substring("period", 3, 2).cast("int"), "start": tf.period_starts(F.to_date("trading_date"), F.substring("period", 3, 2).cast("int"), zone)})


def eia(df: DataFrame, end: str, ordered: bool = True) -> DataFrame:
    """A day from an inclusive range: the first hour of the next, ``end``, goes."""
    df = contracts.require(df, COLUMNS["eia"], "eia")
    return _in_order(ordered, df.filter(relational.differs(F.col("period"), end)), "period", "respondent", "fueltype")


def epias(*batches: DataFrame) -> DataFrame:
    return contracts.require(relational.union_by_name(*batches), COLUMNS["epias"], "epias")


def ieso(df: DataFrame, year: int, month: int, capability: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """A month without forecasts (a null measurement stays), with the capabilities, by date, generator, measurement."""
    df = relational.union_by_name(df, capability) if capability is not None else df
    df = contracts.require(df, COLUMNS["ieso"], "ieso").filter(relational.differs(F.col("Measurement"), "Forecast"))
    rows = df.filter(tf.in_month(F.to_timestamp_ntz(F.col("`Delivery Date`"), F.lit("yyyy-MM-dd")), year, month))
    return _in_order(ordered, rows, "Delivery Date", "Generator", "Measurement")


def ieso_yearly(wide: DataFrame, measurement: str) -> DataFrame:
    """The older layout, a column a generator, in the newer one."""
    if "DATE" not in [c.strip().upper() for c in wide.columns]:
        raise ContractError("ieso lacks ['DATE']")
    rows = reshape.standardise_hourly(wide, "DATE", "HOUR")
    rows = rows.withColumnRenamed("DATE", "Delivery Date").withColumns({"Fuel Type": F.lit(None).cast("string"), "Measurement": F.lit(measurement)})
    return reshape.reorder(rows, COLUMNS["ieso"])


def ons(df: DataFrame, year: int, month: int) -> DataFrame:
    df = contracts.require(df, COLUMNS["ons"], "ons")
    at = F.col("din_instante").cast("timestamp_ntz")
    return df.withColumn("din_instante", at).filter(tf.in_month(F.col("din_instante"), year, month))


def adme(long: DataFrame, year: int, month: int, fuels: list[str] | None = None) -> DataFrame:
    """``time`` (day first), ``group``, ``name``, ``value`` of the hours that end in a month, in the wanted fuels."""
    at = F.to_timestamp_ntz(F.col("time"), F.lit("dd-MM-yyyy HH:mm"))
    rows = long.filter(F.col("group").isin(fuels or FUELS["adme"])).withColumn("_at", at).filter(tf.in_month_by_end(F.col("_at"), year, month))
    return rows.withColumn("time", F.date_format("_at", "dd-MM-yyyy HH:mm")).drop("_at")


def adme_require(long: DataFrame) -> DataFrame:
    """Fails if a fuel is missing altogether."""
    if lacking := relational.members_missing(long, "group", FUELS["adme"][1:]):
        raise ContractError(f"adme lacks {lacking}")
    return long


def rei(doc: DataFrame, year: int, month: int, zone: str = "Asia/Tokyo") -> DataFrame:
    """A document of arrays to ``epoch, region, fuel, value, time`` of a month, declared regions only."""
    doc = contracts.require_keys(doc, "regions", REGIONS["rei"], "rei")
    uneven = F.exists(F.map_values("regions"), lambda fuels: F.exists(F.map_values(fuels), lambda a: F.size(a) != F.size("epochs")))
    doc = doc.withColumn("epochs", F.when(uneven, F.raise_error(F.lit("rei: arrays differ in length"))).otherwise(F.col("epochs")))
    rows = reshape.long_from_arrays(doc, "epochs", "regions").filter(F.col("region").isin(REGIONS["rei"]))
    return rows.withColumn("time", tf.epoch_in_zone(F.col("epoch"), zone)).filter(tf.in_month(F.col("time"), year, month))


def rei_resolution(rows: DataFrame) -> DataFrame:
    """``region, fuel, temporal_resolution`` from the commonest step; null if that is no known resolution."""
    g = quality.mode_gap(rows, ["region", "fuel"], "time", unit=1)
    return g.select("region", "fuel", tf.from_minutes(F.col("gap") / 60).alias("temporal_resolution"))


def unified(df: DataFrame, source: str, time: str, unit: str, value: str, to_mwh: float, end_minutes: int = 0) -> DataFrame:
    """An extension: ``source, time, unit, mwh`` with stamps at the start of their interval."""
    at = tf.interval_start(F.col(f"`{time}`"), end_minutes) if end_minutes else F.col(f"`{time}`")
    return df.select(F.lit(source).alias("source"), at.alias("time"), F.col(f"`{unit}`").cast("string").alias("unit"), (F.col(f"`{value}`").cast(T.DoubleType()) * to_mwh).alias("mwh"))
