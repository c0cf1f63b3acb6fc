"""Queries of providers, readers, sinks, plans and streams: each runs the library's own operator on the driver's tables."""

from __future__ import annotations

import datetime as dt
import io
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .catalog import tables
from .functions import text
from .functions import time as tf
from .operators import contracts, quality, relational, reshape
from .plans import tasks, weather
from .queries import query, t
from .sources import protocol, providers, readers, sinks
from .streaming import snapshots


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query writes and reads back, in the session's shared folder; local sessions may lack one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and the executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='gridloom-')).rstrip('/')}/query-{uuid.uuid4().hex}"


def _values(names: list[str], columns: dict) -> list:
    """A column for each declared name: what is given, else null."""
    return [columns.get(n, F.lit(None).cast("string")).alias(n) for n in names]


# Providers

_KIND = "CASE WHEN event_id % 5 > 0 THEN 'B' || (event_id % 7) END"


@query(f"""SELECT event_id AS id, stamp, name, code, kind FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, nullif(event_type, 'click') AS name,
  CASE WHEN user_id % 2 = 0 THEN 'u' || user_id END AS code, {_KIND} AS kind FROM events) WHERE kind IS NOT NULL AND (name IS NOT NULL OR code IS NOT NULL)""")
def entsoe_units(spark, d):
    stamp, name, code, kind, power, *_ = providers.COLUMNS["entsoe"]
    e = t(spark, d, "events").select(
        *_values(
            providers.COLUMNS["entsoe"],
            {
                stamp: F.col("ts"),
                name: F.nullif("event_type", F.lit("click")),
                code: F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))),
                kind: F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("B"), (F.col("event_id") % 7).cast("string"))),
                power: F.col("event_id"),
            },
        )
    )
    rows = providers.entsoe(e, ordered=False)
    return rows.select(F.col(f"`{power}`").alias("id"), F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.col(f"`{name}`").alias("name"), F.col(f"`{code}`").alias("code"), F.col(f"`{kind}`").alias("kind"))


def _facilities(spark, d) -> DataFrame:
    unit = F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("unit_code"),
        *[F.lit(None).cast("string").alias(n) for n in ("fueltech_id", "status_id", "dispatch_type", "capacity_registered", "capacity_maximum", "capacity_storage", "data_last_seen")],
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate")).alias("data_first_seen"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_commitdate") if "l_commitdate" in t(spark, d, "lineitem").columns else F.col("l_shipdate")).alias("commencement_date"),
    )
    units = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(unit).alias("units"))
    orders = t(spark, d, "orders").select(
        F.col("o_orderkey"),
        F.col("o_orderkey").cast("string").alias("code"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("name"),
        F.element_at(F.array(*[F.lit(n) for n in ("NEM", "WEM", "AU")]), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("network_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("network_region"),
        F.concat(F.lit("<p>"), "o_orderpriority", F.lit("</p>")).alias("description"),
        F.lit(None).cast("string").alias("location"),
    )
    return orders.join(units, orders.o_orderkey == units.l_orderkey).drop("o_orderkey", "l_orderkey")


_UNITS = """SELECT o_orderkey::VARCHAR AS code, l_orderkey || '-' || l_linenumber AS unit, o_orderpriority AS description,
  coalesce(CASE WHEN l_linenumber % 2 = 0 THEN year(l_shipdate) END, CASE WHEN l_linenumber % 3 = 0 THEN year(l_shipdate) END, 1998)::BIGINT AS start_year
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def _units(spark, d) -> DataFrame:
    return providers.aemo_units(_facilities(spark, d))


@query(_UNITS)
def aemo_units(spark, d):
    return _units(spark, d).select("code", F.col("unit_unit_code").alias("unit"), "description", F.col("start_year").cast("long").alias("start_year"))


@query(f"SELECT unit FROM ({_UNITS}) WHERE start_year <= 1996")
def aemo_active_units(spark, d):
    return providers.aemo_active(_units(spark, d), 1996).select(F.col("unit_unit_code").alias("unit"))


@query(f"""SELECT l_extendedprice AS value, u.unit, u.code FROM lineitem JOIN ({_UNITS}) u ON u.unit = l_orderkey || '-' || (l_linenumber + 1)""")
def aemo_readings(spark, d):
    """Each line reads for the unit of the next line number; the last line of an order reads for a unit that is unknown."""
    facts = t(spark, d, "lineitem").select(F.col("l_shipdate").alias("timestamp"), F.concat_ws("-", F.col("l_orderkey").cast("string"), (F.col("l_linenumber") + 1).cast("string")).alias("unit_code"), F.col("l_extendedprice").alias("value"))
    return providers.aemo(facts, _units(spark, d), ordered=False).select("value", F.col("unit_code").alias("unit"), "code")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 8 ELSE 10 END::BIGINT AS hours FROM customer")
def aemo_offsets(spark, d):
    network = F.element_at(F.array(*[F.lit(n) for n in ("NEM", "WEM", "AU")]), (F.col("c_custkey") % 3 + 1).cast("int"))
    return t(spark, d, "customer").select("c_custkey", providers.aemo_offsets(network).cast("long").alias("hours"))


@query("""SELECT event_id::VARCHAR AS volume, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events WHERE ts >= TIMESTAMP '2024-02-01' AND ts < TIMESTAMP '2024-03-01'""")
def aeso_month(spark, d):
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    e = t(spark, d, "events").select(*_values(providers.COLUMNS["aeso"], {"Date (MST)": at, "Date (MPT)": at, "Volume": F.col("event_id").cast("string")}))
    return providers.aeso(e, 2024, 2, ordered=False).select(F.col("Volume").alias("volume"), F.col("`Date (MPT)`").alias("at"))


@query("SELECT event_id::VARCHAR AS id, strftime(ts, '%Y-%m-%d') AS day FROM events ORDER BY 2, 1")
def cen_rows(spark, d):
    e = t(spark, d, "events").select(*_values(providers.COLUMNS["cen"], {"id_opreal": F.col("event_id").cast("string"), "fecha_hora": F.date_format("ts", "yyyy-MM-dd")}))
    return providers.cen(e).select(F.col("id_opreal").alias("id"), F.col("fecha_hora").alias("day"))


_EAT = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS trading_date FROM orders"


def _eat(spark, d) -> DataFrame:
    names = {n.upper() + " ": (F.col("o_orderkey").cast("string") if n == "site_code" else F.date_format("o_orderdate", "yyyy-MM-dd") if n == "trading_date" else F.lit(None).cast("string")) for n in providers.COLUMNS["eat"][:7]}
    periods = {f"TP{i}": F.when((F.col("o_orderkey") + i) % 10 == 0, F.lit(float(i))) for i in range(1, 51)}
    return providers.eat(t(spark, d, "orders").select(*[c.alias(n) for n, c in (names | periods).items()]))


@query(f"SELECT o_orderkey::VARCHAR AS site_code, trading_date, CASE WHEN (o_orderkey + 3) % 10 = 0 THEN 3.0 END::DOUBLE AS tp3 FROM ({_EAT})")
def eat_headers(spark, d):
    return _eat(spark, d).select("site_code", "trading_date", "tp3")


@query(f"""SELECT o_orderkey::VARCHAR AS site_code, i::BIGINT AS period, i::DOUBLE AS kwh,
  strftime(((trading_date::TIMESTAMP AT TIME ZONE 'Pacific/Auckland') AT TIME ZONE 'UTC') + INTERVAL 30 MINUTE * (i - 1), '%Y-%m-%d %H:%M') AS start
  FROM ({_EAT}), unnest(range(1, 51)) AS r(i) WHERE (o_orderkey + i) % 10 = 0""")
def eat_half_hours(spark, d):
    long = providers.eat_long(_eat(spark, d))
    return long.select("site_code", F.col("period").cast("long").alias("period"), "kwh", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"))


@query("""SELECT event_id AS value, strftime(ts, '%Y-%m-%dT%H') AS period FROM events WHERE strftime(ts, '%Y-%m-%dT%H') <> '2024-01-02T00'""")
def eia_day(spark, d):
    e = t(spark, d, "events").select(*_values(providers.COLUMNS["eia"], {"period": F.date_format("ts", "yyyy-MM-dd'T'HH"), "value": F.col("event_id")}))
    return providers.eia(e, "2024-01-02T00", ordered=False).select("value", "period")


@query("SELECT o_orderkey::VARCHAR AS \"powerPlantName\", o_totalprice AS total FROM orders UNION ALL SELECT 's' || s_suppkey, s_acctbal FROM supplier")
def epias_batches(spark, d):
    batch = lambda df, name, total: df.select(*_values(providers.COLUMNS["epias"], {"powerPlantName": name, "total": F.col(total)}))
    a = batch(t(spark, d, "orders"), F.col("o_orderkey").cast("string"), "o_totalprice")
    b = batch(t(spark, d, "supplier"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), "s_acctbal")
    return providers.epias(a, b).select("powerPlantName", "total")


_IESO = "CASE o_orderkey % 3 WHEN 0 THEN 'Forecast' WHEN 1 THEN 'Output' END"


@query(f"""SELECT o_orderkey::VARCHAR AS generator, strftime(o_orderdate, '%Y-%m-%d') AS day, {_IESO} AS measurement FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 5 AND o_orderkey % 3 > 0
UNION ALL SELECT 'cap' || o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), 'Capability' FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 5""")
def ieso_month(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey")
    form = lambda name, kind: t(spark, d, "orders").select(*_values(providers.COLUMNS["ieso"], {"Delivery Date": day, "Generator": name, "Measurement": kind}))
    out = form(k.cast("string"), F.when(k % 3 == 0, "Forecast").when(k % 3 == 1, "Output"))
    rows = providers.ieso(out, 1996, 5, form(F.concat(F.lit("cap"), k.cast("string")), F.lit("Capability")), ordered=False)
    return rows.select(F.col("Generator").alias("generator"), F.col("`Delivery Date`").alias("day"), F.col("Measurement").alias("measurement"))


_WIDE = "SELECT strftime(ts, '%Y-%m-%d') AS day, hour(ts) + 1 AS hour, event_type, min(event_id) AS v FROM events GROUP BY ALL"


@query(f"""SELECT day, upper(event_type) AS generator, {', '.join(f'max(v) FILTER (hour = {h})::BIGINT AS h{h}' for h in range(1, 25))}
FROM (SELECT d.day, z.event_type, w.hour, w.v FROM (SELECT DISTINCT day FROM ({_WIDE})) d CROSS JOIN (SELECT DISTINCT event_type FROM events) z LEFT JOIN ({_WIDE}) w ON w.day = d.day AND w.event_type = z.event_type) GROUP BY ALL""")
def ieso_wide_year(spark, d):
    e = t(spark, d, "events")
    kinds = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").collect()]  # a handful of generators, as columns
    wide = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("Date "), (F.hour("ts") + 1).alias("hour")).pivot("event_type", kinds).agg(F.min("event_id")).withColumn("unnamed: 7", F.lit(1).cast("long"))
    rows = providers.ieso_yearly(wide, "Output")
    return rows.select(F.col("`Delivery Date`").alias("day"), F.col("Generator").alias("generator"), *[F.col(f"`Hour {h}`").alias(f"h{h}") for h in range(1, 25)])


@query("""SELECT o_orderkey::VARCHAR AS usina, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 12""")
def ons_month(spark, d):
    o = t(spark, d, "orders").select(*_values(providers.COLUMNS["ons"], {"din_instante": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "nom_usina": F.col("o_orderkey").cast("string")}))
    return providers.ons(o, 1995, 12).select(F.col("nom_usina").alias("usina"), F.date_format("din_instante", "yyyy-MM-dd").alias("day"))


_FUELS = "['/', 'Hidráulico', 'Biomasa', 'Térmico', 'Eólico', 'Solar', 'Otro']"


@query(f"""SELECT event_id AS value, {_FUELS}[event_id % 7 + 1] AS "group", strftime(ts, '%d-%m-%Y %H:%M') AS time FROM events
WHERE event_id % 7 < 6 AND date_trunc('minute', ts) >= TIMESTAMP '2024-01-01 01:00' AND date_trunc('minute', ts) < TIMESTAMP '2024-02-01 01:00'""")
def adme_month(spark, d):
    fuel = F.element_at(F.array(*[F.lit(f) for f in [*providers.FUELS["adme"], "Otro"]]), (F.col("event_id") % 7 + 1).cast("int"))
    long = t(spark, d, "events").select(F.date_format("ts", "dd-MM-yyyy HH:mm").alias("time"), fuel.alias("group"), F.lit("MWh").alias("name"), F.col("event_id").alias("value"))
    return providers.adme(providers.adme_require(long), 2024, 1).select("value", "group", "time")


_REGIONS = ", ".join(f"'{r}'" for r in providers.REGIONS["rei"])


def _document(spark) -> DataFrame:
    epochs = F.sequence(F.lit(1709200000 // 1800 * 1800), F.lit(1709200000 // 1800 * 1800 + 1800 * 400), F.lit(1800)).cast("array<bigint>")
    place = {r: i for i, r in enumerate([*providers.REGIONS["rei"], "nowhere"])}
    fuel = lambda i, j: F.transform(F.col("epochs"), lambda e: (e % 1000 + 10 * i + j).cast("double"))
    regions = F.create_map(*[x for r, i in place.items() for x in (F.lit(r), F.create_map(F.lit("solar"), fuel(i, 1), F.lit("wind"), fuel(i, 2)))])
    return spark.range(1).select(epochs.alias("epochs")).withColumn("regions", regions)


@query(f"""SELECT e AS epoch, region, fuel, (e % 1000 + 10 * (list_position([{_REGIONS}], region) - 1) + j)::DOUBLE AS value, strftime(to_timestamp(e) AT TIME ZONE 'Asia/Tokyo', '%Y-%m-%d %H:%M') AS time
FROM unnest(range(1709200000 // 1800 * 1800, 1709200000 // 1800 * 1800 + 1800 * 400 + 1, 1800)) AS s(e), (SELECT unnest([{_REGIONS}]) AS region), (VALUES ('solar', 1), ('wind', 2)) AS f(fuel, j)
WHERE strftime(to_timestamp(e) AT TIME ZONE 'Asia/Tokyo', '%Y-%m') = '2024-03'""")
def rei_month(spark, d):
    return providers.rei(_document(spark), 2024, 3).select("epoch", "region", "fuel", "value", F.date_format("time", "yyyy-MM-dd HH:mm").alias("time"))


@query(f"SELECT region, fuel, '30min' AS temporal_resolution FROM (SELECT unnest([{_REGIONS}]) AS region), (VALUES ('solar'), ('wind')) AS f(fuel)")
def rei_resolutions(spark, d):
    return providers.rei_resolution(providers.rei(_document(spark), 2024, 3))


@query("SELECT 'events' AS source, strftime(ts - INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M') AS time, user_id::VARCHAR AS unit, value * 0.5 AS mwh FROM events")
def unified_readings(spark, d):
    return providers.unified(t(spark, d, "events"), "events", "ts", "user_id", "value", 0.5, 60).withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm"))


# Reshaping and contracts


@query("SELECT l_orderkey AS facility, l_linenumber::BIGINT AS unit_code, strftime(l_shipdate, '%Y-%m-%d') AS at, l_quantity AS mw FROM lineitem")
def flatten_series(spark, d):
    point = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("at"), F.col("l_quantity").alias("mw"))
    result = F.struct(F.col("l_linenumber").cast("long").alias("unit_code"), F.array(point).alias("data"))
    docs = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("facility")).agg(F.collect_list(result).alias("r")).select("facility", F.array(F.struct(F.col("r").alias("results"))).alias("series"))
    return reshape.flatten_points(docs, "series", "results", "data", ["facility"])


@query("SELECT vec_id, unnest(range(4))::BIGINT AS epoch, 'north' AS region, 'a' AS fuel, unnest(embedding[1:4])::DOUBLE AS value FROM embeddings")
def long_from_aligned_arrays(spark, d):
    values = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    e = t(spark, d, "embeddings").select("vec_id", F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")).alias("epochs"), F.create_map(F.lit("north"), F.create_map(F.lit("a"), values)).alias("regions"))
    named = e.select(F.col("epochs"), F.transform_keys("regions", lambda k, v: F.concat(k, F.lit("|"), F.col("vec_id").cast("string"))).alias("regions"))
    rows = reshape.long_from_arrays(named, "epochs", "regions")
    at = F.split("region", r"\|")
    return rows.select(at[1].cast("long").alias("vec_id"), "epoch", at[0].alias("region"), "fuel", "value")


@query("SELECT c_name, c_custkey, c_mktsegment FROM customer")
def expected_columns_first(spark, d):
    df = reshape.reorder(t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name"), ["c_name", "absent", "c_custkey"])
    assert df.columns == ["c_name", "c_custkey", "c_mktsegment"]
    return df


@query("SELECT doc_id, string_split(text, ' ')[1] AS first, string_split(text, ' ')[3] AS third FROM documents WHERE text IS NOT NULL")
def columns_by_position(spark, d):
    rows = t(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.split("text", " ", -1).alias("row"))
    return reshape.by_position(rows, "row", ["first", "_", "third"], ["doc_id"]).drop("_")


@query("SELECT doc_id, len(string_split(text, ' ')) <> 50 AS differs FROM documents")
def arity_check(spark, d):
    return t(spark, d, "documents").select("doc_id", F.coalesce(F.split("text", " ", -1), F.lit(None)).alias("row")).select("doc_id", contracts.arity_differs("row", 50).alias("differs"))


@query("SELECT c_custkey, c_name AS a, c_mktsegment AS b FROM customer")
def declared_keys(spark, d):
    docs = t(spark, d, "customer").select("c_custkey", F.create_map(F.lit("a"), "c_name", F.lit("b"), "c_mktsegment").alias("doc"))
    return contracts.require_keys(docs, "doc", ["a", "b"]).select("c_custkey", F.col("doc")["a"].alias("a"), F.col("doc")["b"].alias("b"))


@query("SELECT count(*) AS kept, (SELECT count(*) FROM customer WHERE c_nationkey = 3) AS dropped FROM customer WHERE c_nationkey <> 3")
def counted_null_rows(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"))
    both = rows.agg(F.count("*").alias("n"))
    return contracts.counted_drop_null(rows, "nation", f"nation-{uuid.uuid4().hex}").agg(F.count("*").alias("kept")).crossJoin(both).select("kept", (F.col("n") - F.col("kept")).alias("dropped"))


@query("SELECT l_returnflag, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1")
def first_seen_values(spark, d):
    return relational.distinct_in_order(t(spark, d, "lineitem").select("l_returnflag", "l_orderkey"), "l_returnflag", "l_orderkey")


@query("SELECT event_id, event_type, value FROM events WHERE value > 90 ORDER BY event_id LIMIT 1")
def first_match(spark, d):
    return relational.first_match(t(spark, d, "events").select("event_id", "event_type", "value"), F.col("value") > 90, "event_id")


@query("SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def nations_by_map(spark, d):
    lookup = relational.as_map(t(spark, d, "nation"), "n_nationkey", "n_name")  # one row, one map of some nations
    return t(spark, d, "customer").crossJoin(lookup).select("c_custkey", F.col("map")[F.col("c_nationkey")].alias("nation"))


@query("SELECT * FROM (VALUES ('X'), ('Y')) AS m(member)")
def members_that_are_missing(spark, d):
    flags = relational.members_missing(t(spark, d, "lineitem"), "l_returnflag", ["A", "X", "R", "Y"])
    return spark.createDataFrame([(f,) for f in flags], "member string")


@query("""SELECT min(c_custkey) AS a, max(c_custkey) AS z, count(*) AS n FROM (SELECT c_custkey, ntile((SELECT ceil(count(*) / 400)::BIGINT FROM customer)) OVER (ORDER BY c_custkey) AS b FROM customer) GROUP BY b""")
def bulk_lookup(spark, d):
    """One call for each near-equal batch of ids; what comes back is counted."""
    rows = readers.fetch_batches(t(spark, d, "customer").select("c_custkey"), "c_custkey", 400, lambda ids: [(ids[0], ids[-1], len(ids))], "a long,z long,n long")
    return rows


# Time and text


@query("SELECT p_partkey, CASE WHEN p_size = 60 THEN '1h' WHEN p_size BETWEEN 1 AND 59 THEN p_size || 'min' END AS name FROM part")
def minutes_named(spark, d):
    return t(spark, d, "part").select("p_partkey", tf.from_minutes(F.col("p_size").cast("double")).alias("name"))


@query("""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS tomorrow, strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS month,
  strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') AS period FROM orders""")
def date_steps(spark, d):
    form = lambda c: F.date_format(c, "yyyy-MM-dd")
    o = F.col("o_orderdate")
    return t(spark, d, "orders").select("o_orderkey", form(tf.next_day(o)).alias("tomorrow"), form(tf.next_month(o)).alias("month"), tf.next_period(F.date_format(o, "yyyy-MM")).alias("period"))


@query("SELECT event_id, strftime((ts AT TIME ZONE 'Asia/Taipei') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc FROM events")
def zone_attached(spark, d):
    return t(spark, d, "events").select("event_id", F.date_format(tf.attach_zone(F.col("ts"), "Asia/Taipei"), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm' END AS short FROM customer")
def alias_lookup(spark, d):
    return t(spark, d, "customer").select("c_custkey", text.alias_of(F.concat(F.lit(" "), F.lower("c_mktsegment")), {"Building": "b", "Machinery": "m"}).alias("short"))


@query("SELECT page_id, CASE WHEN len(l) > 0 THEN l ELSE ['fallback'] END::VARCHAR AS names FROM (SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, 'href=\"/(Z[A-Za-z]+)\"', 1))) AS l FROM pages)")
def directory_with_fallback(spark, d):
    names = readers.variables_in_page(F.col("html"), ["fallback"], r'href="/(Z[A-Za-z]+)"')
    return t(spark, d, "pages").select("page_id", F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")).alias("names"))


# Plans

_TODAY = dt.date(2024, 3, 4)
_DAYS = "unnest(generate_series(TIMESTAMP '{0}', TIMESTAMP '{1}', INTERVAL 1 {2})) AS s(g)"


@query(f"""SELECT 'eia' AS source, strftime(g, '%Y-%m-%d') AS date, '1h' AS temporal_resolution FROM {_DAYS.format('2023-01-01', '2024-03-03', 'DAY')}
UNION ALL SELECT 'eat', strftime(g, '%Y-%m'), '30min' FROM {_DAYS.format('2023-01-01', '2024-03-01', 'MONTH')}
UNION ALL SELECT 'aemo', strftime(g, '%Y-%m'), '1h' FROM {_DAYS.format('2023-01-01', '2024-03-01', 'MONTH')}
UNION ALL SELECT 'aemo', strftime(g, '%Y-%m-%d'), '5min' FROM {_DAYS.format('2023-01-01', '2024-03-03', 'DAY')}""")
def source_plans(spark, d):
    parts = [tasks.source_plan(spark, s, [2023, 2024, 2025], _TODAY).select(F.lit(s).alias("source"), "date", "temporal_resolution") for s in ("eia", "eat", "aemo")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _zones(spark, d) -> DataFrame:
    return t(spark, d, "nation").select(F.col("n_name").alias("zone"), (F.lit(2014) + F.col("n_nationkey")).cast("int").alias("start"))


@query(f"""SELECT n_name AS bidding_zone, strftime(g, '%Y-%m-%d') AS date, strftime(g, '%Y%m%d0000')::BIGINT AS period_start, strftime(g, '%Y%m%d2359')::BIGINT AS period_end, year(g) >= 2014 + n_nationkey AS known
FROM nation, {_DAYS.format('2023-12-01', '2024-03-03', 'DAY')}""")
def day_windows(spark, d):
    days = tf.spine(spark, [2023, 2024], "day", _TODAY).filter("date >= '2023-12-01'")
    plan = days.crossJoin(_zones(spark, d).select(F.col("zone").alias("bidding_zone")))
    return tasks.day_windows(plan, _zones(spark, d)).select("bidding_zone", "date", "period_start", "period_end", "known")


@query(f"""SELECT n_name AS bidding_zone, strftime(g, '%Y-%m-%d') AS date FROM nation, {_DAYS.format('2023-01-01', '2024-03-03', 'DAY')} WHERE year(g) >= 2014 + n_nationkey""")
def zoned_plan(spark, d):
    return tasks.source_plan(spark, "entsoe", [2023, 2024], _TODAY, None, _zones(spark, d)).select("bidding_zone", "date")


_FILES = """SELECT o_orderkey AS position, 'data ' || strftime(o_orderdate, '%Y-%m') || CASE WHEN o_orderkey % 5 = 0 THEN ' to ' || strftime(date_trunc('month', o_orderdate) + INTERVAL 2 MONTH, '%Y-%m') ELSE '' END || '.zip' AS name,
  unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', o_orderdate) + CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL 2 MONTH ELSE INTERVAL 0 MONTH END, INTERVAL 1 MONTH)) AS m FROM orders WHERE o_orderkey % 4 > 0"""
_LOOKUP = f"SELECT strftime(m, '%Y-%m') AS date, max(position) AS position, arg_max(name, position) AS name FROM ({_FILES}) GROUP BY 1"


def _lookup(spark, d) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    later = F.concat(F.lit(" to "), tf.next_period(tf.next_period(month)))
    name = F.concat(F.lit("data "), month, F.when(F.col("o_orderkey") % 5 == 0, later).otherwise(""), F.lit(".zip"))
    kind = F.when(F.col("o_orderkey") % 4 > 0, "file").otherwise("folder")
    return tasks.file_lookup(t(spark, d, "orders").select(F.lit("1h").alias("temporal_resolution"), F.col("o_orderkey").alias("position"), kind.alias("kind"), F.col("o_orderkey").cast("string").alias("id"), name.alias("name")))


@query(f"SELECT date, position::VARCHAR AS id, name FROM ({_LOOKUP})")
def folder_listing(spark, d):
    return _lookup(spark, d).select("date", "id", "name")


@query(f"""SELECT strftime(g, '%Y-%m') AS date, l.position::VARCHAR AS id, CASE WHEN l.position IS NULL THEN 'missing' END AS kind FROM {_DAYS.format('1990-01-01', '2000-12-01', 'MONTH')} LEFT JOIN ({_LOOKUP}) l ON l.date = strftime(g, '%Y-%m')""")
def files_of_tasks(spark, d):
    plan = tasks.with_identity(tf.spine(spark, list(range(1990, 2001)), "month", _TODAY).withColumn("temporal_resolution", F.lit("1h")))
    return tasks.find_files(plan, _lookup(spark, d)).select("date", "id", "kind")


@query("""SELECT 'date=' || strftime(o_orderdate, '%Y-%m-%d') || '|temporal_resolution=1h|bidding_zone=' || o_orderkey AS identifier,
  CASE WHEN o_orderkey % 3 = 0 THEN '30min' ELSE '1h' END || '/' || o_orderkey || '/' || strftime(o_orderdate, '%Y-%m-%d') AS path FROM orders""")
def stored_resolutions(spark, d):
    plan = tasks.with_identity(t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("1h").alias("temporal_resolution"), F.col("o_orderkey").cast("string").alias("bidding_zone")))
    seen = plan.filter("cast(bidding_zone AS long) % 3 = 0").select("identifier", F.lit("30min").alias("temporal_resolution"))
    return tasks.stored_as(plan, seen).select("identifier", sinks.task_path().alias("path"))


@query("""SELECT o_orderkey, (year(o_orderdate) - (month(o_orderdate) < 4)::INTEGER)::BIGINT AS file_year FROM orders""")
def fiscal_files(spark, d):
    return t(spark, d, "orders").select("o_orderkey", tasks.fiscal_source_year(F.date_format("o_orderdate", "yyyy-MM")).cast("long").alias("file_year"))


@query("SELECT i AS n, floor(15 * i ** 1.5)::BIGINT AS seconds FROM unnest(range(1, 7)) AS r(i)")
def refusal_waits(spark, d):
    return spark.createDataFrame([(n, tasks.refusal_wait(n)) for n in range(1, tasks.REFUSALS + 1)], "n long, seconds long")


# Reanalyses

_MONTHS = _DAYS.format("2023-01-01", "2024-02-01", "MONTH")
_BARRA = f"""SELECT 0 AS ord, 'fx' AS year, 'fx' AS month, v AS variable, '' AS level FROM (VALUES ('orog'), ('sftlf')) AS f(v)
UNION ALL SELECT 1, strftime(g, '%Y'), strftime(g, '%m'), v, '' FROM {_MONTHS}, (VALUES ('tas'), ('pr')) AS f(v)
UNION ALL SELECT 2, strftime(g, '%Y'), strftime(g, '%m'), 'ta', l FROM {_MONTHS}, (VALUES ('1000'), ('950')) AS f(l)"""


def _barra(spark) -> DataFrame:
    return weather.barra_plan(spark, [2023, 2024], dt.date(2024, 3, 1), ["tas", "pr"], ["ta"], [1000, 950], tables.BARRA_INVARIANT, "R2")


@query(f"SELECT ord::BIGINT AS ord, year, month, variable, level FROM ({_BARRA})")
def barra_plan(spark, d):
    return _barra(spark).withColumn("ord", F.col("ord").cast("long"))


@query(f"""SELECT CASE WHEN year = 'fx' THEN 'invariant/barra2_R2_fx_' || variable || '.nc' ELSE 'barra2_R2_1hr_' || year || month || '_' || variable || level || '.nc' END AS path,
  'https://host/thredds/fileServer/v1/' || CASE WHEN year = 'fx' THEN 'fx/' || variable || '/latest/' || variable || '_AUS-11_ERA5_historical_hres_BOM_BARRA-R2_v1.nc'
  ELSE '1hr/' || variable || level || '/latest/' || variable || level || '_AUS-11_ERA5_historical_hres_BOM_BARRA-R2_v1_1hr_' || year || month || '-' || year || month || '.nc' END AS url FROM ({_BARRA})""")
def barra_files(spark, d):
    return _barra(spark).select(weather.barra_path("R2").alias("path"), weather.barra_url("https://host/thredds/dodsC/v1", "R2").alias("url"))


@query(f"SELECT strftime(g, '%Y%m') AS month, code, 'https://host/x/' || code || '/ICON_' || strftime(g, '%Y%m') || '_' || code || '_hourly.grb' AS url FROM {_MONTHS}, (VALUES ('T'), ('PMSL')) AS f(code)")
def icon_files(spark, d):
    plan = weather.short_codes(weather.icon_plan(spark, [2023, 2024], dt.date(2024, 3, 1), ["temperature", "PMSL"]), tables.icon_variables(spark))
    return plan.select(F.concat("year", "month").alias("month"), F.col("variable").alias("code"), weather.icon_url("https://host/x/", "ICON").alias("url"))


_ERA = f"SELECT g, k FROM {_MONTHS}, (VALUES ('single'), ('pressure'), ('model')) AS l(k)"


def _era(spark) -> DataFrame:
    return weather.era5_plan(spark, [2023, 2024], dt.date(2024, 3, 1), ["1000"], ["137"])


@query(f"""SELECT strftime(g, '%Y%m') AS month, k AS level_type, CASE k WHEN 'single' THEN 'reanalysis-era5-single-levels' WHEN 'pressure' THEN 'reanalysis-era5-pressure-levels' ELSE 'reanalysis-era5-complete' END AS dataset,
  CASE k WHEN 'model' THEN strftime(g, '%Y-%m-01/to/') || strftime(last_day(g), '%Y-%m-%d') END AS span, CASE WHEN k <> 'model' THEN day(last_day(g))::BIGINT END AS n_days,
  CASE k WHEN 'model' THEN 'ml' END AS kind, CASE k WHEN 'model' THEN '137' END AS levels, CASE k WHEN 'pressure' THEN '["1000"]' END AS pressure,
  'era5_' || strftime(g, '%Y_%m') || '_' || CASE k WHEN 'single' THEN 'sl' WHEN 'pressure' THEN 'pl' ELSE 'ml' END || '_t-q.grib' AS path FROM ({_ERA})""")
def era5_requests(spark, d):
    rows = weather.era5_requests(_era(spark), ["t", "q"], ["1000"], ["137"], [10.0, 0.0, -10.0, 20.0]).withColumn("path", weather.era5_path(["t", "q"], None, []))
    of = lambda name: F.get_json_object("request", f"$.{name}")
    days = F.when(F.col("level_type") != "model", F.json_array_length(of("day")).cast("long"))
    return rows.select(F.concat("year", "month").alias("month"), "level_type", "dataset", of("date").alias("span"), days.alias("n_days"), of("leveltype").alias("kind"), of("levellist").alias("levels"), of("pressure_level").alias("pressure"), "path")


@query(f"SELECT strftime(g, '%Y%m') AS month, k AS level_type, CASE k WHEN 'single' THEN '2t' WHEN 'pressure' THEN 't,r' ELSE 't' END AS codes FROM ({_ERA})")
def variables_by_level(spark, d):
    rows = weather.variables_by_level(_era(spark), ["temperature", "2m_temperature", "relative_humidity", "temperature"], tables.era5_variables(spark))
    return rows.select(F.concat("year", "month").alias("month"), "level_type", F.array_join("codes", ",").alias("codes"))


@query("SELECT * FROM (VALUES ('era5', 21, 61), ('icon', 25, 25), ('barra', 42, 127)) AS v(source, defaults, n)")
def catalogue_listing(spark, d):
    one = lambda s: tables.variables(spark, s).agg(F.lit(s).alias("source"), F.count_distinct(F.when(F.col("is_default"), F.col("variable"))).alias("defaults"), F.count("*").alias("n"))
    return one("era5").unionByName(one("icon")).unionByName(one("barra"))


# Sinks and readers: written and read back


@query("SELECT event_id, event_type, value FROM events")
def csv_round_trip(spark, d):
    to = scratch(spark)
    sinks.save(t(spark, d, "events").select("event_id", "event_type", "value"), to, "csv", [])
    return readers.load(spark, to, "csv", "event_id long, event_type string, value double")


@query("SELECT event_id, event_type AS bidding_zone, strftime(ts, '%Y-%m') AS date FROM events")
def partitioned_round_trip(spark, d):
    to = scratch(spark)
    rows = t(spark, d, "events").select("event_id", F.col("event_type").alias("bidding_zone"), F.date_format("ts", "yyyy-MM").alias("date"))
    sinks.save(rows, to, "parquet")
    sinks.save(rows.filter("date = '2024-02'"), to, "parquet")  # replaces its own partitions only
    return spark.read.option("basePath", to).schema("event_id long, bidding_zone string, date string").parquet(to)


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '1h' ELSE '15min' END AS temporal_resolution, (SELECT count(*) FROM customer WHERE c_custkey % 3 = 2) AS dropped FROM customer WHERE c_custkey % 3 <> 2")
def split_by_resolution(spark, d):
    to = scratch(spark)
    rows = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "PT60M").when(F.col("c_custkey") % 3 == 1, "PT15M").alias("raw"))
    dropped = sinks.split_by_resolution(rows, "raw", to, "parquet")
    return spark.read.schema("c_custkey long, temporal_resolution string").parquet(to).withColumn("dropped", F.lit(dropped).cast("long"))


@query("SELECT n_nationkey, i AS step, CASE WHEN n_nationkey % 2 = 0 THEN '30min' ELSE '1h' END AS temporal_resolution FROM nation, unnest(range(5)) AS r(i)")
def routed_by_step(spark, d):
    to = scratch(spark)
    minutes = F.when(F.col("n_nationkey") % 2 == 0, 30).otherwise(60)
    rows = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("step"))
    rows = rows.withColumn("time", F.lit("2024-04-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("step") * minutes).cast("int")))
    sinks.save_by_step(rows, ["n_nationkey"], "time", to, "json")
    return spark.read.schema("n_nationkey long, step long, temporal_resolution string").json(to)


@query("SELECT 'task' || o_orderkey AS identifier, (o_orderkey % 3 = 0 OR o_orderkey % 2 = 0)::BIGINT AS status FROM orders")
def state_versions(spark, d):
    to = scratch(spark)
    state = lambda n: t(spark, d, "orders").select(F.concat(F.lit("task"), F.col("o_orderkey").cast("string")).alias("identifier"), (F.col("o_orderkey") % n == 0).cast("int").alias("status"))
    sinks.write_state(state(3), to)
    sinks.write_state(tasks.merge_state(sinks.read_state(spark, to), state(2)), to)
    return sinks.read_state(spark, to).withColumn("status", F.col("status").cast("long"))


@query("SELECT event_id, event_type FROM events")
def preamble_csv(spark, d):
    to = scratch(spark)
    lines = t(spark, d, "events").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("r")).select(F.concat(F.lit("a title\nmore words\nid,kind\n"), F.array_join(F.transform("r", lambda x: F.concat_ws(",", x["event_id"].cast("string"), x["event_type"])), "\n")).alias("value"))
    lines.write.option("lineSep", "\n").text(to)  # one file: the layout under test is a whole file's
    return readers.csv_after_preamble(spark, to, "event_id long, event_type string", 2)


@query("""SELECT event_id::VARCHAR AS time, unnest(['Wind', 'Wind', 'Sun']) AS "group", unnest(['a', 'b', 'a']) AS name, unnest([value::VARCHAR, user_id::VARCHAR, event_type]) AS value FROM events""")
def two_header_csv(spark, d):
    to = scratch(spark)
    rows = t(spark, d, "events").select(F.concat_ws(";", F.col("event_id").cast("string"), F.col("value").cast("string"), F.col("user_id").cast("string"), "event_type").alias("line"))
    one = rows.agg(F.sort_array(F.collect_list("line")).alias("l")).select(F.concat(F.lit("Time;Wind;;Sun\n;a;b;a\n"), F.array_join("l", "\n")).alias("value"))
    one.write.text(to)
    return readers.csv_two_headers(spark, to)


# Streams and sources


@query("""SELECT strftime(ts, '%Y-%m-%d 12:00') AS time, 'Sun' AS fueltype, 'unit ' || event_id AS name, event_id::DOUBLE AS output FROM events WHERE event_id % 4 <> 1 AND event_id % 4 <> 2""")
def snapshots_followed(spark, d):
    """Snapshot documents as files, read by two runs of the stream: rows of subtotals and of another arity go."""
    to = scratch(spark)
    name = F.when(F.col("event_id") % 4 == 1, "Subtotal").otherwise(F.concat(F.lit("unit "), F.col("event_id").cast("string")))
    row = F.array(F.lit("<a><b>Sun</b>"), F.lit(""), name, F.lit("5"), F.col("event_id").cast("string"), F.lit(""), F.lit(""), F.lit(""))
    row = F.when(F.col("event_id") % 4 == 2, F.slice(row, 1, 3)).otherwise(row)
    docs = t(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd 12:00").alias(" ")).agg(F.collect_list(row).alias("dataset")).withColumnRenamed(" ", "")
    for part in (0, 1):
        docs.filter(F.pmod(F.crc32("``"), F.lit(2)) == part).write.mode("append").option("maxRecordsPerFile", 1).json(f"{to}/in")
        snapshots.follow(spark, f"{to}/in", f"{to}/out", f"{to}/checkpoint").awaitTermination()
    rows = spark.read.schema("time timestamp_ntz, fueltype string, name string, output double, date string").parquet(f"{to}/out")
    return rows.select(F.date_format("time", "yyyy-MM-dd HH:mm").alias("time"), "fueltype", "name", "output")


class _Orders(protocol.Source):
    """The orders of a month as a task each; the last month of the plan has none."""

    name, columns = "orders-by-month", ["key"]

    def __init__(self, folder: str):
        self.folder = folder

    def plan(self, spark):
        return tasks.with_identity(tf.spine(spark, [1995, 1996], "month", dt.date(1997, 1, 1)).withColumn("temporal_resolution", F.lit("1h")))

    def read(self, spark, open_tasks):
        rows = t(spark, self.folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("date"), F.col("o_orderkey").alias("key")).filter("date <> '1996-12'")
        return rows.join(open_tasks.select("date", "identifier"), "date")


@query("""SELECT 'date=' || strftime(g, '%Y-%m') || '|temporal_resolution=1h' AS identifier, (strftime(g, '%Y-%m') <> '1996-12')::BIGINT AS status,
  (SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = strftime(g, '%Y-%m') AND strftime(g, '%Y-%m') <> '1996-12') AS n FROM unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1996-12-01', INTERVAL 1 MONTH)) AS s(g)""")
def source_run(spark, d):
    """Two runs: the second finds only the task without data open, and changes nothing."""
    to = scratch(spark)
    one = _Orders(d)
    protocol.run(spark, one, f"{to}/out", f"{to}/state", 1996)
    state = protocol.run(spark, one, f"{to}/out", f"{to}/state", 1996)
    n = spark.read.schema("key long, identifier string").parquet(f"{to}/out").groupBy("identifier").agg(F.count("*").alias("n"))
    return state.join(n, "identifier", "left").select("identifier", F.col("status").cast("long").alias("status"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


# Files that Spark has no writer for: made from the nations, a table of fixed size


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a file through Spark's file systems, so that the folder may be a remote one."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to, True)
    out.write(bytearray(data))
    out.close()


def _zip(members: dict[str, str]) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return raw.getvalue()


def _nations(spark, d) -> list:
    return t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()


@query("SELECT n_nationkey::BIGINT AS key, n_name AS name FROM nation")
def zipped_csv(spark, d):
    """An archive a region, each with one CSV."""
    to, rows = scratch(spark), _nations(spark, d)
    for region in sorted({r["n_regionkey"] for r in rows}):
        lines = [f"{r['n_nationkey']},{r['n_name']}" for r in rows if r["n_regionkey"] == region]
        _put(spark, f"{to}/{region}.zip", _zip({f"{region}.CSV": "\r\n".join(["key,name", *lines, ""])}))
    return readers.zip_csv(spark, to, "key long, name string")


def _book(sheets: dict[str, dict[int, list]]) -> bytes:
    """The least of a workbook: rows by number, every cell as text in place."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda at, v: f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    row = lambda n, cells: f'<row r="{n}">' + "".join(cell(f"{chr(65 + i)}{n}", v) for i, v in enumerate(cells) if v is not None) + "</row>"
    members = {f"xl/worksheets/s{i}.xml": f"<worksheet {main}><sheetData>{''.join(row(n, c) for n, c in rows.items())}</sheetData></worksheet>" for i, rows in enumerate(sheets.values(), 1)}
    listed = "".join(f'<sheet name="{name}" sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(sheets, 1))
    links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
    members |= {"xl/workbook.xml": f"<workbook {main} {rel}><sheets>{listed}</sheets></workbook>", "xl/_rels/workbook.xml.rels": f"<Relationships>{links}</Relationships>"}
    return _zip(members)


@query("""SELECT n_nationkey::VARCHAR AS key, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS name FROM nation""")
def workbook_sheet(spark, d):
    """The first sheet of a list that exists, its header in the fourth row, columns before the one named like the sheet."""
    rows = {n: [r["n_nationkey"], r["n_name"] if r["n_nationkey"] % 2 == 0 else None, 0, "x"] for n, r in enumerate(_nations(spark, d), 5)}
    to = f"{scratch(spark)}/book.xlsx"
    _put(spark, to, _book({"Other": {1: ["key"], 2: [1]}, "Units": {1: ["a title"], 4: ["key", "name", "Units", "more"]} | rows}))
    return readers.load(spark, to, sheets=["Absent", "Units"], header=3, until="Units")


@query("SELECT 'first' AS sheet, n_nationkey::BIGINT AS row, n_name AS cell FROM nation UNION ALL SELECT 'second', 0, 'end'")
def workbook_cells(spark, d):
    to = f"{scratch(spark)}/book.xlsx"
    _put(spark, to, _book({"first": {n: [r["n_name"]] for n, r in enumerate(_nations(spark, d), 1)}, "second": {1: ["end"]}}))
    return readers.sheet_cells(spark, to).select("sheet", F.col("row").cast("long").alias("row"), F.get("cells", F.lit(0)).alias("cell"))


@query("SELECT n_nationkey::BIGINT AS key, n_name AS name FROM nation")
def json_documents(spark, d):
    """A document a region, over several lines."""
    to = scratch(spark)
    docs = t(spark, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))), {"pretty": "true"}).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(to)
    return readers.load(spark, to, "json", "key long, name string")


@query("SELECT n_regionkey::BIGINT AS region, n_nationkey::BIGINT AS key, n_name AS name FROM nation")
def paged_rows(spark, d):
    """A partition a region; pages of more than two rows are refused, so the size is halved twice and the key read anew."""
    rows: dict[int, list] = {}
    for r in _nations(spark, d):
        rows.setdefault(r["n_regionkey"], []).append((r["n_regionkey"], r["n_nationkey"], r["n_name"]))

    def fetch(key, offset, size):
        if size > 2:
            raise ConnectionError("page too large")
        return rows[key][offset : offset + size], len(rows[key])

    return readers.paged(spark, fetch, sorted(rows), "region long, key long, name string", size=8, halvings=2)


# Contracts, catalogues and rules


@query("SELECT c_name, c_custkey FROM customer")
def projected_columns(spark, d):
    return contracts.project(t(spark, d, "customer"), ["c_name", "c_custkey"])


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 2")
def required_rows(spark, d):
    return contracts.require_rows(t(spark, d, "orders").filter(tf.in_month(F.col("o_orderdate"), 1996, 2))).select("o_orderkey")


@query("SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events")
def step_seconds(spark, d):
    return quality.gaps(t(spark, d, "events"), ["user_id"], "ts").select("user_id", "gap")


@query("SELECT p_partkey, p_size BETWEEN 10 AND 29 AS ok FROM part")
def resolution_forms(spark, d):
    size = F.col("p_size").cast("string")
    raw = F.when(F.col("p_size") < 10, F.concat(size, F.lit("m"))).when(F.col("p_size") < 20, F.concat(size, F.lit("min"))).when(F.col("p_size") < 30, F.concat(size, F.lit("h")))
    return t(spark, d, "part").select("p_partkey", tf.valid_resolution(raw).alias("ok"))


@query("""SELECT 'date=' || strftime(o_orderdate, '%Y-%m-%d') || '|temporal_resolution=30min' AS identifier, list_aggregate([lpad(h::VARCHAR, 2, '0') || ':00' FOR h IN range(24)], 'string_agg', '/') AS hours,
  list_aggregate([lpad(i::VARCHAR, 2, '0') FOR i IN range(1, day(last_day(o_orderdate)) + 1)], 'string_agg', '/') AS days FROM orders""")
def requested_hours(spark, d):
    plan = tasks.with_identity(t(spark, d, "orders").select("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("30min").alias("temporal_resolution")))
    return tasks.valid(plan).select("identifier", F.array_join(tf.hours_of_day(), "/").alias("hours"), F.array_join(tf.days_of_month(F.col("o_orderdate")), "/").alias("days"))


@query("SELECT p_partkey::VARCHAR AS variable, p_brand AS code FROM part WHERE p_type = 'PROMO' OR p_size % 2 = 0")
def catalogue_of_model(spark, d):
    """A catalogue file, with the models that have each variable; the variables of one model."""
    to = scratch(spark)
    models = F.concat_ws(" ", "p_type", F.when(F.col("p_size") % 2 == 0, "PROMO"))
    rows = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("variable"), F.col("p_brand").alias("code"), F.lit("single").alias("level_type"), models.alias("models"))
    sinks.save(rows, to, "csv", [])
    return tables.for_model(tables.variables_from_csv(spark, to), "PROMO").select("variable", "code")


@query("SELECT * FROM (VALUES ('R2', 73, 6, 10), ('C2', 111, 7, 14)) AS v(model, single, pressure, levels)")
def regional_catalogue(spark, d):
    def one(model):
        kinds = tables.for_model(tables.barra_variables(spark), model)
        levels = tables.for_model(tables.barra_levels(spark), model).agg(F.count("*").alias("levels"))
        found = kinds.agg(F.count_if(F.col("level_type") == "single").alias("single"), F.count_if(F.col("level_type") == "pressure").alias("pressure"))
        return found.crossJoin(levels).select(F.lit(model).alias("model"), "single", "pressure", "levels")  # two rows of sums

    return one("R2").unionByName(one("C2"))


@query("SELECT n_name AS zone FROM nation WHERE n_nationkey IN (2, 5)")
def validated_names(spark, d):
    names = tables.validate(["NATION_5", "NATION_2"], t(spark, d, "nation"), "n_name", "zones")
    return spark.createDataFrame([(n,) for n in names], "zone string")


@query("""SELECT * FROM (VALUES ('none given', true, false), ('empty pressure', true, false), ('empty model', false, true), ('both', true, true)) AS v(given, pressure, model)""")
def level_defaults(spark, d):
    """Which kinds of levels a request has, by what was given."""
    given = {"none given": (None, None), "empty pressure": ([], None), "empty model": (None, []), "both": ([1000], [137])}
    rows = [(name, *(levels is not None for levels in weather.default_levels(*pair))) for name, pair in given.items()]
    return spark.createDataFrame(rows, "given string, pressure boolean, model boolean")


@query("SELECT * FROM (VALUES ('defaults', 'tas,pr,orog,sftlf'), ('chosen', 'ta,orog,sftlf'), ('chosen twice', 'orog,ta,sftlf')) AS v(given, names)")
def variable_rules(spark, d):
    """The names given, or the defaults that a model has, then the invariant fields; each once."""
    given = {"defaults": None, "chosen": ["ta"], "chosen twice": ["orog", "ta", "ta"]}
    rows = [(name, ",".join(weather.barra_variables(chosen, ["tas", "absent", "pr"], ["pr", "tas"], ["orog", "sftlf"]))) for name, chosen in given.items()]
    return spark.createDataFrame(rows, "given string, names string")


@query("""SELECT * FROM (VALUES ('a.x', '1'), ('a.y', 'two'), ('a.z.deep', 'v=w'), ('b', NULL)) AS v(name, value)""")
def merged_settings(spark, d):
    """Settings of a file with dotted overrides merged in; the word none is null."""
    merged = config.merge(config.none_to_null({"a": {"x": "1", "y": "2"}, "b": "None"}), config.parse_pairs(["a.y=two", "a.z.deep=v=w"]))

    def flat(at: dict, lead: str = "") -> list[tuple]:
        return [row for k, v in at.items() for row in (flat(v, f"{lead}{k}.") if isinstance(v, dict) else [(lead + k, v)])]

    return spark.createDataFrame(flat(merged), "name string, value string")
