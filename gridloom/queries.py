"""Each operator as a named query on the driver's tables, with the same result in DuckDB's SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .functions import time as tf
from .operators import contracts, quality, relational, reshape
from .plans import tasks, weather
from .sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HOURS = ", ".join(f"arg_min(value, event_id) FILTER (hour(ts) + 1 = {h}) AS \"Hour {h}\"" for h in range(1, 25))


@query(f"SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, {_HOURS} FROM events GROUP BY 1, 2")
def hourly_wide_standardise(spark, d):
    e = t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", (F.hour("ts") + 1).alias("hour"), "value", "event_id")
    return reshape.hours_wide(e, ["day", "event_type"], "hour", "value", position=["event_id"])


@query("SELECT p_partkey, unnest(['p_size', 'p_retailprice']) AS measure, unnest([p_size::DOUBLE, p_retailprice]) AS value FROM part")
def melt_measures(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return reshape.melt(p, ["p_partkey"], "measure", "value")


@query("SELECT event_type, strftime(ts - INTERVAL 1 HOUR, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY 1, 2")
def eoi_month_counts(spark, d):
    e = t(spark, d, "events").withColumn("month", F.date_format(tf.interval_start(F.col("ts"), 60), "yyyy-MM"))
    return e.groupBy("event_type", "month").agg(F.count("*").alias("n"))


@query("SELECT event_id, ts::VARCHAR AS at FROM events WHERE ts >= TIMESTAMP '2024-01-01 01:00:00' AND ts < TIMESTAMP '2024-02-01 01:00:00'")
def eoi_month_slice(spark, d):
    e = t(spark, d, "events")
    return e.filter(tf.in_month_by_end(F.col("ts"), 2024, 1)).select("event_id", F.col("ts").cast("string").alias("at"))


@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 3")
def month_slice(spark, d):
    rows = t(spark, d, "lineitem").filter(tf.in_month(F.col("l_shipdate"), 1997, 3))
    return relational.sort_nulls_last(rows.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")), "shipped", "l_orderkey", "l_linenumber")


@query("SELECT (year(o_orderdate) - (month(o_orderdate) < 4)::INTEGER)::BIGINT AS fiscal_year, count(*) AS n FROM orders GROUP BY 1")
def fiscal_year_counts(spark, d):
    return t(spark, d, "orders").groupBy(tf.fiscal_year(F.col("o_orderdate")).cast("long").alias("fiscal_year")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, strftime(date_trunc('year', coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END,
  CASE WHEN o_orderpriority LIKE '1%' THEN o_orderdate END, TIMESTAMP '1998-12-01')), '%Y-%m-%d') AS start FROM orders""")
def year_start_buffer(spark, d):
    o = t(spark, d, "orders")
    first, second = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")), F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderdate"))
    start = tf.year_start(first, second, default=F.lit("1998-12-01").cast("timestamp_ntz"))
    return o.select("o_orderkey", F.date_format(start, "yyyy-MM-dd").alias("start"))


@query("""SELECT event_id, strftime(ts + INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S') AS nem,
  strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo', '%Y-%m-%d %H:%M:%S') AS tokyo FROM events""")
def fixed_offset_shift(spark, d):
    e = t(spark, d, "events")
    form = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select("event_id", form(tf.shift_hours(F.col("ts"), 10)).alias("nem"), form(tf.epoch_in_zone(seconds, "Asia/Tokyo")).alias("tokyo"))


@query("SELECT l_orderkey, l_linenumber, p_name, p_brand, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey")
def dim_fact_join(spark, d):
    dim = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return relational.with_dimension(t(spark, d, "lineitem"), dim, "l_partkey", ["l_orderkey", "l_linenumber", "p_name", "p_brand", "l_quantity"])


_NULLED = "SELECT c_custkey, nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer"


def _nulled(spark, d):
    return t(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))


@query(f"""WITH c AS ({_NULLED}), b AS (SELECT nation, segment, count(*) AS n FROM c GROUP BY 1, 2)
SELECT c_custkey, c.nation, c.segment, n FROM c JOIN b ON c.nation IS NOT DISTINCT FROM b.nation AND c.segment IS NOT DISTINCT FROM b.segment""")
def null_safe_multi_key_join(spark, d):
    c = _nulled(spark, d)
    counts = c.groupBy("nation", "segment").agg(F.count("*").alias("n"))
    return relational.join_null_safe(c, counts, ["nation", "segment"]).select("c_custkey", "nation", "segment", "n")


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1),
l AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(o.day, l.day) AS day, o.n AS ordered, l.n AS shipped FROM o FULL JOIN l ON o.day = l.day""")
def aligned_outer_concat(spark, d):
    part = lambda name, c: t(spark, d, name).groupBy(F.date_format(c, "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return relational.align({"ordered": part("orders", "o_orderdate"), "shipped": part("lineitem", "l_shipdate")}, "day", "n")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def lookup_passthrough(spark, d):
    codes = spark.createDataFrame([("1-URGENT", "u"), ("2-HIGH", "h")], "name string, code string")
    return relational.lookup_or_same(t(spark, d, "orders").select("o_orderkey", "o_orderpriority"), codes, "o_orderpriority", "name", "code")


_PLAN = """days AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events), zones AS (SELECT DISTINCT event_type AS bidding_zone FROM events),
plan AS (SELECT date, bidding_zone, 'date=' || date || '|temporal_resolution=1h|bidding_zone=' || bidding_zone AS identifier FROM days, zones)"""


def _task_plan(spark, d):
    e = t(spark, d, "events")
    days, zones = e.select(F.date_format("ts", "yyyy-MM-dd").alias("date")).distinct(), e.select(F.col("event_type").alias("bidding_zone")).distinct()
    return tasks.with_identity(days.crossJoin(zones).withColumn("temporal_resolution", F.lit("1h")))


@query(f"WITH {_PLAN} SELECT date, bidding_zone, identifier, substr(date, 1, 4)::BIGINT AS year, substr(date, 6, 2)::BIGINT AS month FROM plan")
def task_plan_cross(spark, d):
    return _task_plan(spark, d).select("date", "bidding_zone", "identifier", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"))


@query(f"""WITH {_PLAN}, done AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, event_type AS bidding_zone FROM events WHERE value > 200)
SELECT identifier FROM plan ANTI JOIN done USING (date, bidding_zone)""")
def resume_anti_join(spark, d):
    done = t(spark, d, "events").filter("value > 200").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("bidding_zone"), F.lit("1h").alias("temporal_resolution")).distinct()
    state = tasks.with_identity(done).select("identifier", F.lit(1).alias("status"))
    return tasks.remaining(_task_plan(spark, d), state).select("identifier")


@query("""SELECT strftime(g, '%Y-%m-%d') AS date FROM unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-09', INTERVAL 1 DAY)) AS s(g)
WHERE strftime(g, '%Y-%m-%d') NOT IN (SELECT strftime(ts, '%Y-%m-%d') FROM events)""")
def date_spine_gaps(spark, d):
    have = t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return relational.missing(tf.spine(spark, [2024], "day", dt.date(2024, 2, 10)), have, ["date"])


@query("""WITH g AS (SELECT user_id, floor((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 / 60)::BIGINT AS gap FROM events),
c AS (SELECT user_id, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT user_id, gap FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, gap) = 1""")
def mode_gap_minutes(spark, d):
    return quality.mode_gap(t(spark, d, "events"), ["user_id"], "ts", 60)


@query("""WITH s AS (SELECT user_id, coalesce(value >= lag(value) OVER (PARTITION BY user_id ORDER BY event_id), true) AS ok FROM events)
SELECT user_id, count(*) AS n, bool_and(ok) AND count(*) >= 2 AS ordered FROM s GROUP BY 1""")
def continuity_check(spark, d):
    return quality.continuity(t(spark, d, "events"), ["user_id"], "value", "event_id")


@query("""WITH g AS (SELECT user_id, floor((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 / 60)::BIGINT AS gap FROM events),
c AS (SELECT user_id, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT user_id, arg_min(gap, -n * 1000000000 + gap) AS gap, min(gap) <> max(gap) AS irregular FROM c GROUP BY 1""")
def irregular_series(spark, d):
    return quality.irregular(t(spark, d, "events"), ["user_id"], "ts", 60)


_PROBES = """SELECT user_id::VARCHAR AS zone, strftime(ts, '%Y-%m-%d') AS date, value > 60 AND user_id % 5 > 0 AS has_data,
CASE WHEN value < 5 THEN event_type END AS status FROM events"""


def _probes(spark, d):
    return t(spark, d, "events").select(
        F.col("user_id").cast("string").alias("zone"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        ((F.col("value") > 60) & (F.col("user_id") % 5 > 0)).alias("has_data"),
        F.when(F.col("value") < 5, F.col("event_type")).alias("status"),
    )


@query(f"""WITH p AS ({_PROBES}) SELECT zone, bool_or(has_data) AS has_any_data,
  coalesce(string_agg(CASE WHEN has_data THEN date END, ',' ORDER BY date), '') AS hit_dates,
  count(*) FILTER (has_data) AS n_hits, count(*) FILTER (NOT has_data AND status IS NULL) AS n_misses,
  min(date) FILTER (has_data) AS first_hit, max(date) FILTER (has_data) AS last_hit,
  substr(min(date) FILTER (has_data), 1, 4)::BIGINT AS first_year FROM p GROUP BY 1""")
def hit_stats(spark, d):
    s = quality.availability(_probes(spark, d))
    return s.select("zone", "has_any_data", F.array_join("hit_dates", ",").alias("hit_dates"), "n_hits", "n_misses", "first_hit", "last_hit", F.col("first_year").cast("long").alias("first_year"))


@query(f"WITH p AS ({_PROBES}) SELECT zone, status, count(*) AS n FROM p WHERE status IS NOT NULL GROUP BY 1, 2")
def error_histogram(spark, d):
    return quality.availability(_probes(spark, d)).select("zone", F.explode("errors").alias("status", "n"))


@query(f"WITH p AS ({_PROBES}) SELECT count(*) FILTER (hits > 0) AS active, count(*) FILTER (hits = 0) AS inactive, min(first_hit) AS earliest FROM (SELECT zone, count(*) FILTER (has_data) AS hits, min(date) FILTER (has_data) AS first_hit FROM p GROUP BY 1)")
def zone_summary(spark, d):
    s = quality.availability(_probes(spark, d))
    return s.agg(F.count_if("has_any_data").alias("active"), F.count_if(~F.col("has_any_data")).alias("inactive"), F.min("first_hit").alias("earliest"))


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def dedupe_keep_first(spark, d):
    return relational.keep_first(t(spark, d, "events"), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id", "value")


@query(f"SELECT * FROM ({_NULLED}) WHERE nation IS NOT NULL AND segment IS NOT NULL")
def drop_null_any(spark, d):
    return contracts.drop_null(_nulled(spark, d), "nation", "segment")


@query(f"SELECT * FROM ({_NULLED}) WHERE nation IS NOT NULL OR segment IS NOT NULL")
def drop_null_all(spark, d):
    return contracts.drop_all_null(_nulled(spark, d), "nation", "segment")


@query(f"SELECT * FROM ({_NULLED}) WHERE segment IS DISTINCT FROM 'MACHINERY'")
def not_equal_keep_null(spark, d):
    return _nulled(spark, d).filter(relational.differs(F.col("segment"), "MACHINERY"))


@query(f"SELECT segment, nation, count(*) AS n FROM ({_NULLED}) GROUP BY ALL ORDER BY segment NULLS LAST, nation NULLS LAST")
def sort_nulls_last(spark, d):
    return relational.sort_nulls_last(_nulled(spark, d).groupBy("segment", "nation").agg(F.count("*").alias("n")), "segment", "nation")


@query("SELECT s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def union_by_name(spark, d):
    a = t(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = t(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"))
    return relational.union_by_name(a, b)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def set_difference_units(spark, d):
    keys = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.missing(t(spark, d, "orders").select("o_orderkey"), keys, ["o_orderkey"])


@query("SELECT DISTINCT p_brand AS code FROM part UNION SELECT DISTINCT c_mktsegment FROM customer")
def set_union_codes(spark, d):
    return relational.distinct_union("code", (t(spark, d, "part"), "p_brand"), (t(spark, d, "customer"), "c_mktsegment"))


@query("SELECT c_custkey, ntile((SELECT ceil(count(*) / 400)::BIGINT FROM customer)) OVER (ORDER BY c_custkey) AS batch FROM customer")
def batch_ntile(spark, d):
    return relational.batches(t(spark, d, "customer").select("c_custkey"), "c_custkey", 400).withColumn("batch", F.col("batch").cast("long"))


@query("SELECT nullif(event_type, 'click') AS event_type, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1")
def split_by_key_counts(spark, d):
    e = t(spark, d, "events").withColumn("event_type", F.nullif("event_type", F.lit("click")))
    return contracts.drop_null(e, "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS body FROM pages")
def strip_html(spark, d):
    return t(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("body"))


@query(r"""SELECT doc_id, regexp_replace(text, '((?:token|password|secret|key)[''"]?\s*[=:]\s*[''"]?)[^\s''",;&}]+', '\1******', 'gi') AS masked FROM documents""")
def mask_secrets(spark, d):
    return t(spark, d, "documents").select("doc_id", text.mask_secrets(F.col("text")).alias("masked"))


@query("SELECT page_id, nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') AS heading FROM pages")
def tag_extract(spark, d):
    return t(spark, d, "pages").select("page_id", F.nullif(text.between(F.col("html"), "<h1>", "</h1>"), F.lit("")).alias("heading"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id * 1.5 WHEN 1 THEN 12.5 END::DOUBLE AS number FROM events")
def coerce_numeric(spark, d):
    k = F.col("event_id") % 4
    cell = F.when(k == 0, (F.col("event_id") * 1.5).cast("string")).when(k == 1, F.lit(" 12.5 ")).when(k == 2, F.lit("1d"))
    return t(spark, d, "events").select("event_id", text.to_number(cell).alias("number"))


@query("""SELECT o_orderkey AS facility, l_linenumber::BIGINT AS unit_code, l_quantity AS unit_capacity FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def explode_records(spark, d):
    units = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("facility")).agg(F.collect_list(F.struct(F.col("l_linenumber").cast("long").alias("code"), F.col("l_quantity").alias("capacity"))).alias("units"))
    facilities = t(spark, d, "orders").select(F.col("o_orderkey").alias("facility")).join(units, "facility", "left")
    return reshape.explode_records(facilities, "units", "unit_", ["facility"])


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def json_field_flatten(spark, d):
    return reshape.json_fields(t(spark, d, "events").select("event_id", "props"), "props", {"k": "$.k"}, "").drop("props")


@query("SELECT vec_id, unnest(range(8))::BIGINT AS epoch, unnest(embedding[9:16])::DOUBLE AS value FROM embeddings")
def array_slice_explode(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", F.sequence(F.lit(0), F.size("embedding") - 1).alias("epochs"), "embedding")
    e = reshape.slice_arrays(e.filter(reshape.lengths_agree(F.col("epochs"), F.col("embedding"))), "epochs", ["embedding"], F.lit(8), F.lit(15))
    return e.select("vec_id", F.explode(F.arrays_zip("epochs", "embedding")).alias("z")).select("vec_id", (F.col("z.epochs") - 8).cast("long").alias("epoch"), F.col("z.embedding").cast("double").alias("value"))


@query("SELECT * FROM (VALUES ('PT60M', '1h', '1h'), ('PT15M', '15min', '15m'), ('PT5M', '5min', '5m')) AS r(raw, resolution, api)")
def resolution_name(spark, d):
    raw = spark.createDataFrame([("PT60M",), ("PT15M",), ("PT5M",)], "raw string")
    return raw.withColumn("resolution", tf.from_iso_duration(F.col("raw"))).withColumn("api", tf.api_code(F.col("resolution")))


@query("SELECT count(*) AS n FROM lineitem")
def completeness_count(spark, d):
    """As many rows as the sum of the counts by flag, which stands for what a paged interface advertises."""
    lines = t(spark, d, "lineitem")
    total = lines.groupBy("l_returnflag").agg(F.count("*").alias("c")).agg(F.sum("c")).first()[0]
    return contracts.require_total(lines.select("l_orderkey"), total).agg(F.count("*").alias("n"))


@query("""SELECT user_id, count(*) FILTER (value > 50) AS with_data, bool_or(value < 1) AS any_low, bool_and(value >= 0) AS all_sound FROM events GROUP BY 1""")
def any_all_counts(spark, d):
    v = F.col("value")
    return quality.tally(t(spark, d, "events"), ["user_id"], {"with_data": v > 50}, {"any_low": v < 1}, {"all_sound": v >= 0})


@query("""SELECT page_id, nullif(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '') AS site, list_sort(list_distinct(regexp_extract_all(html, 'href="/([A-Za-z]+)"', 1)))::VARCHAR AS links FROM pages""")
def link_listing(spark, d):
    p = t(spark, d, "pages")
    links = F.array_sort(readers.links_in_page(F.col("html"), r'href="/([A-Za-z]+)"'))
    return p.select("page_id", F.nullif(F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1), F.lit("")).alias("site"), F.concat(F.lit("["), F.array_join(links, ", "), F.lit("]")).alias("links"))


@query("""SELECT o_orderkey, CASE WHEN kind = 'success' THEN 1 WHEN kind = 'missing' THEN (yr <> 1998)::INTEGER WHEN kind = 'http' AND code BETWEEN 400 AND 499 AND code NOT IN (401, 429) THEN 1 ELSE 0 END AS status,
  CASE WHEN kind = 'http' AND code IN (401, 429) THEN 6 WHEN kind = 'timeout' OR kind = 'http' AND code >= 500 THEN 3 ELSE 0 END AS waits, kind IN ('structure', 'invalid') AS ends
FROM (SELECT o_orderkey, year(o_orderdate) AS yr, ['success', 'structure', 'invalid', 'missing', 'http', 'timeout', 'other'][o_orderkey % 7 + 1] AS kind,
  [401, 429, 404, 400, 500, 503][o_orderkey % 6 + 1] AS code FROM orders)""")
def attempt_outcomes(spark, d):
    pick = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), (c + 1).cast("int"))
    k = F.col("o_orderkey")
    o = t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr"), pick(["success", "structure", "invalid", "missing", "http", "timeout", "other"], k % 7).alias("kind"), pick([401, 429, 404, 400, 500, 503], k % 6).alias("code"))
    status, waits, ends = tasks.outcome(F.col("kind"), F.col("code"), F.col("yr"), 1998)
    return o.select("o_orderkey", status.cast("int").alias("status"), waits.cast("int").alias("waits"), ends.alias("ends"))


@query("""SELECT zone || '-' || y AS probe FROM (SELECT DISTINCT event_type AS zone FROM events), (SELECT unnest(['2023-03-15', '2023-09-15', '2024-03-15', '2024-09-15']) AS y)""")
def probe_sampler(spark, d):
    zones = t(spark, d, "events").select(F.col("event_type").alias("zone")).distinct()
    return tasks.probe_dates(spark, zones, [2023, 2024], 2).select(F.concat_ws("-", "zone", "date").alias("probe"))


@query("""SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m') < '1997-06' THEN 'yearly' ELSE 'monthly' END AS route FROM orders""")
def source_routing(spark, d):
    month = F.date_format("o_orderdate", "yyyy-MM")
    shifted = F.concat((F.substring(month, 1, 4).cast("int") + 22).cast("string"), F.substring(month, 5, 3))
    moved = F.when(month < "1997-06", F.lit("2018-12")).otherwise(shifted)
    return t(spark, d, "orders").select("o_orderkey", tasks.route("adme", moved).alias("route"))


@query("""SELECT strftime(g, '%Y') AS year, strftime(g, '%m') AS month, k AS level_type FROM unnest(generate_series(TIMESTAMP '2023-01-01', TIMESTAMP '2024-05-31', INTERVAL 1 MONTH)) AS s(g), (VALUES ('single'), ('pressure'), ('model')) AS l(k)""")
def weather_plan(spark, d):
    return weather.era5_plan(spark, [2023, 2024], dt.date(2024, 6, 1), ["1000"], ["137"])


@query("""SELECT o_orderkey, day(last_day(o_orderdate))::BIGINT AS n_days, strftime(o_orderdate, '%Y-%m') || '-01/to/' || strftime(last_day(o_orderdate), '%Y-%m-%d') AS span FROM orders""")
def request_spans(spark, d):
    first = F.trunc("o_orderdate", "month")
    span = F.concat(F.date_format(first, "yyyy-MM-dd"), F.lit("/to/"), F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd"))
    return t(spark, d, "orders").select("o_orderkey", F.size(tf.days_of_month(F.col("o_orderdate"))).cast("long").alias("n_days"), span.alias("span"))


@query("""SELECT o_orderkey, o_orderkey % 4 <> 2 AS ok FROM orders""")
def date_validation(spark, d):
    good = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, good).when(k == 1, F.substring(good, 1, 7)).when(k == 3, F.substring(good, 1, 4)).otherwise(F.concat(F.substring(good, 1, 5), F.lit("02-31")))
    return t(spark, d, "orders").select("o_orderkey", tf.valid_date(raw).alias("ok"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 400 + event_id % 100 WHEN 1 THEN 503 END::BIGINT AS status FROM events""")
def http_status_codes(spark, d):
    k = F.col("event_id") % 3
    message = F.when(k == 0, F.concat(F.lit("HTTP status code: "), (F.lit(400) + F.col("event_id") % 100).cast("string"))).when(k == 1, F.lit("Server answered 503 to it")).otherwise(F.lit("refused"))
    return t(spark, d, "events").select("event_id", text.http_status(message).cast("long").alias("status"))


@query("SELECT c_custkey, c_custkey % 3 = 0 AS complete FROM customer")
def required_fields(spark, d):
    third = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.lit(" "))
    return t(spark, d, "customer").select("c_custkey", text.present(F.col("c_name"), third).alias("complete"))


@query(f"""WITH p AS ({_PROBES}), z AS (SELECT zone, substr(min(date) FILTER (has_data), 1, 4)::BIGINT AS start, substr(max(date) FILTER (has_data), 1, 4)::BIGINT AS last FROM p GROUP BY 1)
SELECT zone, start, CASE WHEN last <> 2025 THEN last END AS "end" FROM z WHERE start IS NOT NULL""")
def zone_listing(spark, d):
    z = quality.zone_listing(quality.availability(_probes(spark, d)), 2025)
    return z.select("zone", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""WITH f AS (SELECT o_orderkey, 'data (' || CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END || ') ' AS stem, date_trunc('month', o_orderdate) AS m FROM orders)
SELECT o_orderkey, strftime(unnest(generate_series(m, CASE WHEN o_orderkey % 5 = 0 THEN m + INTERVAL 2 MONTH ELSE m END, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM f""")
def months_of_names(spark, d):
    m = F.date_format("o_orderdate", "yyyy-MM")
    later = F.date_format(F.add_months("o_orderdate", 2), "yyyy-MM")
    name = F.when(F.col("o_orderkey") % 5 == 0, F.concat_ws(" - ", F.lit("data"), m, later)).otherwise(F.concat(F.lit("data "), m, F.lit(".zip")))
    return t(spark, d, "orders").select("o_orderkey", F.explode(readers.months_in_name(name)).alias("month"))


@query("""SELECT p_partkey, unnest(range(1, 4)) AS position, strftime(TIMESTAMP '2024-03-10 00:00:00' + INTERVAL 1 MINUTE * (unnest(range(0, 3)) * p_size), '%Y-%m-%d %H:%M') AS at FROM part WHERE p_size > 0""")
def stamped_points(spark, d):
    from .sources.providers import entsoe_records

    points = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(i.alias("position")))
    p = t(spark, d, "part").filter("p_size > 0").select("p_partkey", F.lit("2024-03-10 00:00:00").cast("timestamp_ntz").alias("period_start"), F.col("p_size").alias("resolution_minutes"), points.alias("points"))
    rows = entsoe_records(p, ["p_partkey"])
    return rows.select("p_partkey", F.col("position").cast("long").alias("position"), F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("at"))
