import datetime as dt
import io
import json
import zipfile

import pytest
from gridloom.errors import ContractError, IncompleteError, NoDataError, RequestError
from gridloom.operators import contracts, quality, relational, reshape
from gridloom.plans import tasks, weather
from gridloom.sources import providers, readers, sinks
from gridloom.catalog import tables
from gridloom.functions import text
from gridloom.functions import time as tf
from gridloom.streaming import snapshots
from pyspark.sql import functions as F

TODAY = dt.date(2025, 2, 1)


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# providers


def entsoe_frame(spark, rows):
    names = providers.COLUMNS["entsoe"]
    return spark.createDataFrame([(*r, "extra") for r in rows], ", ".join(f"`{n}` string" for n in [*names, "extra"]))


def test_entsoe_projects_drops_and_sorts(spark):
    row = lambda ts, name, code, kind: (ts, name, code, kind, "200", "100", None, "MAW", "PT60M")
    got = providers.entsoe(entsoe_frame(spark, [row("t2", "P", "X", "B01"), row("t1", None, "X", "B01"), row("t1", "A", None, "B01"), row("t1", None, None, "B01"), row("t1", "N", "X", None)]))
    assert got.columns == providers.COLUMNS["entsoe"]
    assert [tuple(r)[:2] for r in got.collect()] == [("t1", "A"), ("t1", None), ("t2", "P")]
    with pytest.raises(ContractError):
        providers.entsoe(got.drop("timestamp"))


def test_split_by_resolution(spark, tmp_path):
    df = spark.createDataFrame([(10.0, "PT60M"), (20.0, None), (30.0, "PT20M")], "quantity double, resolution string")
    sinks.split_by_resolution(df, "resolution", str(tmp_path / "o"))
    got = spark.read.csv(str(tmp_path / "o"), header=True)
    assert sorted(values(got, "quantity", "temporal_resolution")) == [("10.0", "1h"), ("30.0", "20min")]
    for bad in ("INVALID", "PT1H", "", "60M"):
        with pytest.raises(Exception, match="no resolution"):
            spark.createDataFrame([(bad,)], "r string").select(tf.from_iso_duration(F.col("r"))).collect()


def test_aemo_units_and_readings(spark):
    unit = "struct<code:string,fueltech_id:string,status_id:string,dispatch_type:string,capacity_registered:double,capacity_maximum:double,capacity_storage:double,data_first_seen:timestamp,data_last_seen:timestamp,commencement_date:timestamp>"
    u = lambda c, seen=None, started=None: (c, "coal", "op", "GEN", 1.0, 1.0, None, seen, None, started)
    when = lambda y: dt.datetime(y, 5, 1)
    rows = [
        ("FAC1", None, "NEM", "R", "<b>A facility</b>", None, (1.0, 2.0), None, None, [u("U1", when(2020), when(2019)), u("U2", when(2020))]),
        ("FAC2", "n", "WEM", None, "x", None, None, None, None, [u("U3", None, when(2019)), u("U4")]),
        ("FAC3", "n", "WEM", "R", "x", None, None, None, None, []),
    ]
    f = spark.createDataFrame(rows, f"code string, name string, network_id string, network_region string, description string, npi_id string, location struct<lat:double,lng:double>, created_at timestamp, updated_at timestamp, units array<{unit}>")
    units = providers.aemo_units(f)
    assert sorted(values(units, "unit_code", "start_year")) == [("U1", 2020), ("U2", 2020), ("U3", 2019), ("U4", 1998)]
    assert values(units.filter("unit_code = 'U1'"), "description") == [("A facility",)]
    assert sorted(values(providers.aemo_active(units, 2019), "unit_code")) == [("U3",), ("U4",)]
    facts = spark.createDataFrame([("t2", "U1", 1.0), ("t1", "U1", 2.0), ("t1", "U2", 3.0), ("t2", "U2", 4.0), ("t1", "?", 0.0)], "timestamp string, unit_code string, value double")
    got = providers.aemo(facts, units)
    assert got.columns == providers.COLUMNS["aemo"] and [r["timestamp"] for r in got.collect()] == ["t1", "t1", "t2", "t2"]
    with pytest.raises(Exception, match="unknown network"):
        spark.createDataFrame([("XX",)], "n string").select(providers.aemo_offsets(F.col("n"))).collect()
    assert values(spark.createDataFrame([("WEM",), ("NEM",)], "n string").select(providers.aemo_offsets(F.col("n")).alias("h")), "h") == [(8,), (10,)]


def test_aemo_start_dates(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2020, 6, 1), d(2019, 6, 1)), (d(2020, 6, 1), None), (None, d(2019, 6, 1)), (None, None)], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(providers.aemo_start(F.col("a"), F.col("b"))).collect()] == [d(2020, 1, 1), d(2020, 1, 1), d(2019, 1, 1), d(1998, 1, 1)]


def test_aeso_month_and_bad_stamps(spark):
    cols = ", ".join(f"`{c}` string" for c in providers.COLUMNS["aeso"])
    row = lambda t: (t, t, "A", *["x"] * 9)
    df = spark.createDataFrame([row("2020-02-01 00:00:00"), row("2020-01-31 23:00:00"), row("2020-01-01 00:00:00")], cols)
    assert [r[0] for r in providers.aeso(df, 2020, 1).collect()] == ["2020-01-01 00:00:00", "2020-01-31 23:00:00"]
    with pytest.raises(NoDataError):
        contracts.require_rows(providers.aeso(df, 2021, 1))
    with pytest.raises(Exception, match="no time"):
        providers.aeso(spark.createDataFrame([row("soon")], cols), 2020, 1).collect()


def test_eia_drops_the_fence_post_and_sorts(spark):
    cols = ", ".join(f"`{c}` string" for c in providers.COLUMNS["eia"])
    df = spark.createDataFrame([(p, "R", "r", "COL", "c", "10", "mwh") for p in ("2020-01-01T01", None, "2020-01-02T00", "2020-01-01T00")], cols)
    assert [r["period"] for r in providers.eia(df, "2020-01-02T00").collect()] == ["2020-01-01T00", "2020-01-01T01", None]


def test_ieso_keeps_null_measurements_and_sorts_capability_first(spark):
    cols = ", ".join(f"`{c}` string" for c in providers.COLUMNS["ieso"])
    row = lambda d, m, v="1": (d, "G", "GAS", m, *[v] * 24)
    out = spark.createDataFrame([row("2020-01-05", "Output"), row("2020-01-05", "Forecast"), row("2020-01-05", None), row("2020-02-01", "Output")], cols)
    got = providers.ieso(out, 2020, 1, spark.createDataFrame([row("2020-01-05", "Capability", "100")], cols)).collect()
    assert [(r["Measurement"], r["Hour 1"]) for r in got] == [("Capability", "100"), ("Output", "1"), (None, "1")]


def test_ieso_yearly_layout(spark):
    df = spark.createDataFrame([("2018-01-01", 1, 10, 20, None, "z"), ("2018-01-01", 2, 11, 21, None, "z"), ("2018-01-01", 2, 99, 99, None, "z"), (None, 1, 5, 5, None, "z")], "date string, hour int, Gen_A int, gen_b int, gen_c int, `Unnamed: 2` string")
    df = df.withColumn("Unnamed: 2", F.lit(1))
    got = {r["Generator"]: r for r in providers.ieso_yearly(df.coalesce(1), "Output").collect()}
    assert sorted(got) == ["GEN_A", "GEN_B", "GEN_C"]
    assert (got["GEN_A"]["Hour 1"], got["GEN_A"]["Hour 2"], got["GEN_A"]["Hour 3"], got["GEN_C"]["Hour 1"]) == (10, 11, None, None)
    assert list(got["GEN_A"].asDict()) == providers.COLUMNS["ieso"]
    with pytest.raises(ContractError):
        providers.ieso_yearly(df.drop("date"), "Output")


def test_adme_hours_end_in_their_month(spark):
    times = ["01-01-2020 00:00", "01-01-2020 01:00", "01-02-2020 00:00", "01-02-2020 01:00"]
    df = spark.createDataFrame([(t, g, "A", 1.0) for t in times for g in ("Solar", "Extra")], "time string, group string, name string, value double")
    assert sorted(values(providers.adme(df, 2020, 1), "time", "group")) == [("01-01-2020 01:00", "Solar"), ("01-02-2020 00:00", "Solar")]
    assert providers.adme(df.replace({"01-01-2020 00:00": "01-01-2021 00:00"}), 2020, 12).count() == 1
    with pytest.raises(ContractError):
        providers.adme_require(df)


def test_ons_cen_eat_epias(spark):
    ons = spark.createDataFrame([(t, *["x"] * 10, 1.0) for t in ("2022-01-31 23:00:00", "2022-02-01 00:00:00")], "din_instante string, " + ", ".join(f"{c} string" for c in providers.COLUMNS["ons"][1:-1]) + ", val_geracao double")
    assert providers.ons(ons, 2022, 1).count() == 1
    with pytest.raises(ContractError):
        providers.cen(ons)
    eat = spark.createDataFrame([("s", "p", "n", "g", "f", "t", d, *[str(i) if i <= n else None for i in range(1, 51)]) for d, n in (("2024-09-29", 46), ("2024-04-07", 50), ("2024-06-01", 48))], ", ".join(f"{c.upper()} string" for c in providers.COLUMNS["eat"]))
    rows = providers.eat_long(providers.eat(eat))
    assert sorted(values(rows.groupBy("trading_date").count(), "trading_date", "count")) == [("2024-04-07", 50), ("2024-06-01", 48), ("2024-09-29", 46)]
    last = {r["trading_date"]: r["s"] for r in rows.groupBy("trading_date").agg(F.max("start").alias("s")).collect()}
    assert last["2024-09-29"] == dt.datetime(2024, 9, 29, 10, 30) and last["2024-04-07"] == dt.datetime(2024, 4, 7, 11, 30)
    a = spark.createDataFrame([tuple("x" for _ in providers.COLUMNS["epias"])], ", ".join(f"{c} string" for c in providers.COLUMNS["epias"]))
    assert providers.epias(a, a.drop("lng")).count() == 2


def rei_doc(spark, epochs, **arrays):
    regions = {r: {"solar": [1.0] * len(epochs)} for r in providers.REGIONS["rei"]} | arrays
    return spark.createDataFrame([(epochs, regions)], "epochs array<bigint>, regions map<string,map<string,array<double>>>")


def test_rei_month_resolution_and_contracts(spark):
    start = int(dt.datetime(2024, 3, 31, 14, tzinfo=dt.UTC).timestamp())  # 23:00 in Tokyo
    epochs = [start + 1800 * i for i in range(6) if i != 4]
    rows = providers.rei(rei_doc(spark, epochs, other={"x": [1.0] * 5}), 2024, 4)
    assert rows.count() == 9 * 3 and rows.agg(F.min("time")).first()[0] == dt.datetime(2024, 4, 1)
    whole = providers.rei(rei_doc(spark, epochs), 2024, 3)
    assert {r["temporal_resolution"] for r in providers.rei_resolution(whole).collect()} == {"30min"}
    with pytest.raises(Exception, match="lacks"):
        doc = rei_doc(spark, epochs)
        providers.rei(doc.withColumn("regions", F.map_filter("regions", lambda k, v: k != "tokyo")), 2024, 4).collect()
    with pytest.raises(Exception, match="differ in length"):
        providers.rei(rei_doc(spark, epochs, tokyo={"solar": [1.0]}), 2024, 4).collect()


def test_entsoe_records(spark):
    s = spark.createDataFrame([("u", dt.datetime(2020, 1, 1), 15, [(1, 5.0), (3, 6.0)])], "unit string, period_start timestamp_ntz, resolution_minutes int, points array<struct<position:int,quantity:double>>")
    assert values(providers.entsoe_records(s, ["unit"]), "timestamp", "quantity") == [(dt.datetime(2020, 1, 1), 5.0), (dt.datetime(2020, 1, 1, 0, 30), 6.0)]


# relational and reshape


def test_null_keys_match_and_clashing_names(spark):
    a = spark.createDataFrame([(1, None, "l"), (1, 2, "l")], "k int, m int, v string")
    b = spark.createDataFrame([(1, None, "r"), (2, 2, "r")], "k int, m int, w string")
    got = relational.join_null_safe(a, b, ["k", "m"])
    assert got.columns == ["k", "m", "v", "w"] and values(got, "k", "m", "w") == [(1, None, "r")]


def test_batches_differ_by_one_at_most(spark):
    sizes = relational.batches(spark.range(2501), "id", 1000).groupBy("batch").count().orderBy("batch")
    assert values(sizes, "batch", "count") == [(1, 834), (2, 834), (3, 833)]
    assert relational.batches(spark.range(0), "id", 10).count() == 0


def test_hours_wide_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 5)], "g string, h int, v int")
    assert sorted(values(reshape.hours_wide(df, ["g"], "h", "v", range(1, 3)), "g", "Hour 1", "Hour 2"), key=str) == [("a", None, None), ("b", 5, None)]


def test_flatten_points_and_arrays(spark):
    series = "array<struct<results:array<struct<unit_code:string,data:array<struct<timestamp:string,value:double>>>>>>"
    df = spark.createDataFrame([("q", [([("U1", [("t1", 1.0), ("t2", None)]), ("U2", [])],)])], f"metric string, series {series}")
    assert values(reshape.flatten_points(df, "series", "results", "data", ["metric"]), "metric", "unit_code", "timestamp", "value") == [("q", "U1", "t1", 1.0), ("q", "U1", "t2", None)]
    a = spark.createDataFrame([([1, 5, 2, 9], [1.0, 2.0, 3.0, 4.0])], "e array<int>, v array<double>")
    assert values(reshape.slice_arrays(a, "e", ["v"], F.lit(1), F.lit(2)), "e", "v") == [([1, 5, 2], [1.0, 2.0, 3.0])]
    assert values(reshape.slice_arrays(a, "e", ["v"], F.lit(100), F.lit(200)), "e", "v") == [([], [])]


def test_mode_ties_go_to_the_smaller_gap(spark):
    at = [0, 60, 180, 240, 360]
    df = spark.createDataFrame([("s", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=x)) for x in at], "s string, ts timestamp_ntz")
    assert values(quality.mode_gap(df, ["s"], "ts"), "gap") == [(1,)]
    assert values(quality.irregular(df, ["s"], "ts"), "irregular") == [(True,)]


def test_availability(spark):
    rows = [("a", "2020-01-15", True, None), ("a", "2021-01-15", False, None), ("a", "2019-06-15", True, None), ("b", "2020-01-15", False, None), ("c", "2020-01-15", None, "404"), ("c", "2021-01-15", None, "404")]
    got = {r["zone"]: r for r in quality.availability(spark.createDataFrame(rows, "zone string, date string, has_data boolean, status string")).collect()}
    assert (got["a"]["hit_dates"], got["a"]["n_misses"], got["a"]["first_year"], got["a"]["last_year"]) == (["2019-06-15", "2020-01-15"], 1, 2019, 2020)
    assert (got["b"]["has_any_data"], got["b"]["first_hit"], got["b"]["errors"]) == (False, None, {})
    assert (got["c"]["errors"], got["c"]["n_misses"]) == ({"404": 2}, 0)
    listing = quality.zone_listing(quality.availability(spark.createDataFrame(rows, "zone string, date string, has_data boolean, status string")), 2020)
    assert [tuple(r) for r in listing.collect()] == [("a", 2019, None)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert contracts.require(df, ["a"]).columns == ["a", "b"] and contracts.project(df, ["b"]).columns == ["b"]
    with pytest.raises(IncompleteError):
        contracts.require_total(df, 2)
    assert contracts.counted_drop_null(df, "b", "seen").count() == 0


# functions


def test_text_functions(spark):
    cells = [("1d", None), (" 12.5 ", 12.5), ("1e3", 1000.0), ("", None), (None, None), ("94.4%", None)]
    assert [r[0] for r in spark.createDataFrame([(c,) for c, _ in cells], "c string").select(text.to_number(F.col("c"))).collect()] == [v for _, v in cells]
    messages = ["token=SECRET_T", "password='SECRET_P'", "{'token': 'SECRET_T', 'username': 'USER', 'Key': \"SECRET_K\"}"]
    masked = [r[0] for r in spark.createDataFrame([(m,) for m in messages], "m string").select(text.mask_secrets(F.col("m"))).collect()]
    assert not any("SECRET" in m for m in masked) and all("******" in m for m in masked) and "USER" in masked[2]
    codes = spark.createDataFrame([("status code: 404",), ("error 503 here",), ("nothing 12",)], "m string").select(text.http_status(F.col("m")))
    assert [r[0] for r in codes.collect()] == [404, 503, None]
    assert spark.range(1).select(text.between(F.lit("<a></a><b>COAL</b>"), "<b>", "</b>"), text.between(F.lit("x"), "<b>", "</b>")).first()[:] == ("COAL", None)
    assert spark.range(1).select(text.alias_of(F.lit(" Europe "), {"europe": "eu"})).first()[0] == "eu"
    assert spark.range(1).select(text.present(F.lit("a"), F.lit(1)), text.present(F.lit("a"), F.lit(" ")), text.present(F.lit(None))).first()[:] == (True, False, False)


def test_dates_and_resolutions(spark):
    dates = [("2020-01-01", True), ("2020-01", True), ("2020", True), ("20200101", False), ("invalid", False), ("", False), ("2020-02-31", False), (None, False)]
    assert [r[0] for r in spark.createDataFrame([(d,) for d, _ in dates], "d string").select(tf.valid_date(F.col("d"))).collect()] == [v for _, v in dates]
    res = [("1h", True), ("30min", True), ("1d", True), ("5days", False), ("invalid", False), ("", False)]
    assert [r[0] for r in spark.createDataFrame([(d,) for d, _ in res], "d string").select(tf.valid_resolution(F.col("d"))).collect()] == [v for _, v in res]
    gaps = [(60.0, "1h"), (30.0, "30min"), (5.5, None), (61.0, None), (0.0, None)]
    assert [r[0] for r in spark.createDataFrame([(g,) for g, _ in gaps], "g double").select(tf.from_minutes(F.col("g"))).collect()] == [v for _, v in gaps]


# plans


def test_spine_stops_yesterday(spark):
    days = tf.spine(spark, [2025], "day", TODAY)
    assert days.count() == 31 and days.agg(F.max("date")).first()[0] == "2025-01-31"
    assert values(tf.spine(spark, [2025, 2030], "month", TODAY), "date") == [("2025-01",)]
    assert values(tf.spine(spark, [2024, 2025], "year", TODAY), "date") == [("2024",), ("2025",)]
    with pytest.raises(RequestError):
        tf.spine(spark, [2026], "day", TODAY)


def test_source_plans(spark):
    plan = tasks.source_plan(spark, "aemo", [2025], TODAY)
    assert sorted(values(plan.groupBy("temporal_resolution").count(), "temporal_resolution", "count")) == [("1h", 1), ("5min", 31)]
    zoned = tasks.source_plan(spark, "entsoe", [2014, 2025], TODAY, zones=tables.zones(spark))
    assert {r[0] for r in zoned.filter("year = 2014").select("bidding_zone").distinct().collect()} == {r["zone"] for r in tables.zones(spark).filter("start = 2014").collect()}
    assert zoned.first()["identifier"].count("|") == 2
    for bad in (lambda: tasks.source_plan(spark, "aemo", [2025], TODAY, ["2h"]), lambda: tasks.source_plan(spark, "eia", [2001], TODAY), lambda: tasks.valid(spark.createDataFrame([("2020-02-31", "1h")], "date string, temporal_resolution string"))):
        with pytest.raises(RequestError):
            bad()
    months = spark.createDataFrame([("2020-01",), ("2020-03",), ("2020-04",), ("2020-12",)], "date string")
    assert [r[0] for r in months.select(tasks.fiscal_source_year(F.col("date"))).collect()] == [2019, 2019, 2020, 2020]
    assert [r[0] for r in spark.createDataFrame([("2019-04",), ("2019-05",)], "date string").select(tasks.route("ieso", F.col("date"))).collect()] == ["yearly", "monthly"]


def test_failure_matrix(spark):
    cases = [("http", None, 2020, 0, 3), ("http", 500, 2020, 0, 3), ("http", 404, 2020, 1, 0), ("http", 401, 2020, 0, 6), ("http", 429, 2020, 0, 6), ("http", 400, 2020, 1, 0), ("missing", None, 2020, 1, 0), ("missing", None, 2025, 0, 0), ("success", None, 2025, 1, 0), ("other", None, 2020, 0, 0), ("timeout", None, 2020, 0, 3)]
    df = spark.createDataFrame([c[:3] for c in cases], "kind string, code int, year int")
    status, waits, ends = tasks.outcome(F.col("kind"), F.col("code"), F.col("year"), 2025)
    assert [tuple(r) for r in df.select(status, waits, ends).collect()] == [(c[3], c[4], False) for c in cases]
    assert spark.createDataFrame([("structure", None, 1)], "kind string, code int, year int").select(ends).first()[0]
    assert [tasks.refusal_wait(n) for n in range(1, 7)] == [15, 42, 77, 120, 167, 220]


def test_state_versions_and_resume(spark, tmp_path):
    folder = str(tmp_path / "state")
    assert sinks.read_state(spark, folder).count() == 0
    first = spark.createDataFrame([("a", 1), ("b", 0)], "identifier string, status int")
    sinks.write_state(first, folder)
    sinks.write_state(tasks.merge_state(sinks.read_state(spark, folder), spark.createDataFrame([("b", 1), ("a", 0), ("c", 0)], "identifier string, status int")), folder)
    assert sorted(values(sinks.read_state(spark, folder), "identifier", "status")) == [("a", 1), ("b", 1), ("c", 0)]
    plan = spark.createDataFrame([("a",), ("c",), ("d",)], "identifier string")
    assert sorted(values(tasks.remaining(plan, sinks.read_state(spark, folder)), "identifier")) == [("c",), ("d",)]


def test_weather_plans_requests_and_paths(spark):
    assert weather.era5_plan(spark, [2024], TODAY, pressure=[]).count() == 24 and weather.era5_plan(spark, [2024], TODAY, model=["137"]).count() == 24
    plan = weather.barra_plan(spark, [2024], TODAY, ["tas"], ["ta"], [500, 850, 1000], ["orog"], "R2")
    assert sorted(values(plan.groupBy("ord").count(), "ord", "count")) == [(0, 1), (1, 12), (2, 36)]
    assert plan.filter("ord = 1").first()["level"] == ""
    url = [r[0] for r in plan.filter("ord = 0 or (ord = 2 and month = '01' and level = '500')").orderBy("ord").select(weather.barra_url("https://h/thredds/dodsC/x/v1", "R2")).collect()]
    assert url[0] == "https://h/thredds/fileServer/x/v1/fx/orog/latest/orog_AUS-11_ERA5_historical_hres_BOM_BARRA-R2_v1.nc"
    assert url[1].endswith("/1hr/ta500/latest/ta500_AUS-11_ERA5_historical_hres_BOM_BARRA-R2_v1_1hr_202401-202401.nc")
    era = weather.era5_requests(weather.era5_plan(spark, [2020], TODAY, ["1000", "950"], ["135", "136", "137"]).filter("month = '01'"), ["t"], ["1000", "950"], ["135", "136", "137"], [10, 0, 0, 10])
    got = {r["level_type"]: json.loads(r["request"]) for r in era.collect()}
    assert len(got["single"]["day"]) == 31 and len(got["single"]["time"]) == 24 and got["pressure"]["pressure_level"] == ["1000", "950"]
    assert got["model"]["date"] == "2020-01-01/to/2020-01-31" and got["model"]["levellist"] == "135/136/137" and got["model"]["area"] == "10/0/0/10"
    icon = weather.short_codes(weather.icon_plan(spark, [2024], TODAY, ["temperature", "T_2M"]), tables.icon_variables(spark))
    assert {r["variable"] for r in icon.collect()} == {"T", "T_2M"}
    assert weather.barra_variables(None, ["a", "b"], ["b"], ["orog"]) == ["b", "orog"]
    assert weather.default_levels(None, None) == (["1000", "975", "950"], None)
    name = weather.era5_plan(spark, [2020], TODAY).filter("month = '01' and level_type = 'pressure'").select(weather.era5_path(["t", "u"], ["1000"], tables.ERA5_PRESSURE_LEVELS)).first()[0]
    assert name == "era5_2020_01_pl_1000_t-u.grib"


def test_catalogue_sizes(spark):
    assert tables.zones(spark).count() == 38 and tables.zones(spark).agg(F.min("start")).first()[0] == 2014
    assert tables.icon_variables(spark).groupBy("level_type").count().orderBy("level_type").collect() == [("model", 8), ("single", 17)]
    assert (tables.for_model(tables.barra_levels(spark), "R2").count(), tables.for_model(tables.barra_levels(spark), "C2").count()) == (10, 14)
    assert (len(tables.ERA5_PRESSURE_LEVELS), len(tables.ERA5_MODEL_LEVELS)) == (37, 137)
    assert tables.validate(["10YBE----------2"], tables.zones(spark), "zone", "zone")
    with pytest.raises(RequestError, match="nowhere"):
        tables.validate(["nowhere"], tables.zones(spark), "zone", "zone")


# readers and sinks


def test_csv_shapes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("note\nnote\n\nh1,h2\n1,x\n2,\"y,z\"\n")
    assert values(readers.csv_after_preamble(spark, str(tmp_path / "a.csv"), "h1 int, h2 string", 3), "h1", "h2") == [(1, "x"), (2, "y,z")]
    (tmp_path / "b.csv").write_text("/;Solar;;Eólico\nFecha;A;B;A\n01-01-2020 00:00;1;2;3\n")
    assert values(readers.csv_two_headers(spark, str(tmp_path / "b.csv")), "time", "group", "name", "value") == [("01-01-2020 00:00", "Solar", "A", "1"), ("01-01-2020 00:00", "Solar", "B", "2"), ("01-01-2020 00:00", "Eólico", "A", "3")]
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("in.csv", "a,b\n1,2\n3,4\n")
    assert values(readers.zip_csv(spark, str(tmp_path / "c.zip"), "a int, b int"), "a", "b") == [(1, 2), (3, 4)]
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("in.csv", "a\n")
        z.writestr("more.csv", "a\n")
    with pytest.raises(Exception, match="holds"):
        readers.zip_csv(spark, str(tmp_path / "d.zip"), "a int").collect()
    with pytest.raises(RequestError):
        readers.load(spark, "x.txt")


def workbook_bytes(sheets):
    out, ns = io.BytesIO(), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>shared</t></si></sst>")
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>' for c, v in enumerate(row) if v is not None) + "</row>" for r, row in rows.items())
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(workbook_bytes({"Other": {1: ["x"]}, "GPF": {4: ["Fecha", "Hydro A", "GPF", "cut"], 5: ["d1", 1.5, 2, 3], 7: ["d2", None, 2]}}))
    df = readers.workbook(spark, str(tmp_path / "w.xlsx"), ["Missing", "GPF"], header=3, until="GPF")
    assert df.columns == ["Fecha", "Hydro A"] and [tuple(r) for r in df.na.drop("all").collect()] == [("d1", "1.5"), ("d2", None)]
    with pytest.raises(ContractError):
        readers.workbook(spark, str(tmp_path / "w.xlsx"), ["Nope"])


def test_names_with_months(spark):
    df = spark.createDataFrame([("(hourly) - 2020-01.zip",), ("(hourly) - 2020-11 - 2021-01.zip",), ("none",)], "n string")
    assert [r[0] for r in df.select(readers.months_in_name(F.col("n"))).collect()] == [["2020-01"], ["2020-11", "2020-12", "2021-01"], None]


def test_paging(spark):
    calls = []

    def fetch(key, offset, size):
        calls.append((offset, size))
        return [(key, i) for i in range(offset, min(6000, offset + size))], 6000

    assert len(list(readers.read_pages(fetch, "k", 5000))) == 6000 and calls == [(0, 5000), (5000, 5000)]
    with pytest.raises(IncompleteError):
        list(readers.read_pages(lambda k, o, s: ([(1,)], 2), "k", 5000))

    def shaky(key, offset, size):
        if size > 3000:
            raise ConnectionError("500")
        return [(key, i) for i in range(offset, min(4000, offset + size))], None

    assert len(list(readers.read_pages(shaky, "k", 10_000, 3))) == 4000
    with pytest.raises(ConnectionError):
        list(readers.read_pages(shaky, "k", 10_000, 1))
    from pyspark import cloudpickle

    assert cloudpickle.dumps(fetch)
    df = readers.paged(spark, lambda key, offset, size: ([(key, i) for i in range(offset, min(7, offset + size))], 7), ["a", "b"], "key string, i int", size=3)
    assert df.groupBy("key").count().orderBy("key").collect() == [("a", 7), ("b", 7)]


def test_partitioned_sink_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda d, v: spark.createDataFrame([(d, "1h", "z", v)], "date string, temporal_resolution string, bidding_zone string, v int")
    sinks.save(rows("2020-01", 1), path)
    sinks.save(rows("2020-02", 2), path)
    sinks.save(rows("2020-01", 3), path)
    assert sorted(values(spark.read.csv(path, header=True, inferSchema=True), "date", "v")) == [("2020-01", 3), ("2020-02", 2)] or spark.read.csv(path, header=True).count() == 2
    with pytest.raises(RequestError):
        sinks.save(rows("2020-01", 1), path, "xml")


# streaming


def test_snapshots(spark, tmp_path):
    row = ["<A NAME='coal'></A><b>COAL</b>", "", "Linkou#1", "800.0", "755.4", "94.425%", " ", ""]
    sub = [*row[:2], "Subtotal", *row[3:]]
    unnamed = [*row[:2], None, "-", "x", "", "", ""]
    source = tmp_path / "in"
    source.mkdir()
    write = lambda name, at, rows: (source / name).write_text(json.dumps({"": at, "dataset": rows}))
    write("a.json", "2026-01-29 21:00", [row, sub, unnamed, row[:7]])
    args = (spark, str(source), str(tmp_path / "out"), str(tmp_path / "ck"))
    snapshots.follow(*args).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(values(got, "fueltype", "name", "output"), key=str) == [("COAL", "Linkou#1", 755.4), ("COAL", None, None)]
    write("b.json", "2026-01-29 21:10", [row])
    snapshots.follow(*args).awaitTermination()
    snapshots.follow(*args).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    raw = snapshots.rows_of(spark.read.schema(snapshots.DOCUMENT).option("multiLine", True).json(str(source)))
    assert snapshots.misfits(raw).count() == 2


# what the queries do not reach


def test_tally_union_and_fields_with_nulls(spark):
    from gridloom.operators import quality, relational, reshape

    df = spark.createDataFrame([(1, 5.0, '{"k": 1}'), (1, None, "{}"), (2, None, None), (3, 1.0, "no json")], "k long, v double, j string")
    got = {r["k"]: tuple(r)[1:] for r in quality.tally(df, ["k"], {"n": F.col("v") > 2}, {"any": F.col("v") > 2}, {"all": F.col("v") > 2}).collect()}
    assert got == {1: (1, True, True), 2: (0, None, None), 3: (0, False, False)}
    assert sorted(values(relational.distinct_union("x", (df, "k"), (df, "k")), "x")) == [(1,), (2,), (3,)]
    assert [r["f"] for r in reshape.json_fields(df, "j", {"f": "$.k"}, "-").collect()] == ["1", "-", "-", "-"]


def test_lookups_of_files_name_what_is_odd(spark):
    from gridloom.plans import tasks

    row = "temporal_resolution string, position int, kind string, id string, name string"
    good = [("1h", 1, "file", "a", "x 2020-01 to 2020-03.zip"), ("1h", 2, "file", "b", "x 2020-02.zip"), ("1h", 3, "folder", "c", "2020-02"), ("5min", 1, "file", "d", "x 2020-02.zip")]
    got = {(r["temporal_resolution"], r["date"]): r["id"] for r in tasks.file_lookup(spark.createDataFrame(good, row)).collect()}
    assert got == {("1h", "2020-01"): "a", ("1h", "2020-02"): "b", ("1h", "2020-03"): "a", ("5min", "2020-02"): "d"}
    for name in ("none.zip", "2020-01 2020-02 2020-03.zip"):
        with pytest.raises(Exception, match="no month or too many"):
            tasks.file_lookup(spark.createDataFrame([("1h", 1, "file", "a", name)], row)).collect()


def test_bulk_lookups_and_pages_with_a_fallback(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(25), 3, None]], "id long")
    got = readers.fetch_batches(ids, "id", 10, lambda some: [(len(some), i) for i in some], "n long,id long").collect()
    assert sorted(r["id"] for r in got) == list(range(25)) and sorted({r["n"] for r in got}) == [8, 9]
    pages = spark.createDataFrame([('<a href="T/">T/</a><a href="U_10M/">',), ("<a href='../'>",), (None,)], "html string")
    assert [r[0] for r in pages.select(readers.variables_in_page(F.col("html"), ["B", "A"])).collect()] == [["T", "U_10M"], ["A", "B"], ["A", "B"]]


def test_trailing_delimiters_are_dropped(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x,\n2,y,\n")
    assert [tuple(r) for r in readers.load(spark, f"{tmp_path}/x.csv", schema="a int, b string").collect()] == [(1, "x"), (2, "y")]


def test_series_of_no_known_step_are_an_error(spark, tmp_path):
    import datetime as dt

    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h)) for h in (0, 7, 14)], "k string, time timestamp_ntz")
    with pytest.raises(Exception, match="no resolution of 25200"):
        sinks.save_by_step(rows, ["k"], "time", f"{tmp_path}/out")


def test_sources_register_and_skip_what_is_settled(spark, tmp_path):
    from gridloom.plans import tasks
    from gridloom.sources import protocol

    asked = []

    class Toy(protocol.Source):
        name, columns = "toy", ["v"]

        def plan(self, spark):
            return tasks.with_identity(spark.createDataFrame([("2023-01-01", "1h"), ("2024-01-01", "1h"), ("2024-01-02", "1h")], "date string, temporal_resolution string"))

        def read(self, spark, open_tasks):
            asked.append(sorted(r["date"] for r in open_tasks.collect()))
            return open_tasks.filter("date = '2024-01-01'").select("identifier", F.lit(1).alias("v"))

    assert protocol.source("toy") is Toy
    with pytest.raises(RequestError):
        protocol.source("nothing")
    for _ in range(2):
        state = protocol.run(spark, Toy(), f"{tmp_path}/out", f"{tmp_path}/state", 2024)
    assert asked == [["2023-01-01", "2024-01-01", "2024-01-02"], ["2024-01-02"]]  # of this year, and without rows: again
    assert {r["identifier"][5:15]: r["status"] for r in state.collect()} == {"2023-01-01": 1, "2024-01-01": 1, "2024-01-02": 0}
