import json

import pytest
from gridloom import __main__ as cli
from gridloom import config
from gridloom.errors import RequestError


def test_pairs_and_merge(tmp_path):
    assert config.parse_pairs(["a.b=x", "a.c=none", "d=1=2"]) == {"a": {"b": "x", "c": None}, "d": "1=2"}
    for bad in (["a=1", "a.b=2"], ["a.b=2", "a=1"], ["a"], ["=1"]):
        with pytest.raises(RequestError):
            config.parse_pairs(bad)
    (tmp_path / "x.json").write_text(json.dumps({"paths": {"out": "o", "log": "None"}, "n": 1}))
    assert config.load(config.find(tmp_path, "x"), ["paths.out=p"]) == {"paths": {"out": "p", "log": None}, "n": 1}
    with pytest.raises(RequestError):
        config.find(tmp_path, "y")


@pytest.mark.parametrize(
    ("args", "n"),
    [
        ("zones", 38),
        ("plan eia --years 2024 --today 2024-03-01", 60),
        ("plan entsoe --years 2024 --today 2024-01-03 --zones 10YBE----------2 10YES-REE------0", 4),
        ("weather era5 --years 2024 --today 2025-01-01 --model-levels", 24),
        ("weather icon --years 2024 --today 2025-01-01 --variables temperature pressure", 24),
        ("weather barra --years 2024 --today 2025-01-01 --variables tas ta", 2 + 12 + 24),
        ("weather barra --years 2024 --today 2025-01-01 --variables 1.5m_temperature temperature --requests", 2 + 12 + 24),
        ("weather icon --years 2024 --today 2025-01-01", 25 * 12),
        ("weather icon --years 2024 --today 2025-01-01 --variables T --requests -o urls.base=https://host/x", 12),
        ("weather era5 --years 2024 --today 2025-01-01 --model-levels --requests --area 10 0 -10 20", 24),
        ("weather era5 --years 2024 --today 2025-01-01 --variables 2t --pressure-levels --requests", 12),
        ("variables barra", 127),
        ("variables era5", 61),
        ("variables icon", 25),
    ],
)
def test_command_line_plans(spark, args, n):
    assert cli.frame(spark, cli.parser().parse_args(args.split())).count() == n


def test_resume_and_unknown_zones(spark, tmp_path):
    from gridloom.sources import sinks

    one = cli.frame(spark, cli.parser().parse_args("plan eia --years 2024 --today 2024-01-03".split()))
    sinks.write_state(one.limit(1).selectExpr("identifier", "1 AS status"), str(tmp_path))
    for extra, n in (("", 1), (" --no-resume", 2)):
        assert cli.frame(spark, cli.parser().parse_args(f"plan eia --years 2024 --today 2024-01-03 --state {tmp_path}{extra}".split())).count() == n
    with pytest.raises(RequestError):
        cli.frame(spark, cli.parser().parse_args("plan entsoe --years 2024 --zones nowhere".split()))


def test_dry_run_requests(spark):
    args = "weather era5 --years 2020 --today 2020-02-01 --variables temperature 2m_temperature --pressure-levels 1000 --model-levels 137 --requests --area 10 0 -10 20"
    rows = {r["level_type"]: r for r in cli.frame(spark, cli.parser().parse_args(args.split())).collect()}
    got = {k: json.loads(r["request"]) for k, r in rows.items()}
    assert got["single"]["variable"] == ["2t"] and got["pressure"]["variable"] == ["t"] and got["model"]["param"] == "t"
    assert got["model"]["leveltype"] == "ml" and got["single"]["area"] == ["10.0", "0.0", "-10.0", "20.0"]
    assert rows["pressure"]["path"] == "era5_2020_01_pl_1000_t.grib" and rows["single"]["path"] == "era5_2020_01_sl_2t.grib"
    with pytest.raises(RequestError, match="nothing"):
        cli.frame(spark, cli.parser().parse_args("weather icon --years 2024 --variables nothing".split()))
    with pytest.raises(RequestError):
        cli.frame(spark, cli.parser().parse_args("weather barra --years 2024 --pressure-levels 750".split()))


def test_catalogues(spark):
    from gridloom.catalog import tables

    default = {s: tables.variables(spark, s).filter("is_default").select("variable").distinct().count() for s in tables.DEFAULTS}
    assert default == {s: len(v) for s, v in tables.DEFAULTS.items()} == {"barra": 42, "icon": 25, "era5": 21}
    assert tables.zones(spark).filter("zone = '10YBE----------2'").first()["alias"] == "Belgium"
    two = tables.barra_variables(spark).filter("code = 'prc'").first()
    assert (two["variable"], two["models"]) == ("convective_precipitation", ["R2"])
