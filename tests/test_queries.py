"""Every query with SQL of its own against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest
from gridloom import queries_sources  # noqa: F401 (registers its queries)
from gridloom.operators import relational
from gridloom.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = duck.execute(ORACLES[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert norm(tuple(r) for r in df.select(*columns).collect()) == norm(got.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_the_whole_null_safe_join_has_every_customer_once(spark, duck):
    rows = QUERIES["null_safe_multi_key_join"](spark, DATA).collect()
    assert sorted(r["c_custkey"] for r in rows) == [r[0] for r in duck.execute("SELECT c_custkey FROM customer ORDER BY 1").fetchall()]
    groups = {(r["nation"], r["segment"]): r["n"] for r in rows}
    assert sum(groups.values()) == len(rows) and any(None in g for g in groups)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_the_whole_dimension_join_has_every_line_of_known_parts(spark, duck):
    assert QUERIES["dim_fact_join"](spark, DATA).count() == duck.execute("SELECT count(*) FROM lineitem").fetchone()[0]


def test_facts_without_a_dimension_drop_out(spark):
    facts = spark.createDataFrame([(1, 7), (2, 8), (3, None), (4, 7)], "line long, part long")
    parts = spark.createDataFrame([(7, "seven"), (9, "nine")], "part long, name string")
    rows = relational.with_dimension(facts, parts, "part", ["line", "name"], ["line"]).collect()
    assert [tuple(r) for r in rows] == [(1, "seven"), (4, "seven")]


def test_entry_imports_without_the_llm_folder(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "gridloom", tmp_path / "gridloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == [str(len(QUERIES))] * 2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_python_workers_get_the_package_when_only_the_driver_has_it(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print(*[e.queries()[q](spark, {DATA!r}).count() for q in ("paged_rows", "zipped_csv", "workbook_cells")])
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr[-2000:]
    assert said.stdout.split() == ["25", "25", "26"]
