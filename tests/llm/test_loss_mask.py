import os

import duckdb
import pytest
from gridloom.llm import chat, queries
from gridloom.llm.oracles import ORACLES
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def test_op2_chat_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    got = con.execute(ORACLES["op2_chat"])
    columns = [c[0] for c in got.description]
    rows = queries.op2_chat(spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(got.fetchall(), key=repr)


def test_loss_columns_come_from_the_mask(spark, monkeypatch):
    render = chat.render
    moved = F.transform("loss_mask", lambda s: F.struct(s["start"].alias("start"), (s["end"] - F.least(F.lit(1), s["end"] - s["start"])).alias("end")))
    right = {r["conv_id"]: r for r in queries.op2_chat(spark, DATA).collect()}
    monkeypatch.setattr(chat, "render", lambda m: render(m).withColumn("loss_mask", moved))
    wrong = {r["conv_id"]: r for r in queries.op2_chat(spark, DATA).collect()}
    learned = [c for c, r in right.items() if r["loss_chars"]]
    assert -1 in learned and all(wrong[c]["loss_sha256"] != right[c]["loss_sha256"] for c in learned)
    assert all(wrong[c]["formatted_chars"] == r["formatted_chars"] for c, r in right.items())
