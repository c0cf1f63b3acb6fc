import pyarrow as pa
import pytest
from gridloom.llm import common

CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(CONF, None)
    spark.conf.unset(CONF)
    yield
    spark.conf.unset(CONF) if before is None else spark.conf.set(CONF, before)


def test_workers_get_bounded_batches_of_all_rows(spark, unset, tmp_path):
    """3,000 texts of 10 KB were one batch of 30 MB, by their number."""

    def sizes(batches):  # pickled by value
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(substr(md5(cast(id AS string)), 1, 10), 1000) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    got = common.table(spark, str(tmp_path), "documents").coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 3000 and sum(r["size"] for r in got) > 30_000_000
    assert max(r["size"] for r in got) < common.BATCH + 20_000


def test_a_session_s_own_size_of_batches_stays(spark, unset):
    spark.conf.set(CONF, "1m")
    common.ship(spark)
    assert spark.conf.get(CONF) == "1m"
