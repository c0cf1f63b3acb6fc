"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workers

#: Bytes of a batch that a Python worker gets, about: Spark's 64 MB (or 10,000 rows) is held by the executor, by its
#: buffers outside the heap and by the worker at once, for each task, and what is freed is not given back.
BATCH = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"

_folders: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, and hold the batches that they get to BATCH bytes, unless the session
    says how large these are."""
    workers.ship(spark)
    if spark.conf.get(_BATCHES, None) is None:
        spark.conf.set(_BATCHES, f"{BATCH}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the cluster's shared checkpoint folder and drop the lineage.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset a local session, as in tests, gets one; on
    a cluster it is an error.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like cut, as a table of columns: for what is read more than once, or in part. Row order and the number of
    partitions are not kept."""
    to = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)


def held(df: DataFrame) -> DataFrame:
    """Like stored, for narrow rows: in blocks on the disks of two executors, from where Spark serves them to all; they go
    when nothing refers to them any more. If both copies are lost, later reads fail.

    Where Hadoop's native library is missing, a table in a local folder costs three processes (chmod) for each file, and
    each of them shares the executor's memory until it has started; blocks cost none.
    """
    return df.localCheckpoint(True, StorageLevel.DISK_ONLY_2)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and the executors share")
    if spark.sparkContext.applicationId not in _folders:
        _folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="gridloom-")
    return _folders[spark.sparkContext.applicationId]


def key_parts(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """``k1, k2``: 128 bits that name a row by its id and text; rows equal in both share them."""
    return [F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias(name) for name, seed in (("k1", 17), ("k2", 0x5BD1E995))]


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The parts of a row's key as one struct."""
    return F.struct(*key_parts(id_col, text_col))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names behind so many underscores that no column of df bears one of them, in any case."""
    taken, lead = {c.lower() for c in df.columns}, "__"
    while any((lead + n).lower() in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


#: The type of a row's key in schemas.
KEY = "struct<k1: bigint, k2: bigint>"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
