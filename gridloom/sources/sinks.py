"""Partitioned sinks and the state of tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RequestError

KEYS = ["temporal_resolution", "bidding_zone", "date"]


def save(df: DataFrame, path: str, kind: str = "csv", keys: list[str] | None = None) -> None:
    """Writes by key, replacing only the partitions that the rows belong to."""
    if kind not in ("csv", "json", "parquet"):
        raise RequestError(f"no sink for {kind}")
    keys = [k for k in (KEYS if keys is None else keys) if k in df.columns]
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w = w.partitionBy(*keys) if keys else w
    (w.option("header", True) if kind == "csv" else w).format(kind).save(path)


def split_by_resolution(df: DataFrame, column: str, path: str, kind: str = "csv") -> int:
    """Drops rows without a resolution, names it (PT60M: 1h) and writes a partition for each. Returns how many rows were
    dropped, as the writing job counted them."""
    from pyspark.sql import Observation

    from ..functions.time import from_iso_duration

    c, seen = F.col(f"`{column}`"), Observation()
    counted = df.observe(seen, F.count_if(c.isNull()).alias("dropped"))
    save(counted.filter(c.isNotNull()).withColumn("temporal_resolution", from_iso_duration(c)), path, kind, ["temporal_resolution"])
    return seen.get["dropped"]


def save_by_step(rows: DataFrame, keys: list[str], time: str, path: str, kind: str = "json") -> None:
    """Routes each series to a partition by the resolution that its commonest step shows; a series of no known
    resolution is an error."""
    from ..functions.time import from_minutes
    from ..operators.quality import mode_gap
    from ..operators.relational import join_null_safe

    step = mode_gap(rows, keys, time, unit=1)
    named = F.coalesce(from_minutes(F.col("gap") / 60), F.raise_error(F.concat(F.lit("no resolution of "), F.col("gap").cast("string"), F.lit(" seconds"))))
    save(join_null_safe(rows, step.select(*keys, named.alias("temporal_resolution")), keys), path, kind, ["temporal_resolution"])


def task_path(*, zone: bool = True):
    """Relative path of a task: resolution, zone if there is one, date."""
    return F.concat_ws("/", "temporal_resolution", *(["bidding_zone"] if zone else []), "date")


def write_state(state: DataFrame, folder: str) -> None:
    """A new version beside the old ones; it counts once Spark has committed it."""
    spark = state.sparkSession
    versions = [v for v, _ in _versions(spark, folder)]
    state.write.parquet(f"{folder}/v{max(versions, default=0) + 1:08d}-{uuid.uuid4().hex}")


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """The newest committed version; empty if there is none."""
    done = sorted(_versions(spark, folder))
    return spark.read.parquet(done[-1][1]) if done else spark.createDataFrame([], "identifier string, status int")


def _versions(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path)]
    return [(int(p.getName()[1:9]), p.toString()) for p in names if p.getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
