"""What a source is made of, and how its open tasks are run as one job."""

from __future__ import annotations

from abc import ABC, abstractmethod
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RequestError
from ..operators import contracts
from ..plans import tasks
from . import sinks

_SOURCES: dict[str, type[Source]] = {}


class Source(ABC):
    """A publication. ``plan`` names its tasks (with ``identifier``), ``read`` gives the raw rows of many tasks at once,
    each with the identifier of its own, ``transform`` shapes them; ``columns`` is what must come out. ``save`` may be
    replaced, for sources that are split or routed when they are written. Naming a class registers it."""

    name: ClassVar[str]
    columns: ClassVar[list[str]]

    def __init_subclass__(cls, **kwargs) -> None:
        super().__init_subclass__(**kwargs)
        if getattr(cls, "name", None):
            _SOURCES[cls.name] = cls

    @abstractmethod
    def plan(self, spark: SparkSession) -> DataFrame: ...

    @abstractmethod
    def read(self, spark: SparkSession, open_tasks: DataFrame) -> DataFrame: ...

    def transform(self, raw: DataFrame) -> DataFrame:
        return raw

    def validate(self, spark: SparkSession) -> None:
        """Fails on a request for what the source does not have."""

    def save(self, rows: DataFrame, path: str) -> None:
        sinks.save(rows, path, "parquet", ["identifier"])


def source(name: str) -> type[Source]:
    if name not in _SOURCES:
        raise RequestError(f"no source {name}")
    return _SOURCES[name]


def run(spark: SparkSession, of: Source, path: str, state_folder: str, this_year: int, resume: bool = True) -> DataFrame:
    """Reads, shapes and writes all open tasks of a source in one job, then writes a new version of its state, which is
    returned: tasks with rows are settled, tasks without are settled if their year is over."""
    of.validate(spark)
    state = sinks.read_state(spark, state_folder)
    plan = tasks.valid(of.plan(spark))
    open_tasks = tasks.remaining(plan, state) if resume else plan
    rows = of.transform(of.read(spark, open_tasks))
    of.save(contracts.project(rows, ["identifier", *of.columns], of.name), path)
    had = rows.select("identifier").distinct().withColumn("kind", F.lit("success"))
    tried = open_tasks.select("identifier", "year").join(had, "identifier", "left").withColumn("kind", F.coalesce("kind", F.lit("missing")))
    status, _, _ = tasks.outcome(F.col("kind"), F.lit(None).cast("int"), F.col("year"), this_year)
    sinks.write_state(tasks.merge_state(state, tried.select("identifier", status.cast("int").alias("status"))), state_folder)
    return sinks.read_state(spark, state_folder)
