"""Live snapshots as an append-only file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators.contracts import arity_differs
from ..operators.relational import differs
from ..operators.reshape import by_position

# Columns of a snapshot row, in order of position.
COLUMNS = ["fueltype", "fueltype_subcategory", "name", "capacity", "output", "percentage", "remark_xi", "additional_3"]
DOCUMENT = "`` string, dataset array<array<string>>"


def rows_of(documents: DataFrame) -> DataFrame:
    """``time, row`` of snapshot documents, whose nameless key holds the local time."""
    at = F.to_timestamp_ntz(F.col("``"), F.lit("yyyy-MM-dd HH:mm"))
    return documents.select(at.alias("time"), F.explode("dataset").alias("row"))


def clean(rows: DataFrame) -> DataFrame:
    """Named, typed unit rows. Subtotals go, a null name stays; rows of another arity are left to ``misfits``."""
    got = by_position(rows.filter(~arity_differs("row", len(COLUMNS))), "row", COLUMNS, ["time"])
    got = got.withColumns({"fueltype": text.between(F.col("fueltype"), "<b>", "</b>"), "capacity": text.to_number(F.col("capacity")), "output": text.to_number(F.col("output"))})
    return got.filter(differs(F.col("name"), "Subtotal"))


def misfits(rows: DataFrame) -> DataFrame:
    """Rows to keep raw: of another arity, or with no number where both should be."""
    unread = text.to_number(F.get("row", F.lit(3))).isNull() & text.to_number(F.get("row", F.lit(4))).isNull()
    return rows.filter(arity_differs("row", len(COLUMNS)) | unread)


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new in ``folder`` to ``out``, by date; a file is read once, however often this is called."""
    docs = spark.readStream.schema(DOCUMENT).option("multiLine", True).json(folder)
    rows = clean(rows_of(docs)).withColumn("date", F.date_format("time", "yyyy-MM-dd"))
    return rows.writeStream.format("parquet").partitionBy("date").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
