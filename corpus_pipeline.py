"""A training corpus from ``documents``: five stages, each written as Parquet and reread as the next one's input.

The SimHash stage links documents by five-word shingles at a similarity of 0.8, the substring stage removes repeated
strings of 50 words. Stages keep the columns of ``documents``, the
last adds ``n_tokens`` and ``ids``. Rows with null ids and repeated rows are documents too; null text counts as empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from gridloom.llm import bpe, decontaminate, quality, simhash, substrings
from gridloom.llm.common import fresh, key_parts, shared_folder, ship, table
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents whose probability of good quality is below go.
KEEP = 0.4
#: SQL cannot express the stages.
ORACLE_SQL = None


def _only(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose key is (left_semi) or is not (left_anti) among the ``row_key`` of keys."""
    names = fresh(docs, "k1", "k2")
    keys = keys.select(F.col("row_key.k1").alias(names[0]), F.col("row_key.k2").alias(names[1])).distinct()
    return docs.withColumns(dict(zip(names, key_parts(), strict=True))).join(keys, names, how).select(*[f"`{c}`" for c in docs.columns])


def _once(docs: DataFrame) -> DataFrame:
    """One of the rows that have id and text in common."""
    *names, n = fresh(docs, "k1", "k2", "n")
    keyed = docs.withColumns(dict(zip(names, key_parts(), strict=True)))
    one = Window.partitionBy(*names).orderBy(F.lit(0))
    return keyed.withColumn(n, F.row_number().over(one)).filter(F.col(n) == 1).select(*[f"`{c}`" for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality."""
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return _only(docs, scored.filter(F.col("quality") < KEEP), "left_anti")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group (null ids last), once if its row is repeated."""
    ship(spark)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_key"))
    keys = simhash.near_documents(docs).groupBy("component").agg(first.alias("first")).select(F.col("first.row_key").alias("row_key"))
    return _once(_only(docs, keys, "left_semi"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every word inside a string of 50 words that also starts anywhere else; documents of nothing else go."""
    ship(spark)
    size, spans, kept = fresh(docs, "n_bytes", "spans", "kept")
    rows = substrings.remove_repeats(docs, grain=substrings.WORDS, into=(size, spans, kept))
    changed, left = F.size(spans) > 0, F.col(kept).cast("string")
    rows = rows.filter(~changed | (F.length(F.trim(left)) > 0))
    new = {"text": F.when(changed, left).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}
    return rows.withColumns(new).select(*[f"`{c}`" for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark items cover a twentieth or more."""
    rows = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _only(docs, rows.filter(decontaminate.contaminated()), "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and their number; text becomes what the ids decode to."""
    ship(spark)
    rows = bpe.bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.withColumns({"text": F.when(F.col("text").isNotNull(), F.col("decoded").cast("string")), "n_tokens": F.size("ids").cast("long")}).drop("decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, through the session's shared folder (``spark.checkpoint.dir``). A stage's folder is
    deleted when the next stage is written; the last one is the result and stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    shared = shared_folder(spark)
    for name, stage in STAGES:
        to = f"{shared}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(to)
        docs = spark.read.parquet(to)
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = to
    return docs
