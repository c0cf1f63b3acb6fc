"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, quality, shards, simhash, substrings, topk, toxicity, urls
from .common import cut, table
from .oracles import ORACLES as ORACLES


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk.usable("vec_id", "embedding")).select("vec_id", topk.quantised(F.col("embedding")).alias("vec"))
    return topk.top_k(rows.filter(F.col("vec_id") % 100 == 0), rows, 10)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).unionByName(extra)
    done = chat.render(chat.reconstruct(chat.events_of(rows))).withColumn("turns", chat.parse(F.col("formatted")))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss_mask", lambda s: chat.unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    done = done.withColumns({"every": every, "learned": learned})
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("every", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.bpe(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shards.interleave(rows, 16).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]).select("page_id", "host", "path", "rule", "verdict")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), passages=substrings.WORDS)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.col("n_passage_units").alias("n_passage_words"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(cut(simhash.fingerprints(table(spark, sf_dir, "documents"))))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", "evidence", "prior", "quality", (F.col("quality") >= 0.4).alias("keep"))


_ALL = (op1_topk, op2_chat, op3_substrings, op4_bpe, op5_toxicity, op6_shards, op7_urls, op8_simhash, op9_quality, op10_decontaminate)
QUERIES = {f.__name__: f for f in _ALL}
