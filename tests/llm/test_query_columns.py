"""The registered queries' own columns over whole small tables, against brute force, the library or SQL."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from gridloom.llm import bpe, decontaminate, queries, urls
from gridloom.llm.oracles import ORACLES
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def table(name):
    return pd.read_parquet(f"{DATA}/{name}.parquet")


def rows(spark, name, data=DATA):
    return {r["doc_id"]: r for r in getattr(queries, name)(spark, data).collect()}


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def gone_in(units, window):
    """Places covered by a string of so many units that starts anywhere else."""
    seen = {}
    for r in units:
        for i in range(len(r) - window + 1):
            key = hash(r[i : i + window]) if isinstance(r, bytes) else hash(tuple(r[i : i + window]))
            seen[key] = seen.get(key, 0) + 1
    out = []
    for r in units:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if seen[hash(r[i : i + window]) if isinstance(r, bytes) else hash(tuple(r[i : i + window]))] > 1:
                gone[i : i + window] = True
        out.append(gone)
    return out


def test_op3(spark):
    docs = table("documents")
    raw = [(t or "").encode() for t in docs.text]
    words = gone_in([r.split() for r in raw], 50)
    got = rows(spark, "op3_substrings")
    assert len(got) == len(docs)
    for i, r, gone, w in zip(docs.doc_id, raw, gone_in(raw, 400), words, strict=True):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(r), int(gone.sum()), spans, sha(kept)), i
        assert got[i]["n_passage_words"] == int(w.sum()), i


def test_op4(spark):
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = rows(spark, "op4_bpe")
    for i, t in zip(table("documents").doc_id, table("documents").text, strict=True):
        ids = enc.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())), i


def test_op5(spark):
    """On sf0.01, as sf0.001 has some twenty toxic labels in all."""
    data = DATA.replace("0.001", "0.01")
    got, docs, labels = rows(spark, "op5_toxicity", data), pd.read_parquet(f"{data}/documents.parquet"), pd.read_parquet(f"{data}/labels.parquet").set_index("doc_id").toxic
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    assert np.mean([r["predicted"] == labels[i] for i, r in got.items() if i in labels.index and r["held_out"]]) > 0.9
    again = rows(spark, "op5_toxicity", data)
    assert all(again[i]["score"] == r["score"] for i, r in got.items())


def test_op8(spark):
    docs, got = table("documents"), rows(spark, "op8_simhash")
    prints = []
    for t in docs.text:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], np.uint64)
        prints.append(sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h)))
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    ids = docs.doc_id.tolist()
    least = {}
    for i, c in zip(ids, label, strict=True):
        least[c] = min(i, least.get(c, i))
    for i, p, c in zip(ids, prints, label, strict=True):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{p:016x}", least[c]), i


@pytest.mark.parametrize("name", ["op1_topk", "op6_shards", "op7_urls", "op10_decontaminate"])
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = con.execute(ORACLES[name])
    columns = [c[0] for c in got.description]
    mine = getattr(queries, name)(spark, DATA)
    assert set(columns) <= set(mine.columns)
    assert sorted(map(repr, map(tuple, mine.select(*columns).collect()))) == sorted(map(repr, got.fetchall()))


def test_shards_of_odd_rows_equal_sql(spark, tmp_path):
    odd = [(None, None, None), (None, "x", "a"), (3, "", "a"), (3, "", "a"), (4, "é日本", None), (4, "other", None), (5, "long " * 20_000, "hot"), *[(i, f"t{i}", "hot") for i in range(6, 60)]]
    df = spark.createDataFrame([(*r, "x", "y") for r in odd], "doc_id long, text string, source string, shard string, h string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = con.execute(ORACLES["op6_shards"])
    columns = [c[0] for c in got.description]
    mine = queries.op6_shards(spark, str(tmp_path)).select(*columns).collect()
    assert len(mine) == len(odd) and sorted(map(repr, map(tuple, mine))) == sorted(map(repr, got.fetchall()))


def test_long_lists_are_split_into_cascades(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_WORDS", 8)
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 4000, 5).select(F.concat(F.lit("k"), "id").alias("key"))
    c = urls.BloomCascade.build(listed, universe)
    assert len(c.parts) > 3 and all(sum(bits for bits, _ in p.levels) <= 64 * 16 for p in c.parts)
    assert universe.filter(c.contains(F.col("key")) != (F.substring("key", 2, 9).cast("int") % 5 == 0)).count() == 0


def test_places_covered_by_spans(spark):
    cases = [[], [(0, 3)], [(0, 13), (1, 13), (20, 2)], [(5, 13), (5, 4), (18, 13)], [(0, 40), (3, 2), (39, 5)]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, spans array<struct<s:int,m:int>>")
    got = {r["i"]: r["n"] for r in df.select("i", decontaminate.covered(F.col("spans")).alias("n")).collect()}
    assert got == {i: len({p for s, m in c for p in range(s, s + m)}) for i, c in enumerate(cases)}


def test_a_very_common_print_and_window(spark):
    """One item in thousands of documents, in several items of the benchmark: every document names all of them."""
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), F.lit(words), F.lit(" c"), F.col("id").cast("string")).alias("text"))
    bench = spark.createDataFrame([(i, words) for i in range(40)], "item_id long, text string")
    got = decontaminate.contamination(docs, bench)
    assert got.filter((F.col("n_hit") != 20) | (F.size("items") != 40) | (F.col("n_words") != 23)).count() == 0 and got.count() == 3000
