import random

import numpy as np
import pyarrow as pa
import pytest
from gridloom.llm import substrings
from gridloom.llm.common import ship
from gridloom.llm.substrings import BYTES, WORDS

SCHEMA = "doc_id long, text string, source string, kept string, key string, k1 string, lo string"


def gone_of(units, window):
    seen = {}
    for r in units:
        for i in range(len(r) - window + 1):
            seen[tuple(r[i : i + window])] = seen.get(tuple(r[i : i + window]), 0) + 1
    out = []
    for r in units:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if seen[tuple(r[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append(gone)
    return out


def brute(texts, window=400):
    raw, out = [(t or "").encode() for t in texts], []
    for r, gone in zip(raw, gone_of(raw, window), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((len(r), [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)], bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


def check(spark, texts):
    ship(spark)
    df = spark.createDataFrame([(i, t, "s", "x", "y", "z", "w") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df, passages=WORDS).collect()}
    assert len(got) == len(texts)
    words = gone_of([(t or "").encode().split() for t in texts], 50)
    for i, (n, spans, kept) in enumerate(brute(texts)):
        r = got[i]
        assert (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]), r["key"], r["k1"]) == (n, spans, kept, "y", "z"), i
        assert r["n_passage_units"] == words[i].sum(), i


def text(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


def test_planted_repeats(spark):
    rng = random.Random(4)
    shared = [text(rng, n) for n in (399, 400, 401, 420, 600, 2000)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, 60)
            parts += [text(rng, rng.choice([0, 1, 30, 500])), s[a : len(s) - rng.randint(0, 60)] if rng.random() < 0.6 else s]
        texts.append("".join(parts))
    texts += [None, "", "ab" * 1000, "a" * 900, text(rng, 300) * 3, "x" * 399, texts[0], texts[0], texts[5][:700], "a b " * 60]
    near = list(text(rng, 3000))
    for _ in range(12):
        c = list(near)
        for _ in range(rng.randint(1, 6)):
            c[rng.randrange(len(c))] = "#"
        texts.append("".join(c))
    check(spark, texts)


def test_hot_core_in_many_contexts_spans_ranges(spark, monkeypatch):
    """One passage in many documents: its anchors' cores are one key, divided among ranges and compared across them."""
    monkeypatch.setattr(substrings, "RANGE", 40)
    rng = random.Random(8)
    passage = text(rng, 700)
    check(spark, [text(rng, rng.randint(0, 300)) + passage + text(rng, rng.randint(0, 300)) for _ in range(150)] + [text(rng, 900)])


def test_suffixes_merge_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MERGED", 3)
    rng = random.Random(2)
    a = text(rng, 1500)
    check(spark, [a, a, text(rng, 90) + a, a[:900], a[700:], text(rng, 1000)])


def test_no_repeats_and_no_rows(spark):
    rng = random.Random(9)
    check(spark, [text(rng, 1500), text(rng, 800), "same short", "same short", None])
    check(spark, [])


def test_repeated_rows_with_one_id(spark):
    ship(spark)
    t = text(random.Random(1), 450)
    rows = [(None, t), (None, t), (3, "other")]
    got = substrings.remove_repeats(spark.createDataFrame([(i, x, "s", "x", "y", "z", "w") for i, x in rows], SCHEMA)).collect()
    assert sorted((r["n_bytes"], len(r["kept"])) for r in got) == [(5, 5), (len(t.encode()), 0), (len(t.encode()), 0)]


@pytest.mark.parametrize("words", [49, 50, 51, 70])
def test_passages_of_words(spark, words):
    """A passage of 50 words or more goes, whatever its bytes and the blanks in it; a shorter one stays."""
    ship(spark)
    rng = random.Random(words)
    vocabulary = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    many = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = many(words)
    texts = [f"{many(30)} {passage} {many(40)}", f"{many(80)}\n{passage.replace(' ', chr(10), 7)}", f"{passage}\t{many(5)}", many(200), "", None, many(20)]
    df = spark.createDataFrame([(i, t, "s", "x", "y", "z", "w") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df, grain=WORDS).collect()}
    gone = gone_of([(t or "").encode().split() for t in texts], 50)
    for i, t in enumerate(texts):
        left = [w for w, g in zip((t or "").encode().split(), gone[i], strict=True) if not g]
        assert bytes(got[i]["kept"]).split() == left, i
        assert len(got[i]["spans"]) == int(gone[i].any())
    assert gone[0].any() == (words >= 50) and not gone[3].any()


@pytest.mark.parametrize("grain", [BYTES, WORDS])
def test_anchors_cover_every_window_once(monkeypatch, grain):
    monkeypatch.setattr(substrings, "CHUNK", 8000 if grain is WORDS else 1000)
    rng = random.Random(2)
    texts = [text(rng, n).encode() for n in (5000, 0, 399, 400, 3000, 20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(range(6), pa.int64()), pa.array([b"x" * 500, *texts], pa.binary())[1:]], names=["k1", "k2", "text"])
    seen = [[] for _ in texts]
    for block in substrings.anchor_suffixes(grain, batch):
        lo, hi, place, at = substrings.unpacked(block[7])
        assert (at == lo).all() and (place >= hi).all() and (place <= lo + grain.reach - 1).all()
        for k, a, b in zip(block[5].tolist(), lo.tolist(), hi.tolist(), strict=True):
            seen[k] += range(a, b + 1)
    for t, windows in zip(texts, seen, strict=True):
        n = len(t) if grain is BYTES else len(t.split())
        assert windows == list(range(n - grain.window + 1))


def test_tokens_sort_as_texts_do():
    words = [b"", b"a", b"a\x00", b"ab", b"abcdefgh", b"abcdefghi", b"b", b"\xc3\xa9", b"\xff"]
    x = np.frombuffer(b"".join(words) + b"pad", np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = substrings.heads(x, end - [len(w) for w in words], end)
    assert list(np.argsort(got, kind="stable")) == list(range(len(words)))


def test_multikey_order_and_ranges():
    tokens = np.random.default_rng(0).integers(-2, 3, size=(3000, 5))
    order, begin = substrings.multikey_order(tokens)
    assert (tokens[order] == tokens[np.lexsort(tokens.T[::-1])]).all()
    assert len(begin) == len(np.unique(tokens, axis=0))
    for n in (0, 1, 2, 7, 40):
        splitters = np.unique(tokens[:n], axis=0)
        expected = [sum(tuple(s) <= tuple(t) for s in splitters.tolist()) for t in tokens.tolist()]
        assert substrings.range_of(tokens, splitters).tolist() == expected
