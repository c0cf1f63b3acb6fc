import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from gridloom.llm import bpe, chat, quality, shards, topk, toxicity, urls
from gridloom.llm.common import ship
from pyspark.sql import functions as F


# top-k


def vectors(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, score string, rank string")


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 40)), 1).astype(np.float32)
    x[50:90] = x[50]  # ties
    rows = [(i, v.tolist(), "l", "s", "r") for i, v in enumerate(x)]
    rows += [(None, x[0].tolist(), "", "", ""), (1000, None, "", "", ""), (1001, [None, 1.0], "", "", ""), (1002, [float("nan")], "", "", ""), (1003, [float("inf"), 1.0], "", "", "")]
    df = vectors(spark, rows)
    kept = df.filter(topk.usable("vec_id", "embedding")).select("vec_id", topk.quantised(F.col("embedding")).alias("vec"))
    assert kept.count() == 300
    got = {}
    for r in topk.top_k(kept.filter("vec_id % 50 = 0"), kept, 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ints = np.floor(x.astype(float) * 1024).astype(int)
    for q in range(0, 300, 50):
        score = ints @ ints[q]
        best = sorted((j for j in range(300) if j != q), key=lambda j: (-score[j], j))[:10]
        assert sorted(got[q]) == [(k + 1, j, score[j]) for k, j in enumerate(best)]


def test_top_k_of_few_large_and_no_vectors(spark):
    df = vectors(spark, [(0, [1e15, -1e15], "", "", ""), (100, [1e15, 1e15], "", "", ""), (7, [2.0], "", "", ""), (7, [2.0], "", "", "")])
    v = df.select("vec_id", F.transform("embedding", lambda e: F.floor(e / 1e8).cast("double")).alias("vec"), F.lit("x").alias("rank"))
    got = topk.top_k(v.filter("vec_id % 100 = 0"), v, 10).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in got) == [(0, 7), (0, 7), (0, 100), (100, 0), (100, 7), (100, 7)]
    assert topk.top_k(v.limit(0), v).count() == 0 and topk.top_k(v, v.limit(0)).count() == 0
    none = spark.createDataFrame([(0, []), (100, []), (3, [])], "vec_id long, vec array<double>")
    assert sorted(map(tuple, topk.top_k(none.filter("vec_id = 0"), none).collect())) == [(0, 1, 3, 0), (0, 2, 100, 0)]


def test_scores_beyond_long_are_clamped(spark):
    """Finite components of any size take part; what exceeds a long is its largest or smallest value, and ties there."""
    rows = [(0, [3e38, 1.0]), (100, [3e38, 2.0]), (2, [-3e38, 0.0]), (3, [1e9, 1.0]), (4, [3e-3, 5.0]), (5, [2e37, 0.0])]
    df = vectors(spark, [(i, v, "", "", "") for i, v in rows])
    v = df.filter(topk.usable("vec_id", "embedding")).select("vec_id", topk.quantised(F.col("embedding")).alias("vec"))
    got = {}
    for r in topk.top_k(v.filter("vec_id % 100 = 0"), v, 4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {r["vec_id"]: [int(x) for x in r["vec"]] for r in v.collect()}
    assert whole[4] == [3, 5120]
    for q, found in got.items():
        score = {i: min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(whole[q], whole[i], strict=True)))) for i in whole if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:4]
        assert sorted(found) == [(n + 1, i, score[i]) for n, i in enumerate(best)]
    doubles = spark.createDataFrame([(1, [1.7e308, -1.7e308, -2.5 / 1024, 2.0**52 + 1])], "vec_id long, e array<double>").select(topk.quantised(F.col("e"))).first()[0]
    assert doubles == [1.7976931348623157e308, -1.7976931348623157e308, -3.0, 1024 * (2.0**52 + 1)]


def test_queries_in_many_blocks_and_small_sample(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 40, size=(400, 20)).astype(float)
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, vec array<double>").repartition(5)
    expected = {r for r in map(tuple, topk.top_k(v.filter("vec_id % 7 = 0"), v, 6).collect())}
    for name, value in (("QUERY_BYTES", 2000), ("SEEDS", 3), ("CANDIDATES", 16), ("HELD", 50)):
        monkeypatch.setattr(topk, name, value)
    assert {tuple(r) for r in topk.top_k(v.filter("vec_id % 7 = 0"), v, 6).collect()} == expected
    for q, rank, i, score in expected:
        s = x @ x[q]
        best = sorted((j for j in range(400) if j != q), key=lambda j: (-s[j], j))
        assert best[rank - 1] == i and score == s[i]


@pytest.mark.parametrize("scale", [1, 10**7, 10**12])
def test_search_prunes_without_loss(scale):
    rng = np.random.default_rng(0)
    x = (rng.integers(-500, 500, size=(600, 64)) * np.r_[np.full(16, 20), np.ones(48, int)]).astype(float) * scale
    whole = np.array([[int(v) for v in r] for r in x.tolist()], object)
    floors = np.full(5, topk.LEAST)
    for i, ids, score in topk.search_block(x[:5], np.arange(5), x, np.arange(600), 10, floors):
        full = [min(topk.MOST, max(topk.LEAST, v)) for v in whole @ whole[i]]
        best = sorted((j for j in range(600) if j != i), key=lambda j: (-full[j], j))[:10]
        assert list(ids) == best and list(score) == [full[j] for j in best]
        assert floors[i] == full[best[-1]]
    for i, ids, _ in topk.search_block(x[:5], np.arange(5), x, np.arange(600), 10, floors.copy()):
        assert len(ids) == 10 and floors[i] is not None


# chat


EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string, start string"


def test_events_fold_into_messages(spark):
    events = [
        (1, 1, 0, "message", "user", "hi", ""),
        (1, 2, 1, "delta", "assistant", "hel", ""),
        (1, 3, 1, "delta", None, "lo", ""),
        (1, 4, 2, "message", "user", "more", ""),
        (1, 5, 3, "delta", "assistant", "gone", ""),
        (1, 6, 1, "regenerate", None, "", ""),
        (1, 7, 1, "delta", None, "again", ""),
        (1, 8, 0, "edit", None, "hello", ""),
        (2, 1, 0, "delta", "user", None, ""),
        (2, 2, 0, None, None, "set", ""),
        (None, 1, None, "message", "user", "x", ""),
    ]
    got = chat.reconstruct(spark.createDataFrame(events, EVENTS)).collect()
    assert sorted((r["conv_id"] or 0, r["turn"] or 0, r["role"], r["text"]) for r in got) == [(0, 0, "user", "x"), (1, 0, "user", "hello"), (1, 1, "assistant", "again"), (2, 0, "user", "set")]
    assert chat.reconstruct(spark.createDataFrame([], EVENTS)).count() == 0


def test_rendering_is_read_back_and_masks_assistants(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|user|>", "~1~", "~", "", None, "日本\n[x]", "é" * 100_000, "<|assistant|>fake</s>"]
    rows = [(1, i, ["user", "assistant", "a<|b"][i % 3], t, "") for i, t in enumerate(nasty)] + [(1, 3, "user", "tie", ""), (1, 3, "user", "tie", ""), (2, None, None, "x", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    done = chat.render(chat.reconstruct(chat.events_of(df))).withColumn("turns", chat.parse(F.col("formatted")))
    got = {r["conv_id"]: r for r in done.collect()}
    expected = sorted(((i, r or "", t or "") for c, i, r, t, _ in rows if c == 1), key=lambda x: (x[0], x[1], x[2]))
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r, t) for _, r, t in expected]
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", "x")]
    un = lambda s: s.replace("~4", "]").replace("~3", "[").replace("~2", ">").replace("~1", "<").replace("~0", "~")
    masked = [un(got[1]["formatted"][s["start"] : s["end"]]) for s in got[1]["loss_mask"]]
    assert masked == [t for _, r, t in expected if r == "assistant"]


# byte-level BPE


def test_bpe_equals_the_library_and_round_trips(spark):
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = bpe.encoding(path, public_tokenizers.PATTERN)
    assert isinstance(enc, tiktoken.Encoding)
    rng = random.Random(3)
    long = "".join(rng.choice(["word", " next", "  two", "\n", " 12", "'s", " é日本", "\t", " \n x", "!!", "<|endoftext|>"]) for _ in range(60_000))
    texts = [None, "", " ", "<|endoftext|>", "Straße 日本 \u00a0x\n\n  y", "a" * 30_000, long, "same", "same"]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, source string")
    got = {r["doc_id"]: r for r in bpe.bpe(df, path, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(texts) and got[0]["source"] == "y"
    for i, t in enumerate(texts):
        assert got[i]["ids"] == enc.encode_ordinary(t or "")
        assert bytes(got[i]["decoded"]) == (t or "").encode()
    assert bpe.bpe(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_pieces_are_cut_where_tokens_end(size):
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(size)
    for _ in range(30):
        text = "".join(rng.choice(["a", "B", " ", "  ", "\n", "1", "'", "s", "é", "!", "\u2003", "\x1c", "\x85"]) for _ in range(300))
        parts = list(bpe.pieces(text, size))
        assert "".join(parts) == text
        assert sum((enc.encode_ordinary(p) for p in parts), []) == enc.encode_ordinary(text)


# shards


def test_shards_match_the_mixture(spark):
    rng = random.Random(2)
    rows = [(i, "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "rare"][: 3 + (i % 50 == 0)]), 10, i % 100, "x") for i in range(1003)]
    rows += [(None, None, 1, 0, "x"), (5, "a", 10, 5, "x"), (5, "a", 10, 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text_crc32 long, slot string")
    got = shards.interleave(df, 16).collect()
    assert len(got) == len(rows) and sorted(r["position"] for r in got) == list(range(len(rows)))
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    sizes = [len(v) for v in by.values()]
    assert sorted(by) == list(range(16)) and max(sizes) - min(sizes) <= 1
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    for s in {r[1] for r in rows}:
        n = [sum(r["source"] == s for r in v) for v in by.values()]
        assert max(n) - min(n) <= 2 or all(abs(x - sum(n) / 16) <= 2 for x in n)
    again = {(r["doc_id"], r["position"]) for r in shards.interleave(df.repartition(7), 16).collect()}
    assert {(r["doc_id"], r["position"]) for r in got} == again
    assert shards.interleave(df.limit(0), 16).count() == 0
    assert sorted(r["shard"] for r in shards.interleave(df.limit(3), 16).collect()) == [0, 5, 10]


# urls


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = {"net/": "block", "example.com/de/": "block", "example.net/en/": "allow", "org/fr/": "allow"}
    fits = [r for r in rules if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
    rule = max(fits, key=len, default=None)
    return host, path, rule, rules.get(rule, "allow")


def test_urls_are_judged_exactly(spark):
    hosts = ["a.NET", "net", "example.net", "x.example.net", "notexample.net", "anet", "example.com", "b.example.com", "q.org", "org", "É.org", "", "a.b.c.d.e.net", "net:80", "..net"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/de/1", "/fr/", "/fr", "/FR/", "?/en/", "#x", "/en/?a=/de/", "//en/"]
    all_urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "x://y://") for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://"] * 2 + ["http://" + "long." * 5000 + "net/" + "p" * 50_000]
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(all_urls)], "page_id long, url string, verdict string")
    rows = urls.judge(df, ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]).collect()
    assert len(rows) == len(all_urls)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(r["url"]), r["url"]
    assert urls.judge(df.limit(0), ["net/"], ["org/fr/"]).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key")).union(spark.createDataFrame([(None,), ("k1",)], "key string"))
    for step in (2, 97, 6000):
        listed = spark.range(0, 6000, step).select(F.concat(F.lit("k"), "id").alias("key"))
        c = urls.BloomCascade.build(listed, universe)
        wrong = universe.filter("key IS NOT NULL").filter(c.contains(F.col("key")) != (F.substring("key", 2, 9).cast("int") % step == 0))
        assert wrong.count() == 0
        assert universe.filter("key IS NULL").filter(c.contains(F.col("key")).isNotNull()).count() == 0
    none = urls.BloomCascade.build(universe.limit(0), universe)
    assert universe.filter(none.contains(F.col("key"))).count() == 0


# quality


def corpus(n, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 200))]
        text = " ".join(words) + "." if good else rng.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join([words[0]] * 90), " ".join(w + rng.choice(["$$$", "%%%"]) for w in words)])
        docs.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["hot", "hot", "a", "b", None]), len(text), "x"))
        labels.append((i, int(good), 0))
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality string"


def test_quality_keeps_good_documents(spark):
    ship(spark)
    docs, labels = corpus(500)
    extra = [(900, None, None, None, None, "x"), (901, "", "en", "hot", 0, "x"), (None, "plain words here", "en", "a", 3, "x"), (902, "long " * 100_000, "en", "a", 3, "x"), docs[0], docs[0]]
    df = spark.createDataFrame(docs + extra, DOCS)
    lab = spark.createDataFrame(labels[:300] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(df, quality.fit(df, lab)).collect()
    assert len(rows) == len(docs) + len(extra) and all(0 <= r["quality"] <= 1 for r in rows)
    truth = {i: q for i, q, _ in labels}
    held = [(r["quality"] >= 0.4) == truth[r["doc_id"]] for r in rows if r["doc_id"] is not None and 300 <= r["doc_id"] < 500]
    assert np.mean(held) > 0.97
    again = {(r["row_key"], r["quality"]) for r in quality.score(df.repartition(5), quality.fit(df, lab)).collect()}
    assert again == {(r["row_key"], r["quality"]) for r in rows}
    nil = quality.fit(df.limit(0), lab)
    assert quality.score(df.limit(0), nil).count() == 0 and quality.score(df.limit(3), nil).count() == 3


def test_sparse_paths_are_shrunk_toward_their_site(spark):
    ship(spark)
    df = spark.createDataFrame([(i, "t", "p" if i else "lonely", "bad" if i < 100 else "good", 1, "x") for i in range(200)], DOCS)
    ev = quality.Evidence(np.zeros((10, 12)), np.zeros(1 + 130), 0.5)
    ev.logit = lambda x: np.zeros(len(x))
    rows = {r["doc_id"]: r for r in quality.score(df, ev).collect()}
    assert abs(rows[0]["prior"] - rows[1]["prior"]) < 0.05 and all(0.4 < r["prior"] < 0.6 for r in rows.values())


def test_quality_of_documents_with_urls(spark):
    ship(spark)
    docs, labels = corpus(300, 4)
    hosts = ["http://A.example.com/en/1", "https://a.example.com/en/2?x", "http://b.example.org/", "no url", None]
    df = spark.createDataFrame([(*d[:5], hosts[d[0] % 5]) for d in docs], "doc_id long, text string, lang string, source string, n_chars long, url string")
    ev = quality.fit(df, spark.createDataFrame(labels + labels, "doc_id long, quality int, toxic int"))
    rows = {r["doc_id"]: r for r in quality.score(df, ev, urls.host(F.col("url")), quality.section(F.col("url"))).collect()}
    assert len(rows) == 300 and rows[0]["prior"] == rows[1]["prior"] == rows[5]["prior"] and rows[2]["prior"] != rows[0]["prior"]
    sections = df.select(quality.section(F.col("url"))).distinct().collect()
    assert {r[0] for r in sections} == {"en", ""}


def brute_quality(docs, ev):
    """Priors and qualities by the formulas of the docstring, in plain Python."""
    x = np.array([quality.features((t or "").encode()) for _, t, *_ in docs])
    logit = np.round(ev.logit(x), 6)
    good = np.floor(1e6 / (1 + np.exp(-logit)) + 0.5) / 1e6
    group = {}
    for d, g in zip(docs, good, strict=True):
        group.setdefault((d[3], d[2]), []).append(g)
    paths = {k: (len(v), sum(v)) for k, v in group.items()}
    sites = {}
    for (s, _), (n, g) in paths.items():
        a, b = sites.get(s, (0, 0.0))
        sites[s] = (a + n, b + g)

    def worth(groups):
        n, g = sum(a for a, _ in groups), sum(b for _, b in groups)
        rate, k = g / n, len(groups)
        between = (sum(b * b / a for a, b in groups) - n * rate * rate - (k - 1) * rate * (1 - rate)) / (n - sum(a * a for a, _ in groups) / n)
        return min(1e6, max(1.0, rate * (1 - rate) / between - 1)) if between > 0 else 1e6

    n, g = sum(a for a, _ in sites.values()), sum(b for _, b in sites.values())
    top, ws, wp = (g + 1) / (n + 2), worth(list(sites.values())), worth(list(paths.values()))
    out = []
    for d, z in zip(docs, logit, strict=True):
        a, b = sites[d[3]]
        parent = (b + ws * top) / (a + ws)
        a, b = paths[d[3], d[2]]
        prior = (b + wp * parent) / (a + wp)
        odds = z - np.log(ev.prior / (1 - ev.prior)) + np.log(prior / (1 - prior))
        out.append((round(prior, 6), round(1 / (1 + np.exp(-odds)), 6)))
    return out


def test_quality_equals_brute_force(spark):
    ship(spark)
    docs, labels = corpus(400, 2)
    docs += [(900, None, None, None, None, "x"), (901, "", "en", "lonely", 0, "x"), docs[0]]
    df = spark.createDataFrame(docs, DOCS)
    ev = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = sorted((r["doc_id"], r["prior"], r["quality"]) for r in quality.score(df, ev).collect())
    want = sorted((d[0], *w) for d, w in zip(docs, brute_quality(docs, ev), strict=True))
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 2e-6 and abs(a[2] - b[2]) < 2e-6


# toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    e, start, step = rng.normal(size=(4, 6)), rng.normal(size=2), rng.normal(size=(2, 2))
    real = np.arange(6)[None, :] < np.array([6, 4, 1, 3])[:, None]
    e = np.where(real, e, 0)
    p, steps = toxicity.marginals(e, real, start, step)
    expected_steps = np.zeros((2, 2))
    for i in range(4):
        n = real[i].sum()
        weight, one, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> t & 1 for t in range(n)]
            w = np.exp(start[y[0]] + sum(e[i, t] for t in range(n) if y[t]) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
            weight += w
            one += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                pair[a, b] += w
        assert np.allclose(p[i, :n], one / weight)
        expected_steps += pair / weight
    assert np.allclose(steps, expected_steps)


@pytest.mark.parametrize("at_once", [1, 3, 1000])
def test_blocks_hand_their_messages_on(monkeypatch, at_once):
    """Texts in blocks of four tokens have the marginals and steps of the same texts in one piece."""
    monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
    rng = np.random.default_rng(4)
    lengths = np.array([11, 0, 4, 1, 30, 8, 3])
    flat, start, step = rng.normal(size=int(lengths.sum())) * 3, rng.normal(size=2), rng.normal(size=(2, 2)) * 2
    got = []
    for size in (4, 32):
        monkeypatch.setattr(toxicity, "BLOCK", size)
        at, real, head = toxicity.blocks(lengths)
        p, steps = toxicity.marginals(flat[at], real, start, step, True, head)
        one = np.zeros(len(flat))
        one[at[real]] = p[real]
        got.append((one, steps))
    assert np.allclose(got[0][0], got[1][0]) and np.allclose(got[0][1], got[1][1])


def test_repeated_ids_and_a_bound_on_bytes(spark):
    ship(spark)
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    rows = [(i, " ".join([*(rng.choice(plain) for _ in range(40)), *(["zzvile"] * 3 if i % 2 else [])])) for i in range(200)]
    labels = [(i, i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows + rows[:50] + [(4, None), (None, "zzvile")], "doc_id long, text string")
    lab = spark.createDataFrame(labels + labels + [(2, None), (None, 1)], "doc_id long, toxic int")
    for model in (toxicity.fit(docs, lab), toxicity.fit(docs, lab, size=20_000)):
        got = toxicity.score(docs, model).collect()
        assert len(got) == 252 and all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] is not None)
    again = toxicity.fit(docs.repartition(7), lab.repartition(3))
    assert again.weights == toxicity.fit(docs, lab).weights


def test_toxic_spans_and_scores_on_held_out_documents(spark):
    ship(spark)
    rng = random.Random(8)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    bad = ["vileword", "Nastything", "foulish"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 150))]
        toxic = i % 5 == 0 or i % 7 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), "en", "s", 1, "x"))
        labels.append((i, 1, int(toxic)))
    extra = [(900, None, None, None, None, "x"), (901, "", "", "", 0, "x"), (902, "?!", "", "", 0, "x"), (None, "İ vileword vileword nastything " * 3, "", "", 0, "x"), (903, "abcde " * 50_000, "", "", 0, "x")]
    df = spark.createDataFrame(docs + extra, DOCS)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = toxicity.score(df, model).collect()
    assert len(rows) == 605 and all(0 <= r["score"] <= 1 for r in rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 80 and all((r["score"] >= 0.5) == truth[r["doc_id"]] for r in held)
    for r in rows:
        for s in r["spans"]:
            assert r["text"][s["start"] : s["end"]].lower() in [b.lower() for b in bad]
    assert all(r["score"] < 0.5 for r in rows if r["doc_id"] in (900, 901, 902, 903))
    assert toxicity.score(df.limit(0), model).count() == 0
    nothing = toxicity.train([], [])
    assert toxicity.score(df.limit(2), nothing).count() == 2


def test_hex_digests_of_queries(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
