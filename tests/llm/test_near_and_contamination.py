import random
import re

import numpy as np
import pytest
import xxhash
from gridloom.llm import decontaminate, simhash
from gridloom.llm.common import ship
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, row string"


def frame(spark, texts):
    ship(spark)
    return spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in texts], DOCS)


def brute_fp(text):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    up = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = up[i], up[j]
                up = [b if x == a else x for x in up]
    return [min(ids[j] for j in range(len(fps)) if up[j] == up[i]) for i in range(len(fps))]


def test_simhash_documents(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "日本"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 60, 150]))] for _ in range(25)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(3):
            c = list(b)
            c[rng.randrange(len(c))] = rng.choice(vocabulary)
            texts.append("\t".join(c) if rng.random() < 0.3 else " ".join(c).upper())
    texts += [None, "", " \n ", texts[0], texts[0], "long " * 30_000]
    docs = frame(spark, enumerate(texts))
    got = {r["doc_id"]: r for r in simhash.near_groups(simhash.fingerprints(docs)).collect()}
    fps = [brute_fp(t) for t in texts]
    assert [got[i]["fp"] % 2**64 for i in range(len(texts))] == fps
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(list(range(len(texts))), fps)
    assert simhash.near_groups(simhash.fingerprints(docs.limit(0))).count() == 0


@pytest.mark.parametrize("flips", [2, 3, 4])
def test_near_groups_of_dense_fingerprints(spark, flips):
    ship(spark)
    rng = random.Random(flips)
    fps = []
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.append(x)
            for b in rng.sample(range(64), rng.randint(1, flips)):
                x ^= 1 << b
    rows = spark.createDataFrame([(i, simhash._signed(x)) for i, x in enumerate(fps)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(rows).collect()}
    assert [got[i] for i in range(len(fps))] == brute_components(list(range(len(fps))), fps)


def test_links_of_large_groups_connect_the_same():
    rng = random.Random(1)
    for block in simhash.BLOCKS:
        center = rng.getrandbits(64)
        fps = set()
        while len(fps) < 700:
            x = center ^ (1 << rng.choice([b for b in range(64) if b not in block])) if rng.random() < 0.7 else center
            for b in rng.sample(list(block), rng.randint(0, 6)):
                x ^= 1 << b
            fps.add(x)
        fps = np.array(sorted(fps), np.uint64)
        a, b = simhash.links_of(fps, 100)
        assert (np.bitwise_count(a ^ b) <= 3).all()
        f = simhash.Forest()
        f.add(a, b)
        mask = np.uint64(sum(1 << b for b in block))
        for x in fps:
            apart = fps ^ x
            third, pair = np.bitwise_count(apart & mask), np.bitwise_count(apart & ~mask)
            for y in fps[(third + pair <= 3) & ((third <= 1) | (pair == 0))]:  # the others meet under another key
                assert f.root(int(x)) == f.root(int(y))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(texts, items):
    wins = []
    for k, t in items:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        m = min(13, len(w))
        wins += [(k, tuple(w[i : i + m])) for i in range(len(w) - m + 1) if m]
    out = {}
    for d, t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = {}
        for m in {len(x) for _, x in wins}:
            for i in range(len(w) - m + 1):
                at.setdefault(tuple(w[i : i + m]), []).append(i)
        hit, ids = set(), set()
        for k, x in wins:
            for i in at.get(x, ()):
                hit.update(range(i, i + len(x)))
                ids.add(str(k))
        out[d] = (len(w), len(hit), sorted(ids))
    return out


def test_contamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "naïve", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".", " -"]) for _ in range(n))
    items = [(i, text(rng.choice([15, 20, 40, 13]))) for i in range(20)] + [(50, text(5)), (51, text(1)), (52, text(9)), (53, ""), (54, None), (55, "a " * 30)]
    items += [(56, items[0][1]), (57, items[0][1].upper()), (0, items[3][1])]
    texts = []
    for i in range(60):
        parts = [text(rng.choice([0, 3, 30, 80]))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1] or ""
            cut = w.split(" ")
            a = rng.randint(0, max(0, len(cut) - 12))
            parts += [" ".join(cut[a : a + rng.choice([8, 12, 13, 14, 40])]), text(rng.choice([1, 9]))]
        texts.append((i, " ".join(parts)))
    texts += [(100, None), (101, ""), (102, "A " * 5000), (103, "?!"), (104, texts[3][1]), (104, texts[3][1])]
    bench = spark.createDataFrame([(k, t, "x") for k, t in [*items, (None, "never " * 20)]], "item_id long, text string, n_words string")
    rows = decontaminate.contamination(frame(spark, texts), bench).collect()
    assert len(rows) == len(texts)
    expected = brute_contamination(texts, items)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == expected[r["doc_id"]], r["doc_id"]
    empty = decontaminate.contamination(frame(spark, texts), bench.limit(0))
    assert empty.filter("n_hit > 0").count() == 0 and empty.count() == len(texts)
    assert decontaminate.contamination(frame(spark, texts).limit(0), bench).count() == 0
    assert empty.filter(decontaminate.contaminated()).count() == 0


def test_null_ids(spark):
    rows = frame(spark, [(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (None, "other words are here")])
    got = simhash.near_groups(simhash.fingerprints(rows)).orderBy(F.col("component_id").asc_nulls_last()).collect()
    assert [r["component_id"] for r in got] == [7, 7, 7, None]


def connected(fps):
    """Labels of the classes that links of three bits or fewer make of distinct fingerprints."""
    fps, label, seen = np.array(fps, np.uint64), np.full(len(fps), -1), 0
    for i in range(len(fps)):
        if label[i] < 0:
            label[i], edge = seen, [i]
            while edge:
                near = np.flatnonzero((np.bitwise_count(fps ^ fps[edge.pop()]) <= 3) & (label < 0))
                label[near] = seen
                edge += near.tolist()
            seen += 1
    return label


def test_components_of_groups_too_large_for_pairs(spark):
    """More than 512 fingerprints share a key: classes are still those of all pairs, through the whole operator."""
    ship(spark)
    rng = random.Random(12)
    fps = set()
    for block in simhash.BLOCKS:
        center, bits = rng.getrandbits(64), rng.sample(list(block), 16)
        while len([x for x in fps if (x ^ center).bit_count() <= 16]) < 900:
            fps.add(center ^ sum(1 << b for b in rng.sample(bits, rng.randint(0, 10))))
    fps = sorted(fps)
    rows = spark.createDataFrame([(i, simhash._signed(x)) for i, x in enumerate(fps)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(rows).collect()}
    label = connected(fps)
    least = {c: int(np.flatnonzero(label == c)[0]) for c in set(label.tolist())}
    assert len(least) > 3 and [got[i] for i in range(len(fps))] == [least[c] for c in label.tolist()]


def test_near_documents_link_what_is_alike_and_nothing_else(spark, monkeypatch):
    """Copies, near copies of a chain, blocks of a hot key, odd texts; any size of block gives the same classes."""
    ship(spark)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(150, 400))] for _ in range(12)]
    texts, family = [], []
    for k, b in enumerate(base):
        for _ in range(6):
            c = list(b)
            for at in rng.sample(range(len(c)), len(c) // 150):
                c[at] = rng.choice(vocabulary)
            texts.append(" ".join(c) if rng.random() < 0.7 else "\n".join(c).upper())
            family.append(k)
    texts += [None, "", " \t", "word", "WORD", "two words", texts[0], texts[0]]
    family += [100, 100, 100, 101, 101, 102, 0, 0]
    docs = frame(spark, enumerate(texts))
    for block in (simhash.BLOCK, 2):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r["doc_id"]: r["component"] for r in simhash.near_documents(docs).collect()}
        of = {}
        for i, k in enumerate(family):
            of.setdefault(k, set()).add(got[i])
        assert len(got) == len(texts) and all(len(v) == 1 for v in of.values())
        assert len({next(iter(v)) for v in of.values()}) == len(of)
    assert simhash.near_documents(docs.limit(0)).count() == 0


def test_groups_are_connected_as_by_all_pairs():
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 63, size=(5, simhash.BITS // 64), dtype=np.uint64)
    rows = []
    for c in centers:
        for _ in range(40):
            x = c.copy()
            for b in rng.integers(0, simhash.BITS, size=rng.integers(0, simhash.BITS * 40 // 256)):
                x[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
            rows.append(x)
    bits, nodes = np.array(rows)[rng.permutation(200)], np.arange(200) * 7
    near = np.bitwise_count(bits[:, None] ^ bits[None]).sum(2) <= simhash.DIFFER
    reach = near
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert (reach & ~near).any() and not reach.all()  # chains count, and groups stay apart
    got = simhash.near_in(nodes, bits)
    assert all((got == got[i]).tolist() == reach[i].tolist() for i in range(200))
