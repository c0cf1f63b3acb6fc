"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, cut, row_key, stored
from .components import components
from .substrings import Rolling, mix, word_bounds

#: Fingerprints link at so many differing bits or fewer; words of a shingle; seed of XXH64.
RADIUS, SHINGLE, SEED = 3, 3, 42
#: The three blocks of bits. Leaving out one, two fingerprints within RADIUS differ by 2 bits at most in some pair.
BLOCKS = (range(0, 21), range(21, 42), range(42, 64))
ONES = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is in more than half of the shingles' hashes; no words: zero."""
    ws = text.lower().split()
    if not ws:
        return 0
    flat = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(ws) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, fp`` (the fingerprint as a signed long) of every row; null counts as empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "row_key", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"doc_id long, row_key {KEY}, fp long")


def _signed(x: int) -> int:
    x &= ONES
    return x - (1 << 64) if x >> 63 else x


def variants(fps: DataFrame) -> DataFrame:
    """``key, fp``: for each pair of blocks, the fingerprint's bits there and these with one bit flipped. The third
    block of a key holds the pair's number. Two fingerprints that differ by 2 bits in a pair meet in a flipped key."""
    keys = []
    for n, left_out in enumerate(BLOCKS):
        mask = ONES ^ sum(1 << b for b in left_out)
        tag = (n + 1) << left_out[0]
        keys += [F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(tag | flip))) for flip in [0, *[1 << b for b in range(64) if mask >> b & 1]]]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def links_of(fps: np.ndarray, pairs: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within RADIUS among fingerprints that share a key, without forming all pairs.

    In such a group the bits of the two blocks differ by 2 at most. Up to ``pairs`` fingerprints, each is compared
    with each. In larger groups, those equal in the third block are chained; those that differ there by one bit are
    found by flipping it; and of those equal in both blocks, where the third may differ by 3, links are found the same
    way by flips of up to 3 bits. All are verified.
    """
    if len(fps) <= pairs:
        i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= RADIUS, 1))
        return fps[i], fps[j]
    left, right = [], []
    for block in BLOCKS:
        mask = np.uint64(sum(1 << b for b in block))
        third = fps & mask
        rest, first = np.unique(third, return_index=True)
        left.append(fps)
        right.append(fps[first[np.searchsorted(rest, third)]])
        for bit in block:
            other = rest ^ np.uint64(1 << bit)
            at = np.minimum(np.searchsorted(rest, other), len(rest) - 1)
            ok = rest[at] == other
            left.append(fps[first[ok]])
            right.append(fps[first[at[ok]]])
        same = fps & ~mask
        for value in np.unique(same)[np.unique(same, return_counts=True)[1] > 1]:
            group = np.sort(fps[same == value])
            bits = [1 << b for b in block]
            flips = {a | b | c for a in bits for b in bits for c in bits} if len(group) > pairs else None
            if flips is None:
                i, j = np.nonzero(np.triu(np.bitwise_count(group[:, None] ^ group[None, :]) <= RADIUS, 1))
                left.append(group[i])
                right.append(group[j])
            for flip in flips or ():
                other = group ^ np.uint64(flip)
                at = np.minimum(np.searchsorted(group, other), len(group) - 1)
                ok = (group[at] == other) & (group < other)
                left.append(group[ok])
                right.append(other[ok])
    a, b = np.concatenate(left), np.concatenate(right)
    ok = (a != b) & (np.bitwise_count(a ^ b) <= RADIUS)
    return a[ok], b[ok]


class Forest:
    """Union-find over the links that one task has found, so that it hands on one link a node at most."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if (x := self.root(x)) != (y := self.root(y)):
                self.up[max(x, y)] = min(x, y)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, held_k, held_f = Forest(), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settle(k: np.ndarray, f: np.ndarray) -> None:
        if len(k) < 2:
            return
        begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.append(begin, len(k)))
        two = begin[size == 2]
        ok = np.bitwise_count((f[two] ^ f[two + 1]).view(np.uint64)) <= RADIUS
        forest.add(f[two[ok]], f[two[ok] + 1])
        for s, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            a, b = links_of(f[s : s + n].view(np.uint64))
            forest.add(a.view(np.int64), b.view(np.int64))

    for batch in batches:
        k, f = (np.concatenate([held, batch.column(i).to_numpy()]) for i, held in enumerate((held_k, held_f)))
        last = np.searchsorted(k, k[-1]) if len(k) else 0
        settle(k[:last], f[:last])
        held_k, held_f = k[last:], f[last:]
    settle(held_k, held_f)
    nodes = list(forest.up)
    for lo in range(0, len(nodes), 50_000):
        part = nodes[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], names=["u", "v"])


def near_groups(prints: DataFrame) -> DataFrame:
    """Adds ``component`` and ``component_id`` to rows of ``doc_id, fp``: the least fingerprint and the least doc_id that
    chains of links reach, its own included.

    Equal fingerprints are one node. Each node emits its variants; a shuffle on them brings candidates together, sorted,
    where they are verified; the links' components are found in rounds that keep everything distributed. A null id is
    reached by no one, but its row gets the component's least id (null if there is none).
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes that become many: not to be coalesced
    dealt = variants(nodes.select("fp").repartition(tasks, F.xxhash64("fp"))).repartition("key").sortWithinPartitions("key").select("key", "fp")
    found = components(cut(dealt.mapInArrow(_meet, "u long, v long")))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp")


#: Near documents: words of a shingle; the similarity of shingle sets that links; bits that estimate it, and how many may
#: differ (39 of 256 are expected at a similarity of 0.8; the rest is slack of one standard error).
WORDS, SIMILARITY, BITS, DIFFER = 5, 0.8, 256, 44
#: Fingerprints of 32 bits that find candidates, and the words of their shingles: an edit changes fewer short ones.
TABLES, SHORT = 10, 2
#: Nodes of a key that are compared in one task; a key with more is cut into blocks, each pair of them a task.
BLOCK = 20_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NUMBERS = np.random.default_rng(8).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = [f"s{i}" for i in range(TABLES // 2)]
_CHECK = [f"v{i}" for i in range(BITS // 64)]


def majority(shingles: np.ndarray, numbers: int) -> np.ndarray:
    """So many numbers of 64 bits: a bit is 1 if it is in more than half of the shingles' hashes for that number."""
    if not len(shingles):
        return np.zeros(numbers, np.uint64)
    counts = np.zeros(64 * numbers, np.int64)
    salts = np.arange(1, numbers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for lo in range(0, len(shingles), 1 << 13):
        h = mix(shingles[lo : lo + (1 << 13), None] + salts)
        counts += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return np.packbits(2 * counts > len(shingles), bitorder="little").view(np.uint64)


def shingled(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the distinct runs of n words; fewer words are one run."""
    n = min(n, len(words))
    if not n:
        return words
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i] + np.uint64(n))
    return np.unique(h)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key``, the candidates' fingerprints ``s0..`` and the estimate's bits ``v0..`` of every row; words as
    for ``fingerprint``, null counts as empty text."""
    names = [*_SKETCH, *_CHECK]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                offsets = np.frombuffer(b.column(2).buffers()[1], np.int32, b.num_rows + 1, b.column(2).offset * 4)
                data = b.column(2).buffers()[2]
                x = _LOWER[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
                ends = (offsets - offsets[0]).astype(np.int64)
                start, end = word_bounds(x, ends)
                words = Rolling(_NUMBERS[x])(start, end)
                cuts = np.searchsorted(start, ends)
                out = np.zeros((b.num_rows, len(names)), np.uint64)
                for i, (p, q) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                    out[i, : len(_SKETCH)] = majority(shingled(words[p:q], SHORT), len(_SKETCH))
                    out[i, len(_SKETCH) :] = majority(shingled(words[p:q], WORDS), len(_CHECK))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c) for c in out.view(np.int64).T)], names=["doc_id", "row_key", *names])

    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit("").cast("binary")).alias("t")
    longs = ", ".join(f"{n} long" for n in names)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row_key"), text).mapInArrow(run, f"doc_id long, row_key {KEY}, {longs}")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of key, those that share theirs with a neighbour; one row is held at a time."""
    held_k, held_n, tied = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for b in batches:
        k, n = (np.concatenate([held, b.column(i).to_numpy()]) for i, held in enumerate((held_k, held_n)))
        if not len(k):
            continue
        same = k[1:] == k[:-1]
        some = np.concatenate([[tied], same]) | np.append(same, False)
        yield pa.RecordBatch.from_arrays([pa.array(k[:-1][some[:-1]]), pa.array(n[:-1][some[:-1]])], names=["key", "node"])
        held_k, held_n, tied = k[-1:], n[-1:], bool(some[-1])
    if tied:
        yield pa.RecordBatch.from_arrays([pa.array(held_k), pa.array(held_n)], names=["key", "node"])


def near_in(nodes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """For each node of a group, one of those it is connected with by links among them. Nodes are compared with all
    others until every one outside of the largest class has been: all pairs left are inside it."""
    label, done, x = np.arange(len(nodes)), np.zeros(len(nodes), bool), 0
    while True:
        near = np.bitwise_count(bits ^ bits[x]).sum(1) <= DIFFER
        label[np.isin(label, np.unique(label[near]))] = x
        done[x] = True
        left = np.flatnonzero(~done & (label != np.argmax(np.bincount(label))))
        if not len(left):
            return nodes[label]
        x = int(left[0])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``u, v`` of rows ``key, part, node, v0..`` in order of key and part, one a node and task at most."""
    forest, known = Forest(), set()

    def settle(rows: np.ndarray) -> None:
        if rows.shape[1] < 2:
            return
        nodes, bits = rows[2], np.ascontiguousarray(rows[3:].T).view(np.uint64)
        begin = np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)]))
        size = np.diff(np.append(begin, len(nodes)))
        two = begin[size == 2]
        two = two[np.bitwise_count(bits[two] ^ bits[two + 1]).sum(1) <= DIFFER]
        forest.add(nodes[two], nodes[two + 1])
        for s, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            group = nodes[s : s + n]
            name = hash(group.tobytes())
            if name not in known:
                known.add(name)
                if len({forest.root(i) for i in group.tolist()}) > 1:
                    forest.add(group, near_in(group, bits[s : s + n]))

    held = np.zeros((3 + len(_CHECK), 0), np.int64)
    for b in batches:
        rows = np.concatenate([held, np.stack([c.to_numpy() for c in b.columns])], axis=1) if b.num_rows else held
        last = rows.shape[1] - int(np.argmin(np.append((rows[:2, ::-1] == rows[:2, -1:]).all(0), False))) if rows.shape[1] else 0
        settle(rows[:, :last])
        held = rows[:, last:]
    settle(held)
    nodes = [n for n in forest.up if forest.root(n) != n]
    for lo in range(0, len(nodes), 50_000):
        part = nodes[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], names=["u", "v"])


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, component`` of every row: rows share a component if chains of documents lead from one to the
    other whose sets of five-word shingles have a similarity (Jaccard) of 0.8 or more, as far as 256 bits tell.

    Several short fingerprints stand for one: at that similarity 64 bits differ in about ten, far beyond what a ball can
    hold, while 32 bits over pairs of words differ in about three. Every node, a class of rows with equal sketches, emits
    the variants of each of its ten fingerprints within one bit (half of a radius of two); a shuffle on variants brings
    candidates together, and what collides is verified by its estimate bits. Null counts as empty; empty texts are near
    each other. Repeated rows share a node. No rows, no components.
    """
    made = stored(sketches(docs, id_col, text_col))
    names = [*_SKETCH, *_CHECK]
    nodes = stored(made.groupBy(*names).agg(F.count("*").alias("n")).drop("n").withColumn("node", F.monotonically_increasing_id()))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    halves = [F.shiftright(F.col(_SKETCH[t // 2]), 32 * (t % 2)).bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(t << 32)) for t in range(TABLES)]
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(32)])
    emitted = nodes.repartition(tasks, "node").select("node", F.explode(F.array(*halves)).alias("fp"))  # few bytes that become many: not to be coalesced
    emitted = emitted.select(F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("key"), "node")
    met = stored(emitted.repartition("key").sortWithinPartitions("key").mapInArrow(_met, "key long, node long"))
    blocks = met.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK).select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = lambda x: F.least(x, mine) * F.col("blocks") + F.greatest(x, mine)
    parts = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), other))
    dealt = met.join(blocks, "key", "left").select("key", F.explode(parts).alias("part"), "node").join(nodes.select("node", *_CHECK), "node")
    dealt = dealt.select("key", "part", "node", *_CHECK).repartition("key", "part").sortWithinPartitions("key", "part")
    found = components(cut(dealt.mapInArrow(_verify, "u long, v long")))
    rooted = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).select(*names, "component")
    return made.join(rooted, names).select("doc_id", "row_key", "component")
