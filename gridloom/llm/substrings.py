"""Exact substring deduplication by a sparse suffix array.

A text is a sequence of units, bytes or words. A unit goes if a window, a string of ``Grain.window`` units that covers
it, starts anywhere else. Nearly every unit starts a window; shipping that many suffixes would take tens of times the
input. So suffixes are taken at sampled places first, and every round sorts suffixes in the same way (``sort_suffixes``):
splitters sampled from the suffixes themselves range-partition them by their leading tokens (the text's own first bytes
or words, in text order, then hashes of the rest), each range sorts its own by multikey quicksort and reads runs of
equal suffixes off its neighbours, and runs at the ends of ranges are compared across these boundaries.

1. Each window is dealt to an anchor: the place of the least hash among its ``core``-unit strings. Equal windows have
   equal anchors. The suffixes sorted are those at anchors. The windows of one anchor share its core and lie in a hull,
   their union. A core that comes once decides that none of its windows repeats; a hull that comes twice, that all do.
2. The windows of anchors left open, with one text of every class of equal hulls to compare with, are cut into pieces of
   ``piece`` windows by their distance to the anchor; the suffixes at their common parts are sorted likewise.
3. Each window of the pieces left open is a suffix of its own.

Equality rests on 128 bits of hash beside the raw leading tokens. Tasks merge equal suffixes before they are dealt, so a
range gets at most one row of a suffix from each task; a hot leading token, or a hot core in many contexts, is divided
among ranges by the tokens behind it. Matches stay in a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, held, key_parts, stored

#: Units worked on at once; suffixes that a task merges at once; suffixes that a range holds, as estimated beforehand;
#: sampled suffixes for each range.
CHUNK, MERGED, RANGE, SAMPLED = 1 << 20, 500_000, 1_000_000, 64
_PLACE = np.uint64((1 << 24) - 1)
_RNG = np.random.default_rng(20)
_BYTE, _OTHER = (_RNG.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_BASE = 0x9E3779B97F4A7C15 | 5
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_TOP = np.uint64(1 << 63)


@dataclass(frozen=True)
class Grain:
    """What texts are sequences of, units of a window and of an anchor's core, and windows of a piece."""

    name: str
    window: int
    core: int
    piece: int

    @property
    def reach(self) -> int:
        """Windows that one anchor can have."""
        return self.window - self.core + 1


#: Bytes, as the contract of op3 has it. Words are what lies between blanks; a passage of fifty of them or more repeats.
BYTES, WORDS = Grain("bytes", 400, 200, 32), Grain("words", 50, 16, 8)


class Rolling:
    """Hashes of any substrings of a sequence, from sums of its units' numbers times powers of an odd base, mod 2^64."""

    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, numbers: np.ndarray):
        if len(self.powers) < len(numbers) + 1:
            size = 1 << int(len(numbers)).bit_length()
            Rolling.powers, Rolling.inverses = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * self.powers[: len(numbers)])])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverses[start])

    def every(self, size: int) -> np.ndarray:
        """Of each string of so many units."""
        count = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:count]) * self.inverses[:count])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_bounds(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after the other in x and end there."""
    ink = ~_BLANK[x]
    fresh = np.ones(len(x) + 1, bool)
    fresh[1:] = ~np.append(ink, False)[:-1]
    fresh[ends] = True
    return np.flatnonzero(ink & fresh[:-1]), np.flatnonzero(ink & np.append(fresh[1:-1] | ~ink[1:], True)) + 1 if len(x) else np.zeros(0, np.int64)


def heads(x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The eight bytes from each start as a number that sorts as they do, with zeros from the end on."""
    at = start[:, None] + np.arange(8)
    got = np.where(at < end[:, None], x[np.minimum(at, len(x) - 1)], 0).astype(np.uint8)
    return (got.view(">u8")[:, 0].astype(np.uint64) ^ _TOP).view(np.int64)


class Units:
    """The units of the texts of a batch: how many end before each text does, two rolling hashes, leading tokens."""

    def __init__(self, grain: Grain, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        data = texts.buffers()[2]
        self.x = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.ends = offsets - offsets[0]
        self.words = grain.name == WORDS.name
        if self.words:
            self.start, self.end = word_bounds(self.x, self.ends)
            self.ends = np.searchsorted(self.start, self.ends)

    def __len__(self) -> int:
        return int(self.ends[-1])

    def rolling(self, lo: int, hi: int) -> tuple[Rolling, Rolling]:
        if not self.words:
            return tuple(Rolling(t[self.x[lo:hi]]) for t in (_BYTE, _OTHER))
        a, b = self.start[lo:hi], self.end[lo:hi]
        return tuple(Rolling(Rolling(t[self.x[a[0] : b[-1]]])(a - a[0], b - a[0])) for t in (_BYTE, _OTHER))

    def leading(self, at: np.ndarray) -> list[np.ndarray]:
        """The first two tokens from each place: two words, or two runs of eight bytes."""
        if self.words:
            return [heads(self.x, self.start[at + i], self.end[at + i]) for i in (0, 1)]
        return [heads(self.x, at + 8 * i, at + 8 * i + 8) for i in (0, 1)]


def packed(lo: np.ndarray, hi: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First window, last window, place of the anchor and first window of the context in one number."""
    return lo << 29 | (lo - at) << 20 | (hi - lo) << 11 | (place - lo) << 2


def unpacked(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lo = pos >> 29
    return lo, lo + (pos >> 11 & 511), lo + (pos >> 2 & 511), lo - (pos >> 20 & 511)


def anchors(roll: Rolling, grain: Grain) -> np.ndarray:
    """For each window, the place of its anchor."""
    least = roll.every(grain.core)
    least = (least & ~_PLACE) | np.arange(len(least), dtype=np.uint64)
    size = 1
    while 2 * size <= grain.reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = len(roll.sums) - grain.window
    return (np.minimum(least[:count], least[grain.reach - size : grain.reach - size + count]) & _PLACE).astype(np.int64)


def hull_tokens(rolls: tuple[Rolling, Rolling], place: np.ndarray, lo: np.ndarray, hi: np.ndarray, grain: Grain) -> list[np.ndarray]:
    shape = np.uint64(0x632BE59BD9B4E019) * ((place - lo) * 1024 + (hi - lo)).astype(np.uint64)
    return [mix(r(lo, hi + grain.window) + shape).view(np.int64) for r in rolls]


#: Columns of a suffix: five tokens (two raw ones, core, hull twice), the row's key and its place.
TOKENS = ["t0", "t1", "t2", "t3", "t4"]
Block = list[np.ndarray]


def anchor_suffixes(grain: Grain, batch: pa.RecordBatch) -> Iterator[Block]:
    """The first round's suffixes of a batch of ``k1, k2, text``."""
    units = Units(grain, batch.column(2))
    k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
    total, step = len(units), CHUNK // 8 if units.words else CHUNK
    for base in range(0, total - grain.window + 1, step):
        upto = min(base + step + grain.window - 1, total)
        rolls = units.rolling(base, upto)
        place = anchors(rolls[0], grain)
        count = len(place)
        a, b = np.searchsorted(units.ends, [base, base + count - 1], "right") - 1
        mine = np.arange(a, b + 1)
        lengths = np.minimum(units.ends[mine + 1], base + count) - np.maximum(units.ends[mine], base)
        doc = np.repeat(mine, np.maximum(lengths, 0))
        whole = np.arange(base, base + count) + grain.window <= units.ends[doc + 1]
        fresh = np.ones(count + 1, bool)
        fresh[1:-1] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
        lo, hi = np.flatnonzero(whole & fresh[:-1]), np.flatnonzero(whole & fresh[1:])
        if not len(lo):
            continue
        p, d = place[lo], doc[lo]
        first = base - units.ends[d]
        yield [*units.leading(base + p), rolls[0](p, p + grain.core).view(np.int64), *hull_tokens(rolls, p, lo, hi, grain), k1[d], k2[d], packed(first + lo, first + hi, first + p, first + lo)]


def piece_suffixes(grain: Grain, batch: pa.RecordBatch) -> Iterator[Block]:
    """The second round's suffixes of a batch of contexts ``k1, k2, pos, text``."""
    units, (k1, k2, pos) = Units(grain, batch.column(3)), (batch.column(i).to_numpy() for i in range(3))
    if not len(units):
        return
    rolls = units.rolling(0, len(units))
    at, last, place, _ = unpacked(pos)
    begin, windows, place = units.ends[:-1], last - at + 1, place - at
    for p in range((grain.reach - 1) // grain.piece + 1):
        near, far = p * grain.piece, min(p * grain.piece + grain.piece, grain.reach) - 1
        lo, hi = np.maximum(0, place - far), np.minimum(windows - 1, place - near)
        i = np.flatnonzero(lo <= hi)
        if len(i):
            lo, hi, anchor, b = lo[i], hi[i], place[i], begin[i]
            core = mix(rolls[0](b + anchor - near, b + anchor - far + grain.window) + np.uint64(p))
            yield [*units.leading(b + anchor - near), core.view(np.int64), *hull_tokens(rolls, b + anchor, b + lo, b + hi, grain), k1[i], k2[i], packed(at[i] + lo, at[i] + hi, at[i] + anchor, at[i])]


def window_suffixes(grain: Grain, batch: pa.RecordBatch) -> Iterator[Block]:
    """The third round's suffixes of a batch of contexts with open pieces, ``k1, k2, pos, text, pieces``."""
    units, (k1, k2, pos) = Units(grain, batch.column(3)), (batch.column(i).to_numpy() for i in range(3))
    pieces = batch.column(4)
    if not len(units):
        return
    rolls = units.rolling(0, len(units))
    of = np.repeat(np.arange(len(pieces)), pieces.value_lengths().to_numpy())
    lo, hi, _, _ = unpacked(pieces.flatten().to_numpy())
    size = hi - lo + 1
    row, at = np.repeat(of, size), unpacked(pos)[0]
    window = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - lo, size)
    start = units.ends[row] + window - at[row]
    zero = np.zeros(len(row), np.int64)
    yield [*units.leading(start), *(r(start, start + grain.window).view(np.int64) for r in rolls), zero, k1[row], k2[row], packed(window, window, window, window)]


def multikey_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by their tokens, and where runs of equal rows begin in it: each token in turn divides what
    the ones before left equal, and only that."""
    order = np.argsort(tokens[:, 0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = tokens[order[1:], 0] != tokens[order[:-1], 0]
    for c in range(1, tokens.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        run = np.cumsum(new)[at]
        again = np.lexsort((tokens[order[at], c], run))
        order[at] = order[at][again]
        value = tokens[order[at], c]
        new[at[1:]] |= (value[1:] != value[:-1]) & (run[1:] == run[:-1])
    return order, np.flatnonzero(new)


def range_of(tokens: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """How many splitters are not above each row; rows by rows of tokens, both."""
    lo, hi = np.zeros(len(tokens), np.int64), np.full(len(tokens), len(splitters))
    for _ in range(len(splitters).bit_length()):
        mid = np.minimum((lo + hi) // 2, max(0, len(splitters) - 1))
        less, equal = np.zeros(len(tokens), bool), np.ones(len(tokens), bool)
        for c in range(tokens.shape[1]):
            s, t = splitters[mid, c], tokens[:, c]
            less |= equal & (s < t)
            equal &= s == t
        go = (less | equal) & (lo < hi)
        hi = np.where(~go & (lo < hi), mid, hi)
        lo = np.where(go, mid + 1, lo)
    return lo


def _dealt(emit: Callable, splitters: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Suffixes with their range, ``t0.., k1, k2, pos, part``. Equal ones of a task meet in one, whose number in the low
    bits of ``pos`` is 2; the others have 0, are known to repeat, and go to any range."""

    def flush(held: list[Block]) -> Iterator[pa.RecordBatch]:
        rows = np.stack([np.concatenate(c) for c in zip(*held, strict=True)])
        tokens = np.ascontiguousarray(rows[:5].T)
        order, begin = multikey_order(tokens)
        n = np.zeros(len(order), np.int64)
        n[order[begin]] = np.minimum(np.diff(np.append(begin, len(order))), 2)
        part = np.where(n > 0, range_of(tokens, splitters), (rows[7] >> 29) % (len(splitters) + 1))
        rows[7] |= n
        rows[:5, n == 0] = 0
        for s in range(0, len(n), 1 << 16):
            e = slice(s, s + (1 << 16))
            yield pa.RecordBatch.from_arrays([*(pa.array(c[e]) for c in rows), pa.array(part[e].astype(np.int32))], names=[*TOKENS, "k1", "k2", "pos", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for block in emit(batch):
                held.append(block)
                size += len(block[0])
                if size > MERGED:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


_SORTED = "k1 long, k2 long, pos long, repeats boolean, lead boolean, mixed boolean, edge boolean, part int, t0 long, t1 long, t2 long"


def _sorted_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range, the suffixes whose core comes twice or lies at an end of it. ``repeats``: the hull comes twice;
    ``lead``: the first of its hull; ``mixed``: the core has several hulls; ``edge``: a core at an end of the range."""
    names = ["k1", "k2", "pos", "repeats", "lead", "mixed", "edge", "part", "t0", "t1", "t2"]

    def rows_of(held: np.ndarray, repeats: np.ndarray, lead: np.ndarray, mixed: np.ndarray, edge: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
        for s in range(0, held.shape[1], 1 << 16):
            e = slice(s, s + (1 << 16))
            columns = [*(pa.array(held[c, e]) for c in (5, 6, 7)), *(pa.array(b[e]) for b in (repeats, lead, mixed, edge)), pa.array(np.full(len(edge[e]), part, np.int32)), *(pa.array(held[c, e], mask=~edge[e]) for c in (0, 1, 2))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    blocks, part = [], 0
    for b in batches:
        rows = np.stack([b.column(i).to_numpy() for i in range(8)]) if b.num_rows else np.zeros((8, 0), np.int64)
        known = (rows[7] & 3) == 0
        if known.any():
            no = np.zeros(int(known.sum()), bool)
            yield from rows_of(rows[:, known], ~no, no, no, no, 0)
        if not known.all():
            part = int(b.column(8)[int(np.argmin(known))].as_py())
            blocks.append(rows[:, ~known])
    if blocks:
        rows = np.concatenate(blocks, axis=1)
        blocks.clear()
        order, begin = multikey_order(np.ascontiguousarray(rows[:5].T))
        rows = rows[:, order]
        n = rows[7] & 3
        size = np.diff(np.append(begin, len(n)))
        hull = np.repeat(np.arange(len(begin)), size)
        repeats = (np.add.reduceat(n, begin) > 1)[hull]
        lead = np.zeros(len(n), bool)
        lead[begin] = True
        core = np.ones(len(n), bool)
        core[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(0)
        runs, at = np.flatnonzero(core), np.cumsum(core) - 1
        mixed = (np.add.reduceat(lead.astype(np.int64), runs) > 1)[at]
        edge = (at == 0) | (at == at[-1])
        some = mixed | repeats | edge
        yield from rows_of(rows[:, some], repeats[some], lead[some], mixed[some], edge[some], part)


def sorted_ranges(source: DataFrame, emit: Callable, rows: int, expected: int) -> DataFrame:
    """What each range finds of the suffixes that ``emit`` makes of batches of source. ``rows`` and ``expected`` are the
    sizes of source and of its suffixes, which set how many ranges there are and how large a sample gives the splitters;
    results do not depend on these."""
    spark = source.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected // RANGE))
    wanted = SAMPLED * ranges
    one_in = max(1, min(expected // wanted, rows // (4 * ranges)))
    schema = ", ".join(f"{c} long" for c in [*TOKENS, "k1", "k2", "pos"]) + ", part int"
    some = source.filter(F.pmod(F.xxhash64(F.lit(3), "k1", "k2"), F.lit(one_in)) == 0).mapInArrow(_dealt(emit, np.zeros((0, 5), np.int64)), schema)
    some = some.filter("pos % 4 > 0").select(*TOKENS).orderBy(F.xxhash64(*TOKENS)).limit(wanted).collect()  # bounded by the number of ranges
    seen = np.unique(np.array([tuple(r) for r in some], np.int64).reshape(-1, 5), axis=0)
    splitters = seen[np.unique(np.linspace(0, len(seen), ranges + 1).astype(int)[1:-1])] if len(seen) >= ranges else seen
    dealt = source.mapInArrow(_dealt(emit, splitters), schema).repartitionById(len(splitters) + 1, F.col("part"))
    return dealt.mapInArrow(_sorted_range, _SORTED)


def sort_suffixes(source: DataFrame, emit: Callable, rows: int, expected: int) -> DataFrame:
    """``k1, k2, pos, repeats, open`` of the suffixes that are not alone: ``repeats`` if they come twice; ``open`` if
    something shares their core only, for those that are alone and one of those that repeat."""
    found = held(sorted_ranges(source, emit, rows, expected))
    across = found.filter("edge").groupBy("t0", "t1", "t2").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b")
    across = across.select("t0", "t1", "t2", F.lit(True).alias("on"))  # one a boundary at most, so it may be broadcast
    inside = found.filter("NOT edge").select("k1", "k2", "pos", "repeats", (F.col("lead") & F.col("mixed")).alias("open"))
    ends = found.filter("edge").join(F.broadcast(across), ["t0", "t1", "t2"], "left")
    ends = ends.select("k1", "k2", "pos", "repeats", (F.col("lead") & (F.col("mixed") | F.coalesce("on", F.lit(False)))).alias("open"))
    return inside.unionByName(ends).filter("repeats OR open")


def _contexts(grain: Grain) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``k1, k2, pos, text`` of listed anchors: the text of their hulls."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                units, pos = Units(grain, part.column(2)), part.column(3)
                count = pos.value_lengths().to_numpy()
                row, pos = np.repeat(np.arange(len(count)), count), pos.flatten().to_numpy()
                first, last, _, _ = unpacked(pos)
                a, b = units.ends[row] + first, units.ends[row] + last + grain.window
                if units.words:
                    a, b = units.start[a], units.end[b - 1]
                k1, k2 = (part.column(i).to_numpy()[row] for i in (0, 1))
                for s in range(0, len(row), 2048):
                    e = slice(s, s + 2048)
                    texts = [units.x[i:j].tobytes() for i, j in zip(a[e].tolist(), b[e].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(k1[e]), pa.array(k2[e]), pa.array(pos[e] & ~3), pa.array(texts, pa.binary())], names=["k1", "k2", "pos", "text"])

    return run


def _each(emit: Callable, grain: Grain, rows: int) -> Callable[[pa.RecordBatch], Iterator[Block]]:
    """Calls emit with slices of so many rows at most."""

    def run(batch: pa.RecordBatch) -> Iterator[Block]:
        for lo in range(0, batch.num_rows, rows):
            yield from emit(grain, batch.slice(lo, rows))

    return run


def _first_window(pos: Column) -> Column:
    return F.shiftright(pos, 29) - F.shiftright(pos, 20).bitwiseAND(F.lit(511))


def repeated_windows(keyed: DataFrame, grain: Grain, rows: int, size: int) -> list[DataFrame]:
    """``k1, k2, lo, hi`` of windows that repeat, from ``k1, k2, text`` (binary, no nulls) of so many rows and bytes."""
    first = sort_suffixes(keyed, _each(anchor_suffixes, grain, 2048), rows, size // 80)
    listed = first.filter("open").groupBy("k1", "k2").agg(F.collect_list("pos").alias("los"))
    once = keyed.join(listed, ["k1", "k2"]).withColumn("copy", F.expr("row_number() OVER (PARTITION BY k1, k2 ORDER BY 1)")).filter("copy = 1")  # equal rows hold one text
    contexts = stored(once.select("k1", "k2", "text", "los").mapInArrow(_contexts(grain), "k1 long, k2 long, pos long, text binary"))
    n = contexts.count()
    second = sort_suffixes(contexts, _each(piece_suffixes, grain, 2048), n, n * 4)
    listed = second.filter("open").withColumn("at", _first_window(F.col("pos"))).groupBy("k1", "k2", "at").agg(F.collect_list("pos").alias("pieces"))
    joined = contexts.withColumn("at", F.shiftright("pos", 29)).join(listed, ["k1", "k2", "at"]).select("k1", "k2", "pos", "text", "pieces")
    last = sorted_ranges(joined, _each(window_suffixes, grain, 2048), n, n * grain.piece)
    first, second, last = (f.filter("repeats").select("k1", "k2", F.shiftright("pos", 29).alias("lo"), (F.shiftright("pos", 29) + F.shiftright("pos", 11).bitwiseAND(F.lit(511))).alias("hi")) for f in (first, second, last))
    return [first, second, held(last)]


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint [lo, hi) of the same places; touching ones are joined."""
    order = np.argsort(lo, kind="stable")
    lo, top = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > top[:-1]]) if len(lo) else np.zeros(0, bool)
    return lo[new], top[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)] if len(lo) else top


def widened(raw: bytes, ends: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans of UTF-8 text, grown to the ends of the characters that they cut; spans that meet then are
    one. A byte of no character is left as it is."""
    out: list[tuple[int, int]] = []
    for a, b in ends:
        a, b = _character(raw, a)[0], _character(raw, b)[1]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _character(raw: bytes, at: int) -> tuple[int, int]:
    """Start and end of the character that a cut before byte ``at`` divides; the cut itself if it divides none."""
    for start in range(at - 1, max(-1, at - 4), -1):
        lead = raw[start]
        if lead & 0xC0 != 0x80:
            end = start + (4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1)
            tail = raw[start + 1 : end]
            if at < end <= len(raw) and all(c & 0xC0 == 0x80 for c in tail):
                return start, end
            break
    return at, at


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grain: Grain = BYTES, whole_characters: bool = False, passages: Grain | None = None, into: Sequence[str] = ("n_bytes", "spans", "kept")) -> DataFrame:
    """Adds ``n_bytes, spans, kept`` (or the names in ``into``): the length of a text, its maximal removed runs as [start, end) in bytes and what is
    left. With ``passages``, also ``n_passage_units``: how many units of that grain lie in its repeated windows.

    Null counts as empty. All copies of a repeat go, also those within one text. Rows may repeat: they are copies of
    each other. Other columns pass through, those that bear a new name are replaced. With ``whole_characters`` runs of
    bytes are widened to the characters that they cut. Words are compared without the blanks between them; a run of them
    ends with its last word.
    """
    new = [*into, *(["n_passage_units"] if passages else [])]
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in {n.lower() for n in new}])
    names, pair = docs.columns, pa.struct([("start", pa.int64()), ("end", pa.int64())])
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    types = [T.LongType(), span, T.BinaryType(), T.LongType()]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(new, types))])  # noqa: B905

    text = F.col(f"`{text_col}`").cast("binary")
    keyed = docs.select(*key_parts(id_col, text_col), text.alias("text")).filter("text IS NOT NULL")
    size = keyed.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    spans = None
    for g in [grain, *([passages] if passages else [])]:
        long_enough = keyed.filter(F.octet_length("text") >= (g.window if g.name == "bytes" else 2 * g.window - 1))
        for part in repeated_windows(long_enough, g, size["n"], size["b"] or 0):
            part = part.withColumn("g", F.lit(g is not grain))
            spans = part if spans is None else spans.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, spans, kept, inside = [], [], [], []
            texts = batch.column(names.index(text_col)).cast(pa.binary())
            for value, windows in zip(texts, batch.column(len(names)), strict=True):
                raw = value.as_py() or b""
                ends, covered = [], 0
                if windows.is_valid:
                    g, lo, hi = (c.to_numpy(zero_copy_only=False) for c in windows.values.flatten())
                    a, b = merged(lo[~g], hi[~g] + grain.window)
                    if grain.name == WORDS.name and len(a):
                        start, end = word_bounds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                        a, b = start[a], end[b - 1]
                    ends = [*zip(a.tolist(), b.tolist(), strict=True)]
                    if passages:
                        a, b = merged(lo[g], hi[g] + passages.window)
                        covered = int((b - a).sum())
                if whole_characters:
                    ends = widened(raw, ends)
                lengths.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in ends])
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in ends)], [*(a for a, _ in ends), len(raw)], strict=True)))
                inside.append(covered)
            added = [pa.array(lengths, pa.int64()), pa.array(spans, pa.list_(pair)), pa.array(kept, pa.binary()), pa.array(inside, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *added[: len(new)]], names=[*names, *new])

    a, b, w = fresh(docs, "k1", "k2", "windows")
    found = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "lo", "hi")).alias(w)).toDF(a, b, w)
    both = docs.withColumns(dict(zip((a, b), key_parts(id_col, text_col), strict=True)))
    return both.join(found, [a, b], "left").select(*[f"`{c}`" for c in names], w).mapInArrow(run, schema)
