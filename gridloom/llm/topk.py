"""Exact top-k search by inner product: columnar branch and bound over blocks of dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of the queries that a pass over the candidates carries; candidates that give the first thresholds; rows of a
#: candidate block; dimensions accumulated between two prunings; rows found that a task holds before it sifts them.
QUERY_BYTES, SEEDS, CANDIDATES, DIMS, HELD = 32 << 20, 16_384, 4096, 16, 1_000_000
#: Largest and smallest score.
MOST, LEAST = 2**63 - 1, -(2**63)
_FOUND = "query_id long, vec_id long, score long"


def quantised(vec: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a whole double; what exceeds the range of double is its largest value."""
    largest = F.lit(1.7976931348623157e308)

    def one(x: Column) -> Column:
        y = F.greatest(F.least(x.cast("double") * scale, largest), -largest)
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vec, one)


def usable(id_col: str, vec_col: str) -> Column:
    """False for rows whose id or vector is null, or whose vector holds a null, NaN or infinity."""
    sound = F.forall(vec_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False))


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole doubles of any size, clamped to the range of long."""
    whole = [int(v) for v in q.tolist()]
    return np.array([min(MOST, max(LEAST, sum(a * int(b) for a, b in zip(whole, row, strict=True)))) for row in x.tolist()], np.int64)


def search_block(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, floors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (query position, ids, scores) of the k best rows of x for each row of q, as far as they reach the query's
    floor; ties go to smaller ids. Raises floors to the k-th score found.

    Dimensions are stored vertically and taken block by block, heaviest first. What the rest can still add is at most
    the product of both remaining norms, so a candidate whose upper bound is below the floor, or below the k-th lower
    bound, goes. Where doubles cannot hold the sums, bounds are widened by their error and what survives is added up in
    whole numbers.
    """
    n, d = x.shape
    if not n or not len(q):
        return
    big_q, big_x = float(np.abs(q).max(initial=0)), float(np.abs(x).max(initial=0))
    whole = big_q < 2**52 and big_x < 2**52 and big_q * big_x * max(d, 1) < 2**52
    unit_q, unit_x, error = (1.0, 1.0, 0.0) if whole else (max(big_q, 1.0), max(big_x, 1.0), 1e-9)
    heavy = np.argsort(-((x / unit_x) ** 2).sum(0), kind="stable")
    columns, rows = np.ascontiguousarray((x / unit_x)[:, heavy].T), (q / unit_q)[:, heavy]
    starts = list(range(0, d, DIMS)) or [0]
    rest_x = [np.sqrt((columns[s + DIMS :] ** 2).sum(0)) for s in starts]
    rest_q = [np.sqrt((rows[:, s + DIMS :] ** 2).sum(1)) for s in starts]
    norm_x, norm_q = np.sqrt((columns**2).sum(0)), np.sqrt((rows**2).sum(1))
    # the floor, and where scores are clamped, in the units of the sums
    least = floors.astype(float) if whole else (floors.astype(float) - np.abs(floors.astype(float)) * 1e-12 - 1) / unit_q / unit_x
    top = np.inf if whole else 2.0**63 / unit_q / unit_x
    for lo in range(0, len(rows), 128):
        first = rows[lo : lo + 128, :DIMS] @ columns[:DIMS]
        for i, partial in enumerate(first, lo):
            alive = np.flatnonzero(x_ids != q_ids[i])
            partial = partial[alive]
            for b, s in enumerate(starts):
                if b:
                    partial = partial + rows[i, s : s + DIMS] @ columns[s : s + DIMS, alive]
                slack = rest_q[b][i] * rest_x[b][alive] * (1 + 1e-9) + error * norm_q[i] * norm_x[alive] + (1e-6 if whole and b + 1 < len(starts) else 0)
                low, bound = np.minimum(partial - slack, top), min(least[i], top)
                if len(alive) > k:
                    bound = max(bound, np.partition(low, len(low) - k)[len(low) - k])
                keep = np.minimum(partial + slack, top) >= bound
                alive, partial = alive[keep], partial[keep]
            score = partial.astype(np.int64) if whole else exact(q[i], x[alive])
            best = np.lexsort((x_ids[alive], -score.astype(float) if whole else [-s for s in score.tolist()]))[:k]
            if len(best) == k:
                floors[i] = max(floors[i], score[best[-1]])
            yield i, x_ids[alive[best]], score[best]


def stacked(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of d components; shorter vectors end in zeros."""
    size, flat = vectors.value_lengths().to_numpy(), vectors.flatten().to_numpy()
    if (size == d).all():
        return flat.reshape(len(size), d)
    out = np.zeros((len(size), d))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    row = np.repeat(np.arange(len(size)), size)
    out[row[at < d], at[at < d]] = flat[at < d]
    return out


def _search(q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, k: int):
    """A pass of candidates ``vec_id, vec`` by the queries; k rows a query and task at most."""

    def sift(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        i, ids, score = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((ids, ~score, i))  # ~s falls as s rises, also at the ends of the range
        i = i[order]
        begin = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, np.int64)
        rank = np.arange(len(i)) - np.repeat(begin, np.diff(np.append(begin, len(i))))
        return tuple(c[order][rank < k] for c in (np.concatenate([h[0] for h in held]), ids, score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, held, size = floors.copy(), [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, CANDIDATES):
                part = batch.slice(lo, CANDIDATES)
                for i, ids, score in search_block(q, q_ids, stacked(part.column(1), q.shape[1]), part.column(0).to_numpy(), k, mine):
                    held.append((np.full(len(ids), i), ids, score))
                    size += len(ids)
                if size > HELD:
                    held = [sift(held)]
                    size = len(held[0][0])
        if held:
            i, ids, score = sift(held)
            for lo in range(0, len(i), 1 << 16):
                e = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i[e]]), pa.array(ids[e]), pa.array(score[e])], names=["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """Exact k best candidates of each query: ``query_id, rank, vec_id, score``.

    Both inputs hold ``vec_id`` and ``vec`` (arrays of whole doubles, no nulls); other columns are ignored. A candidate
    with the query's own id takes no part. Shorter vectors count as padded with zeros. A query id that comes twice is
    searched once, with its smallest vector; repeated candidate rows are candidates each. Scores are whole numbers;
    beyond the range of long they are clamped to it, and tie there. An empty side gives an empty result.

    Candidates stay where they are. Queries go over them in blocks of bounded size, a pass each, with floors: the k-th
    score of each query among a bounded number of candidates, which a first small pass finds. Tasks return what reaches
    the floor, k rows a query at most, and a window picks the k best of these.
    """
    rows, pick = candidates.select("vec_id", "vec"), F.xxhash64(F.lit(2), "vec_id")
    queries = queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    shape = queries.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    near, d = candidates.sparkSession.createDataFrame([], _FOUND), shape["d"] or 0
    blocks = -(-shape["n"] * 8 * max(1, d) // QUERY_BYTES)
    seeds = rows.orderBy(pick, "vec_id").limit(SEEDS).repartition(8) if blocks else None
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for block in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toArrow()
        if not mine.num_rows:
            continue
        q_ids, q = mine.column("vec_id").to_numpy(), stacked(mine.column("vec").combine_chunks(), d)
        floors = np.full(len(q), LEAST, np.int64)
        known = seeds.mapInArrow(_search(q, q_ids, floors, k), _FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
        for r in known.collect():  # one a query of the block at most
            floors[np.searchsorted(q_ids, r["query_id"])] = r["score"]
        near = near.unionByName(rows.mapInArrow(_search(q, q_ids, floors, k), _FOUND))
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
