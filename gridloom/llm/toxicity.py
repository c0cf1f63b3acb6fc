"""Toxic spans by a linear-chain conditional random field, trained here, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut
from .logistic import logistic

#: Labelled documents that the model is fitted on, at most, and bytes of their texts: whole texts, as many as fit.
LABELLED, BYTES = 6000, 64 << 20
#: Tokens of a block: texts are worked on in blocks of so many, which hand their messages on. Blocks worked on at once.
#: Lengths of the prefixes that a token's features include.
BLOCK, AT_ONCE, PREFIXES = 64, 2048, (4, 5, 6, 7)
#: A feature marks its tokens as toxic in toxic documents if it is in so many of these, and so much likelier there.
SUPPORT, RATIO = 5, 12.0
#: The least weight that a model keeps.
LEAST = 1e-3
#: Words whose emission a task remembers, at most.
CACHED = 400_000
TOKEN = re.compile(r"\w+")


def features_of(token: str) -> list[str]:
    return [token, *[f"{token[:n]}*" for n in PREFIXES if len(token) > n]]


def tokens_of(text: str) -> list[str]:
    low = text.lower()
    return TOKEN.findall(low) if len(low) == len(text) else [t.lower() for t in TOKEN.findall(text)]


def blocks(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many tokens, the place of each token of each block in all tokens, which places are real, and which
    blocks begin a text."""
    starts, count = np.cumsum(lengths) - lengths, -(-lengths // BLOCK)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = (np.repeat(starts, count) + nth * BLOCK)[:, None] + np.arange(BLOCK)
    real = at < np.repeat(starts + lengths, count)[:, None]
    return np.where(real, at, 0), real, nth == 0


def transfer(psi: np.ndarray, real: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The product of all steps inside each block, as four rows (from 0 to 0, 0 to 1, 1 to 0, 1 to 1), up to a factor."""
    a, b, c, d = np.ones(psi.shape[1]), np.zeros(psi.shape[1]), np.zeros(psi.shape[1]), np.ones(psi.shape[1])
    for t in range(1, len(psi)):
        new = a * m[0, 0] + b * m[1, 0], (a * m[0, 1] + b * m[1, 1]) * psi[t], c * m[0, 0] + d * m[1, 0], (c * m[0, 1] + d * m[1, 1]) * psi[t]
        if not real[t].all():
            new = tuple(np.where(real[t], x, old) for x, old in zip(new, (a, b, c, d), strict=True))
        if t % 4 == 0 or t + 1 == len(psi):  # before anything can overflow
            size = 1 / np.maximum(np.maximum(new[0], new[1]), np.maximum(new[2], new[3]))
            new = tuple(x * size for x in new)
        a, b, c, d = new
    return np.stack([a, b, c, d])


def messages(inner: np.ndarray, psi: np.ndarray, head: np.ndarray, start: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What comes to each block of a text from the ones before and behind: the odds of state 1 at its first token, but for
    that token's own emission, and at its last, as seen from the rest of the text."""
    before, behind = np.full(len(head), np.exp(start[1] - start[0])), np.ones(len(head))
    nth = np.arange(len(head)) - np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    order = np.argsort(nth, kind="stable")
    levels = np.split(order, np.searchsorted(nth[order], np.arange(1, int(nth.max(initial=0)) + 1)))
    a, b, c, d = inner
    for at in levels[1:]:
        r = before[at - 1] * psi[at - 1]
        r = (b[at - 1] + r * d[at - 1]) / (a[at - 1] + r * c[at - 1])
        before[at] = (m[0, 1] + r * m[1, 1]) / (m[0, 0] + r * m[1, 0])
    for at in levels[:0:-1]:
        s = (c[at] + d[at] * behind[at]) / (a[at] + b[at] * behind[at]) * psi[at]
        behind[at - 1] = (m[1, 0] + m[1, 1] * s) / (m[0, 0] + m[0, 1] * s)
    return before, behind


def marginals(emission: np.ndarray, real: np.ndarray, start: np.ndarray, step: np.ndarray, count: bool = True, head: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over texts of two states, state 0 emitting 0: P(state 1) of each place, and, if asked to count,
    the expected number of each step. Rows are the blocks of texts one after the other; ``head`` says which begin one
    (all, if it is not given). Padding is at the end of texts. Both passes carry odds, and blocks hand theirs on, so
    that the marginals are those of the whole text."""
    n, length = emission.shape
    head, m, p, steps = np.ones(n, bool) if head is None else head, np.exp(step), np.zeros((n, length)), np.zeros((2, 2))
    if not n:
        return p, steps
    parts = [slice(lo, lo + AT_ONCE) for lo in range(0, n, AT_ONCE)]
    psi_of = lambda part: np.exp(np.clip(np.ascontiguousarray(np.where(real[part], emission[part], 0).T), -30, 30))
    first = np.exp(np.clip(np.where(real[:, 0], emission[:, 0], 0), -30, 30))
    inner = np.ones((4, n)) if head.all() else np.concatenate([transfer(psi_of(part), real[part].T, m) for part in parts], axis=1)
    before, behind = messages(inner, first, head, start, m)
    last = np.zeros(n)
    for part in parts:
        psi, ok = psi_of(part), np.ascontiguousarray(real[part].T)
        r, s, end = np.empty(psi.shape), np.empty(psi.shape), behind[part]
        r[0] = before[part] * psi[0]
        for t in range(1, length):
            np.divide(m[0, 1] + r[t - 1] * m[1, 1], m[0, 0] + r[t - 1] * m[1, 0], out=r[t])
            r[t] *= psi[t]
        s[-1] = end
        full = ok.all(1)
        for t in range(length - 2, -1, -1):
            x = psi[t + 1] * s[t + 1]
            np.divide(m[1, 0] + m[1, 1] * x, m[0, 0] + m[0, 1] * x, out=s[t])
            if not full[t + 1]:
                s[t] = np.where(ok[t + 1], s[t], end)
        both = r * s
        p[part] = (both / (1 + both)).T
        if count:
            steps += _pairs(r[:-1][ok[1:]], (psi[1:] * s[1:])[ok[1:]], m)
            last[part] = r[-1]
            first[part] *= s[0]
    if count and not head.all():
        at = np.flatnonzero(~head)
        steps += _pairs(last[at - 1], first[at], m)
    return p, steps


def _pairs(r: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The expected number of each step, from the odds before and behind each."""
    a, b, c = m[0, 1] * x, m[1, 0] * r, m[1, 1] * r * x
    total = 1 / (m[0, 0] + a + b + c)
    return np.array([[m[0, 0] * total.sum(), a @ total], [b @ total, c @ total]])


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    start: np.ndarray
    step: np.ndarray
    calibration: np.ndarray

    def emissions(self, tokens: list[str], cache: dict[str, float]) -> np.ndarray:
        if len(cache) > CACHED:
            cache.clear()
        for t in set(tokens).difference(cache):
            cache[t] = self.bias + sum(self.weights.get(f, 0.0) for f in features_of(t))
        return np.fromiter(map(cache.__getitem__, tokens), float, len(tokens))

    def tag(self, texts: list[list[str]], cache: dict[str, float]) -> list[np.ndarray]:
        """P(toxic) of each token of each text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = self.emissions([w for t in texts for w in t], cache)
        if not len(flat):
            return [np.zeros(0)] * len(texts)
        at, real, head = blocks(lengths)
        p = np.zeros(len(flat))
        p[at[real]] = marginals(flat[at], real, self.start, self.step, False, head)[0][real]
        return np.split(p, np.cumsum(lengths)[:-1])

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(summary(p) @ self.calibration, -30, 30))))


def summary(p: np.ndarray) -> np.ndarray:
    """What the document score is calibrated on: how many tokens are expected to be toxic, what share, and the surest.
    Marginals under a fifth are left out of the sum, or a long text would gather a toxic token from nothing."""
    total = float(p[p >= 0.2].sum())
    return np.array([1.0, np.log1p(total), min(total, 3.0), total / max(20, len(p)) * 10, float(p.max(initial=0))])


def train(texts: list[str], toxic: list[int], rounds: int = 80) -> Model:
    """Labels tokens from labelled documents, fits the field to these by gradient ascent, then calibrates scores.

    A token of a toxic document counts as toxic if one of its features (the word or a prefix) is far likelier in toxic
    documents. Without documents of both labels, every score is low.
    """
    number: dict[str, int] = {}  # a number for each word
    tokens = [np.fromiter((number.setdefault(w, len(number)) for w in tokens_of(t)), np.int32) for t in texts]
    y, lengths = np.array(toxic, float), np.array([len(t) for t in tokens], np.int64)
    features = [features_of(w) for w in number]
    number.clear()
    seen = [Counter(), Counter()]
    for label in (0, 1):
        docs, count = np.zeros(len(features), np.int64), np.flatnonzero(y == label)
        for i in count.tolist():
            docs[np.unique(tokens[i])] += 1
        # a document counts once for a word, and for a prefix once for each of its words
        for n, fs in zip(docs.tolist(), features, strict=True):
            if n:
                for x in fs:
                    seen[label][x] += n
    n1, n0 = y.sum() + 1, len(y) - y.sum() + 1
    marks = {f for f, c in seen[1].items() if c >= SUPPORT and (c / n1) / ((seen[0][f] + 0.5) / n0) >= RATIO}
    ids = {f: i + 1 for i, f in enumerate(f for f, c in (seen[0] + seen[1]).items() if c >= 3 or f in marks)}
    weights, bias, start, step = np.zeros(len(ids) + 1), -3.0, np.zeros(2), np.zeros((2, 2))
    width = 1 + len(PREFIXES)
    f = np.array([[ids.get(x, 0) for x in fs] + [0] * (width - len(fs)) for fs in features], np.int32).reshape(-1, width)
    marked = np.array([not marks.isdisjoint(fs) for fs in features], bool)
    del features, seen
    at, real, head = blocks(lengths)
    word = np.concatenate([*tokens, np.zeros(1, np.int32)])[at]
    del tokens
    if marks:
        want = np.where(real, marked[word] & np.repeat(y > 0, -(-lengths // BLOCK))[:, None], False)
        flat, follows = want[real].astype(np.int8), np.flatnonzero(~(head[:, None] & (np.arange(BLOCK) == 0))[real])
        moves = np.bincount(2 * flat[follows - 1] + flat[follows], minlength=4).reshape(2, 2).astype(float)
        first = np.bincount(want[head, 0], minlength=2)
        wanted = np.bincount(word[real], want[real], len(f))
        places = np.where(real, word, len(f))
        del flat, follows, want
        state = [np.zeros_like(x, dtype=float) for x in (weights, np.zeros(1), start, step) for _ in range(2)]
        for i in range(1, rounds + 1):
            p, steps = marginals((bias + weights[f].sum(1))[word], real, start, step, True, head)
            off = wanted - np.bincount(places.ravel(), p.ravel(), len(f) + 1)[:-1]
            begin = p[head, 0].sum()
            grads = [
                np.bincount(f.ravel(), np.repeat(off, width), len(weights)) - 0.01 * weights,
                np.array([off.sum()]),
                first - np.array([head.sum() - begin, begin]),
                moves - steps,
            ]
            new = []
            for j, (value, g) in enumerate(zip((weights, np.array([bias]), start, step), grads, strict=True)):  # Adam
                state[2 * j] = 0.9 * state[2 * j] + 0.1 * g
                state[2 * j + 1] = 0.99 * state[2 * j + 1] + 0.01 * g * g
                new.append(value + 0.1 * (state[2 * j] / (1 - 0.9**i)) / (np.sqrt(state[2 * j + 1] / (1 - 0.99**i)) + 1e-8))
            weights, bias, start, step = new[0], float(new[1][0]), new[2], new[3]
            weights[0] = 0
    weights[np.abs(weights) <= LEAST] = 0
    model = Model({name: float(weights[i]) for name, i in ids.items() if weights[i]}, bias, start, step, np.zeros(5))
    p = np.zeros(int(lengths.sum()))
    if len(p):
        p[at[real]] = marginals((bias + weights[f].sum(1))[word], real, start, step, False, head)[0][real]
    of = np.split(p, np.cumsum(lengths)[:-1]) if len(lengths) else []
    model.calibration = logistic(np.array([summary(x) for x in of]).reshape(len(lengths), 5), y, 0.1, -3.0)
    return model


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED, size: int = BYTES) -> Model:
    """Trains on the ``limit`` labelled ids of least hash that are not held out, on whole texts of any length, as far as
    these have ``size`` bytes together. Of labels with one id the greatest counts, of documents the least text; a null
    text is empty."""
    some = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = some.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(limit)  # bounded, so it may be broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    rows = cut(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))
    sizes = rows.select("doc_id", F.octet_length("text").alias("n"), F.xxhash64(F.lit(5), "doc_id").alias("h")).orderBy("h", "doc_id").collect()
    total, fits = 0, []
    for r in sizes:
        if total + r["n"] <= size:
            total += r["n"]
            fits.append(r["doc_id"])
    if len(fits) < len(sizes):
        rows = rows.filter(F.col("doc_id").isin(fits))
    got = sorted(rows.collect(), key=lambda r: r["doc_id"])
    return train([r["text"] for r in got], [int(r["toxic"] > 0) for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score`` and ``spans``, the [start, end) in code points of tokens that are toxic by a marginal of one half
    or more. Only the text counts. Null is empty; texts without tokens get the score of none expected. Other columns
    pass through; those that bear a new name are replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "spans")]
    docs = docs.select(*[f"`{c}`" for c in kept])
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column(kept.index(text_col)).to_pylist()]
                scores, spans = [], []
                for text, p in zip(texts, model.tag([tokens_of(t) for t in texts], cache), strict=True):
                    scores.append(round(model.score(p), 6))
                    toxic = np.flatnonzero(p >= 0.5)
                    where = [m.span() for m in TOKEN.finditer(text)] if len(toxic) else []
                    spans.append([{"start": where[i][0], "end": where[i][1]} for i in toxic.tolist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pair))], names=[*kept, "score", "spans"])

    return docs.mapInArrow(run, schema)
