"""Quality classifier: a document's own evidence, combined with site and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import urls
from .common import KEY, cut, row_key
from .logistic import logistic

#: Labelled rows that the evidence is fitted on, at most; the counts and priors cover every document.
LABELLED = 6000
#: Bounds of a document's logit, so that no text is certain, and of how many documents a prior is worth.
LOGIT, WORTH = 8.0, (1.0, 1e6)
#: Parts that the documents of a path are dealt to where they meet its prior.
SALTS = 16


def features(text: bytes) -> list[float]:
    """Shares of kinds of bytes, of repeated words, neighbours and lines, and the mean length of words."""
    n = max(1, len(text))
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, int(c[65:91].sum() + c[97:123].sum() + c[128:].sum()))
    signs = int(c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum())
    plain = int(c[[33, 39, 44, 45, 46, 58, 59, 63]].sum())
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    w = max(1, len(words))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        float(c[65:91].sum()) / letters,
        float(c[48:58].sum()) / n,
        (signs - plain) / n,
        float(c[33]) / w,
        plain / n,
        same / w,
        1 - len(set(words)) / w,
        1 - len(set(lines)) / max(1, len(lines)),
        len(text) / w / 10,
        min(np.log1p(w), 10) / 10,
    ]


@dataclass
class Evidence:
    """Logistic regression on pieces of features: each is cut at quantiles of the sample, with a weight a piece."""

    cuts: np.ndarray
    weights: np.ndarray
    prior: float

    @staticmethod
    def spread(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        pieces = [(x[:, [j]] > cuts[j][None, :]).astype(float) for j in range(x.shape[1])]
        return np.concatenate([np.ones((len(x), 1)), x, *pieces], axis=1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Evidence:
        """Without both labels the evidence is nil."""
        cuts = np.quantile(x, np.linspace(0.1, 0.98, 12), axis=0).T if len(x) else np.zeros((len(features(b"")), 12))
        prior = float((y.sum() + 1) / (len(y) + 2))
        w = logistic(cls.spread(x, cuts), y, ridge, float(np.log(prior / (1 - prior))))
        return cls(cuts, w, prior)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality, as in the labelled sample."""
        return np.clip(self.spread(x, self.cuts) @ self.weights, -LOGIT, LOGIT)


def _measure(text_at: int, then):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column(text_at)])
                yield then(b, x)

    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> Evidence:
    """Fits on the ``limit`` labelled ids of least hash; only their features come to the driver. Of labels with one id
    the greatest counts, of documents the least text."""
    some = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = some.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(limit)  # bounded, so it may be broadcast
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("t")).join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("t").alias("t"))
    then = lambda b, x: pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int32()), pa.array(x.tolist())], names=["doc_id", "quality", "x"])
    got = rows.mapInArrow(_measure(2, then), "doc_id long, quality int, x array<double>").orderBy("doc_id").collect()
    width = len(features(b""))
    return Evidence.fit(np.array([r["x"] for r in got]).reshape(len(got), width), np.array([r["quality"] for r in got], float))


def _site_prior(sites: DataFrame, parent: Column) -> Column:
    """(good + worth * parent) / (n + worth)."""
    return (F.col("good") + F.col("worth") * parent) / (F.col("n") + F.col("worth"))


def _worth(sites: DataFrame) -> float:
    """How many documents a parent's rate is worth for its children, from how much their rates differ (moments)."""
    m = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("g"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("q"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not m["n"] or m["k"] < 2:
        return WORTH[1]
    rate = m["g"] / m["n"]
    spread = (m["q"] - m["n"] * rate * rate) - (m["k"] - 1) * rate * (1 - rate)
    between = spread / (m["n"] - m["nn"] / m["n"])
    return min(WORTH[1], max(WORTH[0], rate * (1 - rate) / between - 1)) if between > 0 else WORTH[1]


def section(url: Column) -> Column:
    """The path level of a url: the first part of its path; empty if it has none."""
    return F.regexp_extract(urls.path(url), r"^/([^/]*)/", 1)


def score(docs: DataFrame, evidence: Evidence, site: Column | None = None, path: Column | None = None, text_col: str = "text") -> DataFrame:
    """``row_key, doc_id, evidence, prior, quality`` of every row; ``quality`` is the probability of good quality.

    The evidence of each document gives the expected good ones of each path of each site, by grouped sums over all
    documents. A site's rate is shrunk toward the global rate, a path's toward its site's, by as many documents as the
    spread of rates suggests; sparse ones thus follow their parents. A document's odds are its likelihood ratio times
    the odds of its path. Null sites and paths are groups of their own; null and empty texts are judged as empty.

    For documents with urls, ``site`` and ``path`` are ``urls.host`` and ``section`` of these. By default they are the
    source and the language: tables without urls name the host as the source, and the corpus's sites have a section for
    each language (``http://host/fr/...``).
    """
    site, path = F.col("source") if site is None else site, F.col("lang") if path is None else path
    then = lambda b, x: pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.round(evidence.logit(x), 6))], names=["row_key", "doc_id", "site", "path", "logit"])
    rows = docs.select(row_key(text_col=text_col).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), site.cast("string").alias("site"), path.cast("string").alias("path"), F.col(text_col).cast("binary").alias("t"))
    rows = cut(rows.mapInArrow(_measure(4, then), f"row_key {KEY}, doc_id long, site string, path string, logit double"))
    millionths = F.floor(1e6 / (1 + F.exp(-F.col("logit"))) + 0.5).cast("long")  # whole numbers add up alike in any order
    paths = cut(rows.groupBy("site", "path").agg(F.count("*").alias("n"), F.sum(millionths).alias("m")).select("site", "path", "n", (F.col("m") / 1e6).alias("good")))
    sites = paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = (total["good"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    above = sites.withColumn("worth", F.lit(_worth(sites))).select(F.col("site").alias("s_"), _site_prior(sites, F.lit(rate)).alias("parent"))
    joined = paths.withColumn("worth", F.lit(_worth(paths))).join(above, F.col("site").eqNullSafe(F.col("s_")))
    priors = joined.select(F.col("site").alias("s_"), F.col("path").alias("p_"), _site_prior(joined, F.col("parent")).alias("prior"))
    salted = priors.select("s_", "p_", "prior", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_"))  # a hot path is no one task's
    salt = F.pmod(F.xxhash64("row_key"), F.lit(SALTS)) == F.col("salt_")
    done = rows.join(salted, F.col("site").eqNullSafe(F.col("s_")) & F.col("path").eqNullSafe(F.col("p_")) & salt)
    ratio = F.col("logit") - float(np.log(evidence.prior / (1 - evidence.prior)))
    odds = ratio + F.log(F.col("prior") / (1 - F.col("prior")))
    return done.select("row_key", "doc_id", F.round(ratio, 6).alias("evidence"), F.round("prior", 6).alias("prior"), F.round(1 / (1 + F.exp(-odds)), 6).alias("quality"))
