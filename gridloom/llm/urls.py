"""URL filters by a Bloom filter cascade that is exact over a complete key universe. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, lower_ascii

#: Words of 64 bits that one cascade may hold, about; longer lists are split by a hash of the key. Hashes of a level.
MOST_WORDS, HASHES = 1 << 17, 3


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*", 0), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


class BloomCascade:
    """Levels of bit words. Level 1 encodes the listed keys, level 2 the other keys of the universe that level 1 takes
    for listed, level 3 the listed keys that level 2 takes for these, and so on until a level errs no more."""

    def __init__(self, levels: list[tuple[int, dict[int, int]]], parts: list[BloomCascade] | None = None):
        self.levels, self.parts = levels, parts or []

    @staticmethod
    def part_of(key: Column, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(parts))

    @staticmethod
    def places(key: Column, level: int, bits: int) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(level * HASHES + j), key), F.lit(bits)) for j in range(HASHES)]

    def hit(self, key: Column, level: int) -> Column:
        bits, words = self.levels[level]
        literal = F.expr("array(" + ",".join(f"{_signed(words.get(i, 0))}L" if words.get(i, 0) != 1 << 63 else "(-9223372036854775807L - 1L)" for i in range(-(-bits // 64))) + ")")
        out = F.lit(True)
        for p in self.places(key, level, bits):
            word = F.get(literal, F.expr("0") + F.floor(p / 64).cast("int"))
            out = out & (F.getbit(word, (p % 64).cast("int")) == 1)
        return out

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe; null for null."""
        if self.parts:
            out = F.lit(None).cast("boolean")
            for i, part in enumerate(self.parts):
                out = F.when(self.part_of(key, len(self.parts)) == i, part.contains(key)).otherwise(out)
            return out
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(~self.hit(key, level), F.lit(level % 2 == 1)).otherwise(out)
        return F.when(key.isNotNull(), out)

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> BloomCascade:
        """``key`` columns both; nulls and repeats are ignored, listed keys need not occur in the universe.

        Keys are encoded where they are; only the words of a level come to the driver. A list whose levels would have
        more than MOST_WORDS is split by a hash of the key into as many cascades as hold it, each over its own keys.
        """
        mine = cut(listed.select("key").filter("key IS NOT NULL").distinct())
        others = cut(universe.select("key").filter("key IS NOT NULL").distinct().join(mine, "key", "left_anti"))
        n, n_other = mine.count(), others.count()
        parts = math.ceil(n * (cls.per_key(n, n_other) + 6) / (64 * MOST_WORDS))  # later levels have half as many keys each
        if parts > 1:
            of = lambda keys, i: keys.filter(cls.part_of(F.col("key"), parts) == i)
            return cls([], [cls._encoded(of(mine, i), of(others, i)) for i in range(parts)])
        return cls._encoded(mine, others)

    @staticmethod
    def per_key(n: int, n_other: int) -> float:
        """Bits a listed key of the first level: its false positives are then about as many as the keys listed."""
        return 1.5 * max(2.0, math.log2(max(2, n_other / max(1, n))))

    @classmethod
    def _encoded(cls, mine: DataFrame, others: DataFrame) -> BloomCascade:
        n_other, out = others.count(), cls([])
        while n := mine.count():
            bits = 64 * max(1, math.ceil(n * (3.0 if out.levels else cls.per_key(n, n_other)) / 64))
            place = F.explode(F.array(*cls.places(F.col("key"), len(out.levels), bits)))
            words = mine.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("v"))
            out.levels.append((bits, {r["w"]: r["v"] & (2**64 - 1) for r in words.collect()}))
            mine, others = cut(others.filter(out.hit(F.col("key"), len(out.levels) - 1))), mine
        return out


def _signed(word: int) -> int:
    return word - 2**64 if word >> 63 else word


def candidate_keys(host_col: Column, path_col: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys host + path of the rules that could fit, for each (labels of the host, characters of the path)."""
    one = lambda labels, chars: F.when(F.length(path_col) >= chars, F.concat(F.substring_index(host_col, ".", -labels), F.substring(path_col, 1, chars)))
    return F.array_compact(F.array(*[one(*s) for s in shapes]))


def shapes_of(rules: list[str]) -> list[tuple[int, int]]:
    split = [r.partition("/") for r in rules]
    return sorted({(h.count(".") + 1, 1 + len(p)) for h, _, p in split})


def judge(pages: DataFrame, block: list[str], allow: list[str], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host, path, rule, verdict``. Rules are a host and a path that begins with ``/``; the longest that fits
    wins. Urls that no rule fits get the default. Null urls and those without ``://`` have empty host and path.

    The rules are the listed keys; the key universe is every key that the corpus could ask for, given the shapes of
    the rules. Two cascades, of blocking and of allowing rules, answer each exactly, so pages need no join.
    """
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "verdict")
    keyed = pages.withColumns({"host": host(F.col(url_col)), "path": path(F.col(url_col))})
    keys = candidate_keys(F.col("host"), F.col("path"), shapes_of(block + allow))
    universe = cut(keyed.select(F.explode(keys).alias("key")).distinct())
    listed = lambda rules: spark.createDataFrame([(r,) for r in rules], "key string")
    blocks, allows = (BloomCascade.build(listed(rules), universe) for rules in (block, allow))
    found = F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), F.when(allows.contains(k), F.lit("allow")).when(blocks.contains(k), F.lit("block")).alias("verdict")))
    best = F.array_max(F.filter(found, lambda f: f["verdict"].isNotNull()))
    (name,) = fresh(keyed, "best")
    return keyed.withColumn(name, best).withColumns({"rule": F.col(f"{name}.rule"), "verdict": F.coalesce(f"{name}.verdict", F.lit(default))}).drop(name)
