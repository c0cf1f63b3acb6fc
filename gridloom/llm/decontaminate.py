"""Benchmark decontamination by winnowing. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii, row_key

#: Words of a window, of a hashed gram, and grams of which the least is kept: every window holds a kept gram.
WINDOW, GRAM = 13, 7
SPAN = WINDOW - GRAM + 1
#: Bits of a place in a text below a gram's hash; bits of the filter for each fingerprint of the benchmark, at most.
PLACE, PER_PRINT, MOST_BITS = 30, 64, 1 << 22
#: Parts that the documents with one print, or with one window, are dealt to.
SALTS = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds a value that the body uses more than once, so that it is computed once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters (lower-cased) and characters beyond ASCII; none for null."""
    t = F.coalesce(text, F.lit(""))
    lower = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(lower_ascii(t))  # the first is the faster
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def above_place(h: Column, i: Column) -> Column:
    return h.bitwiseAND(F.lit(-(1 << PLACE))).bitwiseOR(i.cast("long"))


def with_later(a: Column, shift: int, f: Callable[[Column, Column], Column]) -> Column:
    """f of each element and the one ``shift`` later; the last ``shift`` results are of no use."""
    return let(a, lambda x: F.zip_with(x, F.slice(x, F.lit(shift + 1), F.size(x)), f))


def grams(hashes: Column, n: int) -> Column:
    """The hash of each run of n words, above its place; only for texts of n words or more."""
    place = lambda i: above_place(F.xxhash64(F.slice(hashes, i + 1, F.lit(n)), F.lit(n)), i)
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - n), place)


def kept_grams(hashes: Column) -> Column:
    """For each window, the least GRAM-gram in it (ties: the first), its hash above its place; only for texts of WINDOW
    words or more. Hashes of 2, 4 and 7 words, then minima of 2, 4 and 7 places, come from pairs of shorter ones."""
    g = hashes
    for shift in (1, 2, GRAM - 4):
        g = with_later(g, shift, lambda x, y: F.xxhash64(x, y))
    g = F.transform(let(g, lambda x: F.slice(x, F.lit(1), F.size(x) - (GRAM - 1))), above_place)
    for shift in (1, 2, SPAN - 4):
        g = with_later(g, shift, lambda x, y: F.least(x, y))
    return let(g, lambda x: F.slice(x, F.lit(1), F.size(x) - (SPAN - 1)))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct ``window, m, print, off, item``: the window's words, how many, and the print with its place in it."""
    items = benchmark.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    items = items.withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).withColumn("n", F.size("w")).filter("n > 0")
    long = F.posexplode(kept_grams(F.col("h"))).alias("s", "e")
    long = items.filter(F.col("n") >= WINDOW).select("item", "w", long).select(
        "item",
        F.array_join(F.slice("w", F.col("s") + 1, F.lit(WINDOW)), " ").alias("window"),
        F.lit(WINDOW).alias("m"),
        F.shiftright("e", PLACE).alias("print"),
        (F.col("e").bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int") - F.col("s")).alias("off"),
    )
    short = items.filter(F.col("n") < WINDOW).select("item", F.array_join("w", " ").alias("window"), F.col("n").alias("m"), F.shiftright(F.xxhash64("h", "n"), PLACE).alias("print"), F.lit(0).alias("off"))
    return long.unionByName(short).distinct()


def covered(spans: Column) -> Column:
    """How many places the spans ``s, m`` (first place, length), in order of s, cover together."""

    def add(done: Column, x: Column) -> Column:
        end = x["s"] + x["m"]
        return F.struct((done["n"] + F.greatest(F.lit(0), end - F.greatest(x["s"], done["end"]))).alias("n"), F.greatest(end, done["end"]).alias("end"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), add)["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``row_key, doc_id, n_words, n_hit, items`` of every document row.

    A benchmark window is WINDOW consecutive words of an item, or all words of a shorter one. ``n_hit`` counts the
    words of a document inside any occurrence of a window, ``items`` lists, as sorted strings, the items with windows
    that occur. Null and empty texts have no words; benchmark rows without id or words take no part; repeated rows
    count each. ``row_key`` names a row by id and text (common.row_key).

    Both sides keep the least gram hash of each window, so that a shared window always shares a kept gram. A filter of
    bits, of bounded size, drops most other grams of a document in place; what is left joins the benchmark's prints
    and is extended, word for word, to the windows around. Short items are looked up by all their words.
    """
    windows = cut(benchmark_windows(benchmark, item_col, text_col))
    lengths = [r["m"] for r in windows.select("m").filter(F.col("m") < WINDOW).distinct().collect()]
    prints = windows.select("print").distinct()
    bits = 64
    while bits < min(MOST_BITS, PER_PRINT * prints.count()):
        bits *= 2
    of = lambda p: F.pmod(p, F.lit(bits))
    set_bits = prints.groupBy(F.floor(of(F.col("print")) / 64).cast("int").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(print, {bits}) % 64 AS int))")).alias("v"))
    held = {r["w"]: r["v"] for r in set_bits.collect()}
    literal = F.expr("array(" + ",".join(f"{held[i]}L" if held.get(i, 0) != -(2**63) else "(-9223372036854775807L - 1L)" for i in held_range(held, bits)) + ")")
    known = lambda p: F.getbit(F.get(literal, F.floor(of(p) / 64).cast("int")), (of(p) % 64).cast("int")) == 1

    def found(w: Column) -> Column:
        def by_hash(h: Column) -> Column:
            n = F.size(h)
            none = F.array().cast("array<bigint>")
            parts = [F.when(n >= WINDOW, F.array_distinct(kept_grams(h))).otherwise(none)]
            parts += [F.when(n >= m, grams(h, m)).otherwise(none) for m in sorted(lengths)]
            return F.concat(*[F.filter(p, lambda e: known(F.shiftright(e, PLACE))) for p in parts])

        at = lambda e: e.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")
        first = lambda e: F.greatest(at(e) - (SPAN - 1), F.lit(0))
        near = lambda e: F.struct(F.shiftright(e, PLACE).alias("print"), at(e).alias("p"), first(e).alias("from"), F.slice(w, first(e) + 1, F.lit(WINDOW + SPAN - 1)).alias("near"))
        return F.struct(F.size(w).alias("n"), F.transform(let(F.transform(w, lambda x: F.xxhash64(x)), by_hash), near).alias("found"))

    base = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), let(words(F.col(text_col)), found).alias("x"))
    base = cut(base.select("doc_id", "row_key", F.col("x.n").alias("n_words"), F.col("x.found").alias("found"))).withColumn("row", F.monotonically_increasing_id())
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))  # a common print is no one task's; the benchmark's side is repeated
    known_windows = windows.drop("item").distinct().withColumn("salt", F.explode(salts))
    hits = base.select("row", F.explode("found").alias("f")).select("row", "f.*").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(known_windows, ["print", "salt"])
    start = F.col("p") - F.col("off")
    hits = hits.filter((start >= F.col("from")) & (F.array_join(F.slice("near", start - F.col("from") + 1, F.col("m")), " ") == F.col("window")))
    hits = cut(hits.select("row", start.alias("s"), "m", "window").distinct())
    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("s", "m"))).alias("spans"))
    holders = windows.groupBy("window").agg(F.collect_set("item").alias("of")).withColumn("salt", F.explode(salts))
    named = hits.select("row", "window").distinct().withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(holders, ["window", "salt"])
    items = named.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("of")))).alias("items"))
    done = base.drop("found").join(spans.select("row", covered(F.col("spans")).alias("n_hit")), "row", "left").join(items, "row", "left")
    return done.select("row_key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def held_range(held: dict[int, int], bits: int) -> range:
    for i in range(bits // 64):
        held.setdefault(i, 0)
    return range(bits // 64)


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
