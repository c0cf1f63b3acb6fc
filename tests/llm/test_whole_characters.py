import random

from gridloom.llm import substrings
from gridloom.llm.common import ship


def test_removal_takes_whole_characters_and_leaves_replacement_characters(spark):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    shared, own = text(80), [text(40) for _ in range(5)]
    # é and ĩ end in the same byte, é and è begin with the same one: the bytes that repeat begin and end inside characters
    texts = [f"{own[0]} � é{shared}é {own[1]}�", f"{own[2]} ĩ{shared}è {own[3]}", f"�{shared}", f"{own[4]} �"]
    ship(spark)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in substrings.remove_repeats(docs, whole_characters=True).collect()}
    assert got == {0: f"{own[0]} �  {own[1]}�", 1: f"{own[2]}  {own[3]}", 2: "�", 3: texts[3]}


def test_spans_grow_to_characters():
    raw = "aé€😀b�".encode()  # characters begin at 0, 1, 3, 6, 10, 11
    assert substrings.widened(raw, [(2, 4)]) == [(1, 6)]
    assert substrings.widened(raw, [(1, 3), (8, 10)]) == [(1, 3), (6, 10)]
    assert substrings.widened(raw, [(2, 4), (5, 7)]) == [(1, 10)]
    assert substrings.widened(raw, [(0, len(raw))]) == [(0, len(raw))]
    assert substrings.widened(b"\x80\x80\xe2\x82", [(1, 3)]) == [(1, 3)]
