import os
import random

import numpy as np
from gridloom.llm import substrings
from gridloom.llm.common import held, shared_folder, ship
from gridloom.llm.substrings import BYTES, WORDS


def test_rounds_write_one_table_for_each_grain(spark):
    """They wrote four; each file costs an executor three processes that share its memory for a moment."""
    ship(spark)
    rng = random.Random(5)
    passage = " ".join(str(rng.random()) for _ in range(60))
    docs = spark.createDataFrame([(i, f"{rng.random()} {passage} {rng.random()}") for i in range(4)], "doc_id long, text string")
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    rows = substrings.remove_repeats(docs, passages=WORDS).collect()
    assert {(len(r["spans"]), r["n_passage_units"]) for r in rows} == {(1, 60)}
    assert len(set(os.listdir(folder)) - before) == 2


def test_held_rows_are_whole_and_keep_two_copies(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS other")
    got = held(rows)
    assert got.dtypes == rows.dtypes and sorted(got.collect()) == sorted(rows.collect())
    level = got._jdf.queryExecution().analyzed().rdd().getStorageLevel()
    assert (level.useDisk(), level.useMemory(), level.replication()) == (True, False, 2)


def test_repeats_of_bytes_and_words_with_rounds_held(spark):
    """All three rounds, in more ranges than rows."""
    ship(spark)
    rng = random.Random(6)
    base = "".join(rng.choice("abcd é\n") for _ in range(3000))
    texts = [base[a : a + n] for a, n in ((0, 900), (300, 1200), (1100, 1900), (0, 3000), (2500, 390))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in substrings.remove_repeats(docs, grain=BYTES).collect():
        raw = texts[r["doc_id"]].encode()
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert bytes(r["kept"]) == b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(raw)], strict=True))
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 399):
            if sum(t.encode().count(raw[i : i + 400]) for t in texts) > 1:
                gone[i : i + 400] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        assert spans == [*zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
