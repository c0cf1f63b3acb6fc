import random

from gridloom.llm import toxicity
from gridloom.llm.common import ship


def test_labels_on_long_documents_train_the_model(spark):
    ship(spark)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(80):
        ws = [rng.choice(words) for _ in range(3000)]
        if i % 2:
            ws[10:900:40] = ["zzvile"] * len(ws[10:900:40])
        rows.append((i, " ".join(ws)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert min(len(t) for _, t in rows) > 20_000
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in got)
