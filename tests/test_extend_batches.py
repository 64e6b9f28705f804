"""User functions get small batches, whatever Spark puts into one, and all rows in order."""

import pandas as pd

from textloom.operators import extend as U


def test_user_functions_get_small_batches(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 AS int)) AS text").coalesce(1)

    def sizes(pdf):
        return pd.DataFrame({"doc_id": pdf["doc_id"], "n": [len(pdf)] * len(pdf)})

    got = U.map_documents(docs, sizes, "doc_id long, n long").collect()
    assert sorted(r.doc_id for r in got) == list(range(3000)) and max(r.n for r in got) <= U.BATCH_ROWS

    def encoder():
        return lambda texts: [[len(texts), len(t)] for t in texts]

    ids = {r.doc_id: r.ids for r in U.with_encoder(docs, encoder).collect()}
    assert [ids[i][1] for i in range(3000)] == [i % 50 for i in range(3000)]
    assert max(v[0] for v in ids.values()) <= U.BATCH_ROWS


def test_long_texts_come_alone(monkeypatch):
    monkeypatch.setattr(U, "BATCH_CHARS", 10)
    pdf = pd.DataFrame({"k": range(6), "text": ["a" * 4, "b" * 5, "c" * 40, None, "d" * 10, ""]}, index=[5, 5, 1, 2, 3, 4])
    parts = list(U.small_batches([pdf, pdf.iloc[:0]]))
    assert [list(p["k"]) for p in parts] == [[0, 1], [2], [3, 4, 5]]
    assert pd.concat(parts)["text"].tolist()[:3] == pdf["text"].tolist()[:3]
