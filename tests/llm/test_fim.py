import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import fim


def brute(doc_id, text, rate=90, spm=20):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, t
    if h4 % 100 < spm:
        return doc_id, n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab<P>SMé日🙂 ", max_size=60), st.data())
def test_round_trip(text, data):
    if any(x in text for x in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((data.draw(st.integers(0, len(text))), data.draw(st.integers(0, len(text)))))
    for form, want in (("psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"), ("spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}")):
        out = fim.transform(text.encode(), a, b, form)
        assert out.decode() == want and fim.restore(out, form).decode() == text


def test_rotation_of_blocks_larger_than_a_step():
    text = ("é日x" * 70_000)
    for a, b in ((0, 0), (1, 209_999), (65_000, 140_001), (210_000, 210_000)):
        out = fim.transform(text.encode(), a, b, "spm")
        assert out.decode() == f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" and fim.restore(out, "spm").decode() == text


def test_documents(spark, edge, edge_docs, no_docs):
    marked = spark.createDataFrame([(300 + k, t) for k, t in enumerate(["a<P>b", "x <S", "<M>", "plain"])], "doc_id long, text string")
    docs = edge.unionByName(marked, allowMissingColumns=True)
    out = fim.restore_texts(fim.fill_in_middle(docs)).collect()
    want = [brute(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in out), key=key) == sorted(want, key=key)
    texts = lambda rows: sorted(rows)
    assert texts(r["restored"] for r in out) == texts(r["text"] or "" for r in docs.collect())
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fim.restore_texts(fim.fill_in_middle(no_docs)).count() == 0


def test_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    n = {r["form"]: r["count"] for r in fim.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(n["plain"] / 4000 - 0.1) < 0.02 and abs(n["spm"] / 4000 - 0.18) < 0.025
    assert {r["form"] for r in fim.fill_in_middle(docs, rate=0).select("form").distinct().collect()} == {"plain"}
