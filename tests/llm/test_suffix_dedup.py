import hashlib
import random

import numpy as np
import pytest

import textloom.llm.suffix_dedup as S
from textloom.llm.suffix_dedup import minimizers, remove_repeats, repeated_windows, suffix_order

SCHEMA = "doc_id long, text string, doc long, tie long, kept string"


def places(spark, rows):
    """Order of rows by the key that the operator gives them."""
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return {(r.id, bytes(r.text)): (r.doc, r.tie) for r in S._keyed(df, "doc_id", "text").collect()}


def brute(rows, length, place=None):
    """Bytes covered by a string that also starts earlier; rows in order of id, null last, whole repeats after their first."""
    order = sorted(range(len(rows)), key=lambda i: place[rows[i][0], (rows[i][1] or "").encode()] if place else (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            w = text[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((rows[i][0], len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed, length):
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    shared = [fresh(n) for n in (length - 1, length, length + 1, 3 * length, length // 2, length - 20)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice([fresh(rng.randint(0, 2 * length)), rng.choice(shared), shared[3][rng.randint(0, length):]]))
        rows.append((rng.randint(0, 10**6) * 100 + i, "".join(parts)))
    whole = fresh(4 * length)
    rows += [(5 + i, whole) for i in range(8)] + [(1, whole[:2 * length] + "#" + whole[2 * length + 1:]), (2, "z" * (3 * length)), (3, "ab" * (2 * length)),
             (4, "z" * (length + 1)), (50, None), (51, ""), (None, whole + "tail" * 40), (60, shared[3]), (60, shared[3]), (61, fresh(length - 1)), (62, fresh(length - 1))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot,broadcast,step", [(20_000, 1000, 1 << 20), (3, 0, 700)])
@pytest.mark.parametrize("length", [28, 100])
def test_equals_brute_force(spark, monkeypatch, length, hot, broadcast, step):
    monkeypatch.setattr(S, "STEP", step)
    monkeypatch.setattr(S, "LOCAL_ROWS", 300 if step < 1000 else 1 << 20)
    monkeypatch.setattr(S, "ARRAY_BYTES", 2000 if step < 1000 else 1 << 20)
    rows = texts(length, length)
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)
    out = remove_repeats(docs, length, hot=hot, broadcast_docs=broadcast, with_bytes=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, length)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in out)


def test_common_line_in_many_surroundings(spark):
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh", k=90))
    rows = [(i, "".join(rng.choices("klmnop", k=150)) + line + ("q" * 30 if i % 9 == 0 else "".join(rng.choices("klmnop", k=150)))) for i in range(200)]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(4)
    for hot in (50, 20_000):
        out = remove_repeats(docs, 100, hot=hot).collect()
        assert sorted(map(tuple, out), key=str) == brute(rows, 100)


def test_edge_tables(spark, edge, edge_docs, no_docs):
    rows = [d[:2] for d in edge_docs]
    got = sorted(map(tuple, remove_repeats(edge, 30).collect()), key=str)
    assert got == brute(rows, 30, places(spark, rows))
    assert remove_repeats(no_docs).count() == 0


def test_unlike_texts_without_ids(spark):
    """Texts with null ids whose hashes agree in 31 bits are different documents; texts repeated whole are not."""
    from pyspark.sql import functions as F

    text = F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 3), F.lit("shared tail " * 12))
    low = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))
    pairs = (spark.range(400_000).select(text.alias("text")).withColumn("low", low).groupBy("low")
             .agg(F.collect_list("text").alias("t")).where("size(t) > 1").limit(6).collect())
    assert pairs
    rows = [(None, t) for r in pairs for t in r["t"]] + [(None, pairs[0]["t"][0])] * 2 + [(7, pairs[0]["t"][1])] * 2
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, remove_repeats(docs).collect()), key=str)
    assert got == brute(rows, 100, places(spark, rows))


@pytest.mark.parametrize("alphabet", [2, 4, 256])
def test_two_stage_sorting(alphabet):
    rng = np.random.default_rng(alphabet)
    for n in (0, 1, 2, 50, 400):
        x = rng.integers(0, alphabet, n).astype(np.uint8)
        x[n // 3:n // 2] = 1
        data = x.tobytes()
        assert suffix_order(x, 10**6).tolist() == sorted(range(n), key=lambda i: data[i:])
        got = [data[i:i + 12] for i in suffix_order(x, 12)]
        assert got == sorted(got)


def test_repeated_windows_of_segments():
    a, b = bytes(range(60)), bytes(range(100, 160))
    out = repeated_windows([(2, 0, 10, a), (1, 0, 5, b + a[:40]), (1, 0, 5, b + a[:40]), (3, 0, 0, a[5:50])], 30)
    places = {(d, s) for d, _, lo, hi in out for s in range(lo, hi + 1)}
    want = {(2, 10 + k) for k in range(11)} | {(3, k) for k in range(16)}
    assert places == want


def test_minimizers_represent_every_window():
    rng = np.random.default_rng(2)
    x = rng.integers(97, 101, 3000).astype(np.uint8)
    x[2000:2300] = x[100:400]
    at, h, *_ = minimizers(x, np.array([1000, 1050, 3000]), 100)
    for start in list(range(0, 900, 7)) + list(range(1050, 2900, 7)):
        assert ((at >= start) & (at <= start + 76)).any()
    assert not ((at >= 1000) & (at < 1050)).any()
    own = {p - 100 for p in at if 200 <= p < 300}
    assert own == {p - 2000 for p in at if 2100 <= p < 2200}


def test_common_gram_is_dealt_over_tasks(spark):
    """A line in all rows, each time in other surroundings, over many small ranges: no link is lost at their edges."""
    rng = random.Random(9)
    line = "".join(rng.choices("abcdefgh", k=70))
    fresh = lambda n: "".join(rng.choices("klmnop", k=n))
    shared = [fresh(60) for _ in range(4)]
    rows = [(i, fresh(40) + rng.choice(shared) + line + rng.choice(shared) + fresh(40) if i % 3 else fresh(90) + line + fresh(90)) for i in range(240)]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        occurrences = S._occurrences(S._keyed(docs, "doc_id", "text").select("doc", "tie", "text"), 100)
        tasks = S._verdicts(occurrences).where("kind > 1").selectExpr("key", "spark_partition_id() AS t").distinct()
        assert max(r["count"] for r in tasks.groupBy("key").count().collect()) > 1
        for hot in (30, 20_000):
            assert sorted(map(tuple, remove_repeats(docs, 100, hot=hot).collect()), key=str) == brute(rows, 100)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ranges_hold_every_place_once():
    """Ranges by their last gram and surroundings, several of one gram among them, against a plain comparison."""
    rng = np.random.default_rng(4)
    key, around = rng.integers(0, 6, 500), rng.integers(-4, 5, 500)
    ends = sorted({(int(k), int(a)) for k, a in zip(rng.integers(0, 6, 9), rng.integers(-4, 5, 9))} | {(3, -2), (3, 0), (3, 3)})
    keys, arounds = (np.array(c, np.int64) for c in zip(*ends))
    assert S._range_of(key, around, keys, arounds).tolist() == [sum(e < (k, a) for e in ends) for k, a in zip(key.tolist(), around.tolist())]
    none = np.zeros(0, np.int64)
    assert not S._range_of(key, around, none, none).any()
    wide = np.array([-10**18, -5, -4, 10**17], np.int64)
    own = S._inside_ranges(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), wide)
    assert not np.isin(own, wide).any()
    assert (np.bincount(np.searchsorted(wide, own), minlength=5)[[0, 1, 3, 4]] > 800).all()


@pytest.mark.parametrize("docs_a_range, rows_a_range", [(16, 1000), (1, 1)])
def test_texts_are_scanned_once(spark, monkeypatch, docs_a_range, rows_a_range):
    """Sampling inside a range exchange would run the scan of all texts twice; the ends of ranges never change results."""
    monkeypatch.setattr(S, "SAMPLE_DOCS", docs_a_range)
    monkeypatch.setattr(S, "SAMPLE_ROWS", rows_a_range)
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choices("klmnop", k=n))
    shared = [fresh(130) for _ in range(5)]
    rows = [(i, fresh(50) + rng.choice(shared) + fresh(50)) for i in range(60)] + [(None, shared[0]), (61, None), (62, "")]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)
    verdicts = S._verdicts(S._occurrences(S._keyed(docs, "doc_id", "text").select("doc", "tie", "text"), 100))
    assert "rangepartitioning" not in verdicts._jdf.queryExecution().toString().lower()
    got = {r[0]: tuple(r) for r in remove_repeats(docs).collect()}
    want = {r[0]: r for r in brute([r for r in rows if r[0] is not None], 100)}
    assert {k: v for k, v in got.items() if k is not None} == want
