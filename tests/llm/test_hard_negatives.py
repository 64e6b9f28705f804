import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=3, low=50, high=95):
    use = [(k, i, lab, v) for k, (i, lab, v) in enumerate(rows) if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for k, i, lab, v in use:
        if i is None or i % 50:
            continue
        score = [(sum(int(a) * int(b) for a, b in zip(v, w)), j, m, lb) for m, j, lb, w in use if m != k and len(w) == len(v)]
        for ps, pid, _, _ in sorted((s for s in score if s[3] == lab), key=order)[:positives]:
            far = sorted((s for s in score if s[3] != lab and low * ps <= 100 * s[0] <= high * ps), key=order)[:negatives]
            out += [(i, pid, r + 1, s[1], ps, s[0]) for r, s in enumerate(far)]
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    data = [(i, lab, v, "x", 1) for i, lab, v in rows]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>, id string, row int").repartition(3)
    return sorted((tuple(r) for r in hn.mine(df, F.col("vec_id") % 50 == 0, **kw).collect()), key=str)


@pytest.fixture()
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (4, 20))
    out = [(k, k % 4, [float(x) for x in np.floor(centres[k % 4] * (0.2 + k % 3) + rng.normal(0, 30, 20))]) for k in range(400)]
    out += [(500 + k, k % 2, out[3][2]) for k in range(40)]  # one vector, many rows
    out += [(600, None, out[0][2]), (650, 1, None), (700, 2, [1.0, None] + [0.0] * 18), (750, 1, [float("nan")] * 20),
            (800, 1, [float("inf")] * 20), (None, 1, out[1][2]), (850, 1, []), (851, 1, []), (852, 0, []), (900, 0, [3.0, 4.0]),
            (901, 0, [3.0, 5.0]), (902, 1, [1.0, 3.0])]
    random.Random(3).shuffle(out)
    return out


def test_equals_brute_force(spark, rows):
    assert mined(spark, rows) == brute(rows)


def test_many_blocks(spark, rows, monkeypatch):
    for name, value in (("ROWS", 64), ("ANCHORS", 3), ("STEP", 16)):
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows) == brute(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(k, k % 2, [2.0, 2.0] if k % 2 else [3.0, 2.0]) for k in range(60)] + [(50, 0, [3.0, 2.0])] * 2
    out, want = mined(spark, rows), brute(rows)
    assert out == want and out


def test_empty_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_bounds_hold_and_prune(rows):
    x = np.array([r[2] for r in rows if r[2] and len(r[2]) == 20 and None not in r[2] and np.isfinite(r[2]).all()])
    a, b = hn.Summaries(x[:40]), hn.Summaries(x)
    true = x[:40] @ x.T
    for (ma, da), (mb, db) in zip(a.levels, b.levels):
        mid, rad = ma @ mb.T, da @ db.T
        assert (true <= mid + rad + 1e-6).all() and (true >= mid - rad - 1e-6).all()
    cut = np.quantile(true, 0.99)
    left = []
    i, j = hn.survivors(a, b, np.ones(true.shape, bool), np.full((40, 1), cut), np.full((40, 1), np.inf), left)
    assert set(zip(*np.nonzero(true >= cut))) <= set(zip(i.tolist(), j.tolist()))
    assert left == sorted(left, reverse=True) and left[-1] < true.size / 2  # later levels leave fewer pairs


def test_scores_beyond_doubles_are_exact():
    a, b = hn.Summaries(np.array([[2.0 ** 30, 1.0]])), hn.Summaries(np.array([[2.0 ** 31, 1.0]]))
    assert hn.exact_scores(a, b, np.array([0]), np.array([0])).tolist() == [2 ** 61 + 1]
