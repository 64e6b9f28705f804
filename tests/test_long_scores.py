"""Scores of long logits tables against numpy, over many tasks and with extreme values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators.long_scores import long_cross_entropy, long_topk, row_log_sum_exp

INF = float("inf")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = {k: rng.normal(0, 10 ** (k % 4), 300).tolist() for k in range(12)}
    out[20] = [800.0, -800.0, 799.5, 31.999999, 32.0, -INF]
    out[21] = [-INF, -INF]
    out[22] = [1.0, float("nan"), 2.0]
    out[23] = [1.0, INF]
    out[24] = [5.0] * 40
    return out


def _long(spark, rows, parts=7):
    data = [(k, t, z) for k, zs in rows.items() for t, z in enumerate(zs)]
    return spark.createDataFrame(data, "row_id long, token int, logit double").repartition(parts)


def test_log_sum_exp(spark, rows):
    got = {r.row_id: (r.lse, r.top) for r in row_log_sum_exp(_long(spark, rows)).collect()}
    for k, zs in rows.items():
        if k in (22, 23):
            assert np.isnan(got[k][0])
        else:
            want = np.logaddexp.reduce(zs)
            assert got[k][0] == want or abs(got[k][0] - want) <= 1e-9 * max(1, abs(want))
            assert got[k][1] == max(zs)


def test_cross_entropy_and_errors(spark, rows):
    targets = spark.createDataFrame([(0, 3), (20, 1), (24, -100), (24, 39)], "row_id long, target int")
    got = {(r.row_id, r.target): r.loss for r in long_cross_entropy(_long(spark, rows), targets).collect()}
    assert abs(got[0, 3] - (np.logaddexp.reduce(rows[0]) - rows[0][3])) < 1e-9
    assert abs(got[20, 1] - (np.logaddexp.reduce(rows[20]) + 800)) < 1e-9
    assert got[24, -100] is None and abs(got[24, 39] - np.log(40)) < 1e-9
    with pytest.raises(Exception, match="no logit for the target"):
        long_cross_entropy(_long(spark, rows), spark.createDataFrame([(0, 300)], "row_id long, target int")).collect()
    with pytest.raises(Exception, match="no logit for a token"):
        row_log_sum_exp(_long(spark, {1: [1.0, None]})).collect()


def test_topk(spark, rows):
    own = {k: zs for k, zs in rows.items() if k not in (21, 22, 23)}
    got = long_topk(_long(spark, own), 5).collect()
    for k, zs in own.items():
        order = np.lexsort((np.arange(len(zs)), -np.array(zs)))[:5]
        mine = sorted((r.rank, r.token, r.prob) for r in got if r.row_id == k)
        assert [t for _, t, _ in mine] == order.tolist() and [n for n, _, _ in mine] == list(range(1, len(order) + 1))
        want = np.exp(np.array(zs)[order] - np.logaddexp.reduce(zs))
        assert np.allclose([p for _, _, p in mine], want, atol=1e-12)


def test_plan_cuts_to_k_before_the_shuffle(spark):
    from contextlib import redirect_stdout
    from io import StringIO

    long = spark.range(0, 100_000, 1, 6).select((F.col("id") % 3).alias("row_id"), F.col("id").alias("token"), F.rand(1).alias("logit"))
    out = StringIO()
    with redirect_stdout(out):
        long_topk(long, 4).explain("formatted")
    assert out.getvalue().count("WindowGroupLimit") >= 2  # partial and final
    got = long_topk(long, 4)
    assert got.count() == 12
