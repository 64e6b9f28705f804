"""Scores from a logits table (L1-L9): (row_id, logits array<double>, target int).

All rules are row-local array expressions without a shuffle, but for the width of a batch
(L9) and the mean (L3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.tokens import IGNORE_INDEX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def with_scalar(arr: Column, scalar: Column, fn) -> Column:
    """``transform(arr, x -> fn(x, scalar))`` with the per-row scalar evaluated once:
    a lambda that refers to an outer expression re-evaluates it per element."""
    return F.zip_with(arr, F.array_repeat(scalar, F.size(arr)), fn)


def softmax(z) -> Column:
    """L1: probabilities of one row (max subtracted first); linear in the row length."""
    a = _col(z)
    e = with_scalar(a, F.array_max(a), lambda x, m: F.exp(x - m))
    return F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x,
                       lambda s: with_scalar(e, s, lambda x, t: x / t))


def log_sum_exp(z) -> Column:
    a = _col(z)
    m = F.array_max(a)
    return m + F.ln(_sum(with_scalar(a, m, lambda x, mm: F.exp(x - mm))))


def token_cross_entropy(z, target) -> Column:
    """L2: ``logsumexp(z) - z[target]``; null for the ignore marker -100."""
    t = _col(target)
    return F.when(t == IGNORE_INDEX, F.lit(None).cast("double")).otherwise(
        log_sum_exp(z) - F.element_at(_col(z), t + 1))


def mean_cross_entropy(df: DataFrame, loss_col: str, group_cols=()) -> DataFrame:
    """L3: mean over rows whose target is not ignored; NaN when there is none."""
    return df.groupBy(*group_cols).agg(
        F.count(loss_col).cast("long").alias("n_targets"),
        F.when(F.count(loss_col) > 0, F.avg(loss_col)).otherwise(F.lit(float("nan"))).alias("mean_loss"))


def greedy_pick(z) -> Column:
    """L4: id of the highest logit; ties to the lowest id."""
    a = _col(z)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def scale_temperature(z, t: float) -> Column:
    """Logits divided by the temperature (only when sampling)."""
    return F.transform(_col(z), lambda x: x / F.lit(float(t)))


def topk_exact(df: DataFrame, k: int, z: str = "logits", key: str = "row_id") -> DataFrame:
    """L6 long form: exactly k most likely tokens per row (ties by lowest id), with
    rank and probability; sorted inside the row, which then gives its k tokens."""
    p = df.select(key, F.posexplode(topk_sorted(softmax(z), k)).alias("_i", "_t"))
    return p.select(key, (F.col("_i") + 1).alias("rank"), F.col("_t.token").alias("token"),
                    (-F.col("_t.neg")).alias("prob"))


def topk_sorted(z, k: int) -> Column:
    """L6 array form: array<struct<neg:double, token:int>> of the k largest logits."""
    a = _col(z)
    pairs = F.transform(a, lambda x, i: F.struct((-x).alias("neg"), i.cast("int").alias("token")))
    return F.slice(F.array_sort(pairs), 1, k)


def topk_threshold(z, k: int) -> Column:
    """K clamped to [1, V]; logits under the k-th largest become -inf, ties kept."""
    a = _col(z)
    kk = F.greatest(F.lit(1), F.least(F.lit(int(k)), F.size(a)))
    kth = F.element_at(F.sort_array(a, asc=False), kk)
    return with_scalar(a, kth, lambda x, t: F.when(x < t, F.lit(float("-inf"))).otherwise(x))


def uniform(seed, key) -> Column:
    """Deterministic uniform number in [0, 1) from md5(seed:key)."""
    h = F.md5(F.concat_ws(":", _col(seed).cast("string"), _col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_pick(df: DataFrame, z: str, key: str, k: int | None = 50, seed: int = 42, rank: int = 0,
                out: str = "token") -> DataFrame:
    """Draws one of the k most likely tokens (None: of all that are left) in proportion to its (unnormalised)
    probability, with a deterministic uniform number from (seed + rank, key).

    Only tokens with a probability are sorted, and the running sum is one number carried along them, so a row costs
    one pass over its logits plus a sort of what a threshold has left."""
    kept = F.filter(F.transform(softmax(z), lambda x, i: F.struct((-x).alias("neg"), i.alias("token"))), lambda s: s["neg"] != 0)
    top = F.array_sort(kept)
    d = df.withColumn("_top", top if k is None else F.slice(top, 1, k))
    zero = F.lit(0.0).cast("double")
    total = F.aggregate("_top", zero, lambda a, s: a - s["neg"])
    d = d.withColumn("_u", uniform(F.lit(seed + rank), key) * total)
    start = F.struct(zero.alias("sum"), F.col("_u").alias("u"), F.lit(None).cast("int").alias("token"), F.lit(False).alias("hit"))

    def step(a, s):
        to = a["sum"] - s["neg"]
        return F.struct(to.alias("sum"), a["u"].alias("u"), F.when(a["hit"], a["token"]).otherwise(s["token"].cast("int")).alias("token"),
                        (a["hit"] | (to > a["u"])).alias("hit"))

    return d.withColumn(out, F.aggregate("_top", start, step, lambda a: a["token"])).drop("_top", "_u")


def pad_after_eos(df: DataFrame, new_col: str, eos: int, pad: int | None = None, max_new: int | None = None,
                  batch_col: str = "batch_id") -> DataFrame:
    """After the first EOS each new id is pad; the new-token mask is 1 before the
    EOS and 0 from it on; a batch stops once all its rows are finished, so its new
    part is ``min(max_new, max(first EOS position))`` long."""
    pad = eos if pad is None else pad
    a = F.col(new_col)
    limit = F.size(a) if max_new is None else F.lit(int(max_new))
    first = F.array_position(a, eos)
    done_at = F.when(first > 0, first).otherwise(limit)
    d = df.withColumn("gen_len", F.least(limit, F.max(done_at).over(Window.partitionBy(batch_col))).cast("int"))
    # position of the first EOS (0: none), broadcast along the row once
    idx = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)))
    f = F.array_repeat(first, F.size(a))
    out = F.zip_with(F.arrays_zip(a.alias("x"), f.alias("f")), idx,
                     lambda s, i: F.when((s["f"] > 0) & (i > s["f"]), F.lit(pad)).otherwise(s["x"]))
    mask = F.zip_with(f, idx, lambda ff, i: F.when((ff > 0) & (i >= ff), F.lit(0)).otherwise(F.lit(1)))
    return d.withColumn("new_ids", F.slice(out, 1, F.col("gen_len"))) \
        .withColumn("new_mask", F.slice(mask, 1, F.col("gen_len")))
