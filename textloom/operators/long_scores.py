"""Scores of a long logits table, one row per (row, token, logit), as a distributed model writes it.

A row's logits may lie in many tasks. Log-sum-exp has a mergeable state: logits fall into bins of ``BIN`` and each bin keeps
the sum of ``exp(logit - upper edge of its bin)``, a number that neither overflows nor depends on the other logits. Bins of
a row add up in partial aggregates, are few (the range of the logits / ``BIN``), and are joined by rescaling to the highest
one. The k highest tokens are a rank limit, which Spark applies in every task before the shuffle, so at most k rows per
row and task are sent. No task holds a row's logits, and no array is built.

A logit of minus infinity is a token left out; NaN or plus infinity makes the row's sum NaN. A null logit is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.tokens import IGNORE_INDEX

BIN = 32.0


def _logit(df: DataFrame, logit_col: str) -> Column:
    missing = F.raise_error(F.lit("no logit for a token")).cast("double")
    return F.coalesce(F.col(logit_col).cast("double"), missing)


def row_log_sum_exp(logits: DataFrame, keys=("row_id",), logit_col: str = "logit") -> DataFrame:
    """(keys, ``lse``, ``top``): log of the sum of exp over a row's tokens, and the highest logit."""
    z = F.col("_z")
    bad = F.isnan(z) | (z == float("inf"))
    rows = logits.select(*keys, _logit(logits, logit_col).alias("_z"))
    rows = rows.select(*keys, "_z", bad.alias("_bad"), F.when(~bad & (z > float("-inf")), F.floor(z / BIN)).alias("_bin"))
    bins = rows.groupBy(*keys, "_bin").agg(F.sum(F.exp(z - (F.col("_bin") + 1) * BIN)).alias("_s"),
                                          F.max("_z").alias("_top"), F.max("_bad").alias("_bad"))
    parts = bins.groupBy(*keys).agg(F.max("_bin").alias("_hi"), F.max("_top").alias("top"), F.max("_bad").alias("_bad"),
                                    F.collect_list(F.struct("_bin", "_s")).alias("_bins"))  # a few numbers a row
    total = F.aggregate(F.filter("_bins", lambda b: b["_bin"].isNotNull()), F.struct(F.lit(0.0).cast("double").alias("s"), F.col("_hi").alias("hi")),
                        lambda a, b: F.struct((a["s"] + b["_s"] * F.exp((b["_bin"] - a["hi"]) * BIN)).alias("s"), a["hi"].alias("hi")),
                        lambda a: a["s"])
    lse = F.when(F.col("_bad"), float("nan")).when(F.col("_hi").isNull(), float("-inf")).otherwise(
        (F.col("_hi") + 1) * BIN + F.ln(total))
    return parts.select(*keys, lse.alias("lse"), "top")


def long_cross_entropy(logits: DataFrame, targets: DataFrame, keys=("row_id",), token_col: str = "token",
                       logit_col: str = "logit", target_col: str = "target") -> DataFrame:
    """L2: ``targets`` with ``loss``, log-sum-exp minus the logit of the target; null for the ignore marker. A target
    without a logit is an error."""
    keys = list(keys)
    own = logits.select(*keys, F.col(token_col).alias(target_col), _logit(logits, logit_col).alias("_own"))
    gap = F.raise_error(F.lit("no logit for the target")).cast("double")
    j = targets.join(row_log_sum_exp(logits, keys, logit_col), keys, "left").join(own, [*keys, target_col], "left")
    loss = F.when(F.col(target_col) != IGNORE_INDEX, F.col("lse") - F.coalesce("_own", gap))
    return j.select(*targets.columns, "lse", "top", loss.alias("loss"))


def long_topk(logits: DataFrame, k: int, keys=("row_id",), token_col: str = "token", logit_col: str = "logit") -> DataFrame:
    """The k most likely tokens of each row with rank and probability; ties to the lowest token. k = 1 is L4."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(F.col(logit_col).desc(), token_col)
    top = logits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(k))
    return top.join(row_log_sum_exp(logits, keys, logit_col), keys).select(
        *keys, F.col("rank").cast("long").alias("rank"), token_col, F.exp(F.col(logit_col) - F.col("lse")).alias("prob"))
