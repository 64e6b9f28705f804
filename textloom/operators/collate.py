"""Batches, padding and masks.

Rows get consecutive batch ids from a two-level row index (no single-task
window); the batch width is ``max(size) over (partition by batch)``, a group of
``batch_size`` rows. Masks are built with array functions on each row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.tokens import IGNORE_INDEX
from textloom.operators.order import row_index


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assign_batches(df: DataFrame, order_cols: Sequence[str], batch_size: int,
                   partition_cols: Sequence[str] = ()) -> DataFrame:
    """B1: consecutive rows in order form a batch; the last one may be short."""
    d = row_index(df, order_cols, partition_cols, out="row_idx")
    return d.withColumn("batch_id", F.floor(F.col("row_idx") / batch_size).cast("long")) \
        .withColumn("batch_row", F.pmod(F.col("row_idx"), F.lit(batch_size)).cast("int"))


def cycle_batches(spark, batches: DataFrame, steps_per_epoch: int, grad_accum: int, epochs: int = 1,
                  batch_col: str = "batch_id") -> DataFrame:
    """B2: read number i (epoch, step, micro step) takes batch ``i mod n``; the data
    restarts when exhausted, without a reset between epochs. n is a scalar count."""
    n = batches.select(batch_col).distinct().count()
    if n == 0:
        raise RuntimeError("no valid batches")
    total = steps_per_epoch * grad_accum * epochs
    per_epoch = steps_per_epoch * grad_accum
    reads = spark.range(total).select(
        F.col("id").alias("read"),
        F.floor(F.col("id") / per_epoch).cast("int").alias("epoch"),
        F.floor(F.pmod(F.col("id"), F.lit(per_epoch)) / grad_accum).cast("long").alias("step"),
        F.pmod(F.col("id"), F.lit(grad_accum)).cast("int").alias("micro_step"),
        F.pmod(F.col("id"), F.lit(n)).cast("long").alias(batch_col))
    return reads.join(batches, batch_col)


def append_eos(ids, max_len: int, eos: int) -> Column:
    """EOS only when the row is shorter than the cap."""
    a = _col(ids)
    return F.when(F.size(a) < max_len, F.concat(a, F.array(F.lit(eos)))).otherwise(a)


def pad_to_batch(df: DataFrame, seq_col: str, pad: int, batch_col: str = "batch_id") -> DataFrame:
    """Pads every row to its batch's longest row; adds ``real_len`` and ``width``."""
    w = Window.partitionBy(batch_col)
    d = df.withColumn("real_len", F.size(seq_col)).withColumn("width", F.max("real_len").over(w))
    padded = F.concat(F.col(seq_col), F.array_repeat(F.lit(pad), F.col("width") - F.col("real_len")))
    return d.withColumn("padded", padded)


def shift(df: DataFrame) -> DataFrame:
    """inputs = padded[:-1], targets = padded[1:], attention (B5) = real positions, by
    length and not by value, last element cut."""
    width = F.col("width")
    att = F.concat(F.array_repeat(F.lit(1), F.col("real_len")),
                   F.array_repeat(F.lit(0), width - F.col("real_len")))
    return df.withColumn("inputs", F.slice("padded", 1, width - 1)) \
        .withColumn("targets", F.slice("padded", 2, width - 1)) \
        .withColumn("attention", F.slice(att, 1, width - 1))


def labels_keep_first_pad(targets, pad: int) -> Column:
    """Every target equal to pad except the first becomes -100."""
    t = _col(targets)
    first = F.array_repeat(F.array_position(t, pad), F.size(t))  # evaluated once per row
    return F.transform(F.arrays_zip(t.alias("v"), first.alias("f")),
                       lambda s, i: F.when((s["v"] == pad) & ((i + 1) != s["f"]), F.lit(IGNORE_INDEX)).otherwise(s["v"]))


def labels_mask_prompt(targets, real_len, prompt_len) -> Column:
    """Padded targets and the first ``prompt_len - 1`` targets become -100."""
    t = _col(targets)
    n = _col(real_len)
    p = _col(prompt_len)
    return F.transform(t, lambda v, i: F.when((i < p - 1) | (i + 1 >= n), F.lit(IGNORE_INDEX)).otherwise(v))


def mask_targets_by_attention(targets, attention) -> Column:
    """Target -100 where the input position is padding."""
    return F.zip_with(_col(targets), _col(attention),
                      lambda t, a: F.when(a == 0, F.lit(IGNORE_INDEX)).otherwise(t))


def collate_warmup(df: DataFrame, max_len: int, eos: int, ids_col: str = "ids") -> DataFrame:
    """B3-B6 with pad = EOS, then inputs/targets/attention cut to ``max_len``."""
    d = df.withColumn("_seq", append_eos(ids_col, max_len, eos))
    d = shift(pad_to_batch(d, "_seq", eos))
    return d.withColumn("targets", F.slice(labels_keep_first_pad("targets", eos), 1, max_len)) \
        .withColumn("inputs", F.slice("inputs", 1, max_len)) \
        .withColumn("attention", F.slice("attention", 1, max_len)).drop("_seq", "padded")


def collate_chat(df: DataFrame, max_len: int, eos: int, pad: int, ids_col: str = "ids",
                 prompt_col: str = "prompt_len") -> DataFrame:
    """B3-B5 + B7: chat batches padded with the pad token, prompt masked."""
    d = df.withColumn("_seq", append_eos(ids_col, max_len, eos))
    d = shift(pad_to_batch(d, "_seq", pad))
    return d.withColumn("targets", labels_mask_prompt("targets", "real_len", prompt_col)).drop("_seq", "padded")


def batch_token_counts(df: DataFrame, ids_col: str = "ids", batch_col: str = "batch_id") -> DataFrame:
    """Dataset tokens (before EOS and padding) and trained targets per batch."""
    return df.groupBy(batch_col).agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.sum(F.size(ids_col)).cast("long").alias("dataset_tokens"),
        F.sum(F.size(F.filter("targets", lambda v: v != IGNORE_INDEX))).cast("long").alias("target_tokens"))
