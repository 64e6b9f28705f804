"""Training-side tables with a fixed stand-in model (the unigram byte losses):
window losses, validation loss, per-step train loss, epoch metrics and the
metric log of the training loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.metrics import sequence_loss


def window_losses(xy: DataFrame, losses_by_token: DataFrame, keys=("split", "rank", "read")) -> DataFrame:
    """Loss of each window: mean over its B*T targets (y)."""
    return sequence_loss(xy, keys, "y", losses_by_token)


def train_step_losses(windows: DataFrame, wl: DataFrame, grad_accum: int) -> DataFrame:
    """Per step: sum over micro steps of loss / accum per rank, then AVG over ranks."""
    j = windows.select("rank", "read", "step", "micro_step").join(wl.select("rank", "read", "loss"), ["rank", "read"])
    per_rank = j.groupBy("step", "rank").agg(F.sum(F.col("loss") / F.lit(grad_accum)).alias("loss"))
    return per_rank.groupBy("step").agg(F.avg("loss").alias("loss"))


def train_rows(train_loss: DataFrame) -> DataFrame:
    """(step, kind, value) rows of the training losses."""
    return train_loss.select("step", F.lit("train").alias("kind"), F.col("loss").alias("value"))


def metric_log(schedule: DataFrame, train_loss: DataFrame, val_loss: Column, hella_acc: Column) -> DataFrame:
    """(step, kind, value) rows of the loop: val and hella at evaluation steps, train
    at every step. ``val_loss`` and ``hella_acc`` are scalar subqueries of one-row aggregates,
    so building the log runs no job."""
    ev = schedule.where("evaluate").select("step")
    val = ev.select("step", F.lit("val").alias("kind"), val_loss.alias("value"))
    hel = ev.select("step", F.lit("hella").alias("kind"), hella_acc.alias("value"))
    return val.unionByName(hel).unionByName(train_rows(train_loss))
