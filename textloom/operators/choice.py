"""Multiple-choice evaluation.

Items are rendered per ending (context ids + ending ids, mask over the ending,
zero padding to the item's longest row). The loss at position p (predicting token p+1)
is weighted by the shifted mask; tokens, mask and losses are arrays of one row, so nothing
is shuffled before the lowest summed and the lowest mean loss pick the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.encoders import BYTES, Encoder
from textloom.operators.metrics import token_loss, with_loss_table
from textloom.operators.order import running_totals


def render_choices(items: DataFrame, encoder: Encoder = BYTES, n_endings: int = 4) -> DataFrame:
    """(item, label, ending, n_ctx, width, tokens, mask), rows of an item padded with 0.
    An item's context and its ``n_endings`` endings at most are encoded in one row, so its
    width needs no shuffle; more endings are an error."""
    many = F.raise_error(F.lit(f"more than {n_endings} endings")).cast("array<string>")
    it = items.select("item", "label", "ctx", F.when(F.size("endings") > n_endings, many).otherwise(
        F.col("endings")).alias("endings"))
    texts = {f"_e{i}": F.concat(F.lit(" "), F.get("endings", F.lit(i))) for i in range(n_endings)}
    r = encoder.with_ids(it, _ctx=F.col("ctx"), **texts)
    ends = F.slice(F.array(*texts), 1, F.size("endings"))
    r = r.select("item", "label", F.size("_ctx").alias("n_ctx"), "_ctx",
                 (F.size("_ctx") + F.array_max(F.transform(ends, F.size))).alias("width"),
                 F.posexplode(ends).alias("ending", "_end"))
    fill = F.array_repeat(F.lit(0), F.col("width") - F.col("n_ctx") - F.size("_end"))
    return r.select("item", "label", F.col("ending").cast("int").alias("ending"), "n_ctx", "width",
                    F.concat("_ctx", "_end", fill).alias("tokens"),
                    F.concat(F.array_repeat(F.lit(0), F.col("n_ctx")),
                             F.array_repeat(F.lit(1), F.size("_end")), fill).alias("mask"))


def token_losses(rendered: DataFrame, losses_by_token: DataFrame) -> DataFrame:
    """Stand-in for a model: ``losses`` holds at position p the loss of token p+1 under a
    per-token table, looked up inside the row. A token without a loss is an error: leaving
    it out would change sums and counts."""
    return with_loss_table(rendered, losses_by_token).withColumn("losses", F.transform(
        F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0))), token_loss)).drop("_table")


def ending_losses(scored: DataFrame) -> DataFrame:
    """E2 + E3 inside a row: the loss at p weighted by the mask at p+1, its sum, and its
    mean over the mask (NaN if there is none). A position without a loss is an error."""
    shifted = F.slice("mask", 2, F.greatest(F.size("mask") - 1, F.lit(0)))
    gap = F.raise_error(F.lit("no loss for a position")).cast("double")
    weighted = F.zip_with("losses", shifted, lambda l, m: F.coalesce(l, gap) * m)
    s = scored.select(*[c for c in ("item", "label", "ending") if c in scored.columns],
                      F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x).alias("sum_loss"),
                      F.aggregate(shifted, F.lit(0).cast("long"), lambda a, m: a + m).alias("n_mask"))
    return s.withColumn("mean_loss", _mean())


def shift_and_mask(losses: DataFrame, rendered: DataFrame) -> DataFrame:
    """E2 for a loss table of its own, one row per position (item, ending, pos, loss), as a
    model writes it: loss at p weighted by the mask at p+1 (equi-join on the position)."""
    m = rendered.select("item", "ending", F.posexplode("mask").alias("mpos", "m")).where(F.col("mpos") >= 1)
    m = m.select("item", "ending", (F.col("mpos") - 1).alias("pos"), "m")
    j = m.join(losses, ["item", "ending", "pos"], "left").withColumn("loss", _present("pos"))
    return j.select("item", "ending", "pos", (F.col("loss") * F.col("m")).alias("masked_loss"), "m")


def _present(what: str):
    missing = F.raise_error(F.concat(F.lit(f"no loss for {what} "), F.col(what).cast("string")))
    return F.when(F.col("loss").isNull(), missing).otherwise(F.col("loss")).alias("loss")


def completion_loss(masked: DataFrame) -> DataFrame:
    """E3 for such a table: sum and mean (over the mask) per ending; mean NaN if no mask."""
    g = masked.groupBy("item", "ending").agg(F.sum("masked_loss").alias("sum_loss"),
                                             F.sum("m").cast("long").alias("n_mask"))
    return g.withColumn("mean_loss", _mean())


def _mean():
    return F.when(F.col("n_mask") > 0, F.col("sum_loss") / F.col("n_mask")).otherwise(F.lit(float("nan")))


def pick_choice(losses: DataFrame) -> DataFrame:
    """Ending with the lowest sum (pred) and lowest mean (pred_norm); ties to the
    lowest index; a NaN counts as the smallest, as an argmin over the values does."""
    def lowest(c):
        return F.min(F.struct(F.when(F.isnan(c), 0).otherwise(1), F.col(c), F.col("ending")))["ending"]
    label = [F.first("label").alias("label")] if "label" in losses.columns else []
    return losses.groupBy("item").agg(lowest("sum_loss").alias("pred"), lowest("mean_loss").alias("pred_norm"), *label)


def with_correct(p: DataFrame) -> DataFrame:
    """Whether the picks are the item's label, which the losses carry."""
    return p.withColumn("correct", (F.col("pred") == F.col("label")).cast("int")) \
        .withColumn("correct_norm", (F.col("pred_norm") == F.col("label")).cast("int"))


def choice_accuracy(labelled: DataFrame, ranks: int | None = None) -> DataFrame:
    """E5: counts and ratios. With ``ranks``, partial counts per rank (item mod ranks)
    are summed, as the reference's all-reduce does; Catalyst does the same with its
    partial aggregation, so the result is identical."""
    d = labelled
    if ranks:
        d = d.groupBy(F.pmod("item", F.lit(ranks)).alias("rank")).agg(
            F.count(F.lit(1)).alias("total"), F.sum("correct").alias("correct"),
            F.sum("correct_norm").alias("correct_norm"))
        cols = [F.sum("total"), F.sum("correct"), F.sum("correct_norm")]
    else:
        cols = [F.count(F.lit(1)), F.sum("correct"), F.sum("correct_norm")]
    a = d.agg(cols[0].cast("long").alias("total"), cols[1].cast("long").alias("correct"),
              cols[2].cast("long").alias("correct_norm"))
    return a.withColumn("acc", F.col("correct") / F.col("total")) \
        .withColumn("acc_norm", F.col("correct_norm") / F.col("total"))


def running_accuracy(labelled: DataFrame, order_col: str = "item") -> DataFrame:
    """Accuracy so far after each item, in item order (two-level running sums)."""
    r = running_totals(labelled, {"seen": F.lit(1), "correct_norm_so_far": F.col("correct_norm")}, [order_col])
    return r.withColumn("acc_norm", F.col("correct_norm_so_far") / F.col("seen"))


def example_report(items: DataFrame, losses: DataFrame, preds: DataFrame, n: int = 9,
                   order_col: str = "item") -> DataFrame:
    """The first n items (a report, so a limit): context, each ending with its
    mean loss, predicted and actual ending."""
    first = items.orderBy(order_col).limit(n)
    e = first.select("item", "ctx", "label", F.posexplode("endings").alias("ending", "ending_text"))
    e = e.withColumn("ending", F.col("ending").cast("int"))
    return e.join(losses.select("item", "ending", "mean_loss"), ["item", "ending"]) \
        .join(preds.select("item", "pred_norm"), "item")
