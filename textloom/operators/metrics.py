"""Training metrics (M1-M7) over loss tables.

Inputs are tables of losses per batch or per window; the network that makes
them is not built. Every rule is a grouped aggregate (map-side partial + final).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.tokens import IGNORE_INDEX
from textloom.operators.order import row_index

NAN = float("nan")
INF = float("inf")


MAX_LOOKUP = 1 << 20  # a per-token table is bounded by the vocabulary size


def with_loss_table(df: DataFrame, losses_by_token: DataFrame) -> DataFrame:
    """``df`` with ``_table``, the losses as one array whose position is the token, null where a token has none. The
    table is bounded by the vocabulary size, checked, and comes by one scalar subquery: no driver job, no shuffle
    of tokens, one pass over what the losses are made from."""
    few = losses_by_token.where(F.col("token") >= 0).limit(MAX_LOOKUP + 1)
    pairs = few.groupBy("token").agg(F.first("loss").alias("loss")).agg(
        F.array_sort(F.collect_list(F.struct("token", "loss"))).alias("p"))
    wide = F.raise_error(F.lit("per-token loss table larger than a vocabulary")).cast(pairs.schema["p"].dataType)
    pairs = pairs.select(F.when((F.size("p") == 0) | (F.try_element_at("p", F.lit(-1))["token"] < F.lit(MAX_LOOKUP)), F.col("p"))
                         .otherwise(wide).alias("p"))
    before = lambda i: F.coalesce(F.get("p", i - 1)["token"], F.lit(-1))  # noqa: E731  of the first: -1
    none = F.lit(None).cast("double")
    table = pairs.select(F.flatten(F.transform("p", lambda x, i: F.concat(
        F.array_repeat(none, (x["token"] - before(i) - 1).cast("int")), F.array(x["loss"].cast("double"))))).alias("t"))
    return df.withColumn("_table", table.scalar())


def token_loss(t) -> Column:
    """Loss of a token by ``_table``; a token without one is an error."""
    missing = F.raise_error(F.concat(F.lit("no loss for token "), t.cast("string"))).cast("double")
    return F.coalesce(F.get("_table", t), missing)


def sequence_loss(df: DataFrame, keys, targets_col: str, losses_by_token: DataFrame) -> DataFrame:
    """Loss of a row under a per-token loss table: mean over targets that are not
    -100 (NaN if none), and the number of such targets. Rows are grouped by ``keys``, which
    hold several rows each (e.g. a batch)."""
    keys = list(keys)
    t = F.filter(F.col(targets_col), lambda x: x != IGNORE_INDEX)
    rows = with_loss_table(df, losses_by_token).select(
        *keys, F.aggregate(t, F.lit(0.0), lambda s, x: s + token_loss(x)).alias("_s"),
        F.size(t).cast("long").alias("_n"))
    g = rows.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_n").cast("long").alias("targets"))
    return g.select(*keys, F.when(F.col("targets") > 0, F.col("_s") / F.col("targets"))
                    .otherwise(F.lit(NAN)).alias("loss"), "targets")


def epoch_loss(batches: DataFrame, epoch_col: str = "epoch") -> DataFrame:
    """M1: token-weighted mean loss per epoch, NaN without targets; plus M2 (chat rule)."""
    g = batches.groupBy(epoch_col).agg(
        F.sum(F.col("loss") * F.col("targets")).alias("_s"), F.sum("targets").cast("long").alias("targets"),
        F.sum("dataset_tokens").cast("long").alias("dataset_tokens"))
    loss = F.when(F.col("targets") > 0, F.col("_s") / F.col("targets")).otherwise(F.lit(NAN))
    return g.select(epoch_col, loss.alias("epoch_loss"), "targets", "dataset_tokens") \
        .withColumn("ppl", perplexity("epoch_loss", rule="chat"))


def perplexity(loss, rule: str = "chat") -> Column:
    """M2: exp(loss) if loss < 50 else inf. ``chat``: NaN gives inf (NaN < 50 is
    false). ``warmup``: NaN stays NaN."""
    l = F.col(loss) if isinstance(loss, str) else loss
    base = F.when(~F.isnan(l) & (l < 50), F.exp(l)).otherwise(F.lit(INF))
    if rule == "warmup":
        return F.when(F.isnan(l), F.lit(NAN)).otherwise(base)
    return base


def step_loss(batches: DataFrame, grad_accum: int, epoch_col: str = "epoch", index_col: str = "batch_index",
              rule: str = "chat") -> DataFrame:
    """M3: mean raw loss per accumulation window, divided by the full accumulation.
    ``warmup`` clamps accum to [1, batches per epoch] first; a short last window is
    still divided by the full accum."""
    acc = F.lit(int(max(1, grad_accum)))
    if rule == "warmup":
        n = batches.groupBy(epoch_col).agg(F.count(F.lit(1)).alias("_n"))
        b = batches.join(n, epoch_col)
        acc = F.least(acc, F.greatest(F.lit(1), F.col("_n")))
    else:
        b = batches
    b = b.withColumn("_acc", acc).withColumn("step", F.floor(F.col(index_col) / F.col("_acc")).cast("long"))
    return b.groupBy(epoch_col, "step").agg((F.sum("loss") / F.first("_acc")).alias("step_loss"))


def rank_reduce(df: DataFrame, keys, value: str, how: str = "avg") -> DataFrame:
    """M6: SUM (counts) or AVG (losses) over ranks."""
    f = F.avg if how == "avg" else F.sum
    return df.groupBy(*keys).agg(f(value).alias(value))


def validation_loss(window_losses: DataFrame, n: int) -> DataFrame:
    """M4: equal-weight mean of the n window losses of each rank, then the mean over ranks."""
    per_rank = window_losses.groupBy("rank").agg((F.sum("loss") / F.lit(n)).alias("loss"))
    ranks = per_rank.agg(F.count(F.lit(1)).cast("long").alias("n")).scalar()
    return rank_reduce(per_rank, [], "loss").select(F.col("loss").alias("val_loss"), ranks.alias("ranks"))


def throughput(steps: DataFrame, B: int, T: int, grad_accum: int, N: int) -> DataFrame:
    """M5: tokens per step, tokens per second and ms per step from (step, dt)."""
    tokens = B * T * grad_accum * N
    return steps.select("*", F.lit(tokens).cast("long").alias("tokens"),
                        (F.lit(tokens) / F.col("dt")).alias("tokens_per_sec"),
                        (F.col("dt") * 1000).alias("ms_per_step"))


def loss_curve(log: DataFrame, kind: str, first_x: int = 0) -> DataFrame:
    """M7: ordered (x, loss) series of one kind; x counts from ``first_x``."""
    d = log.where(F.col("kind") == kind)
    d = row_index(d, ["step"], out="_i")
    return d.select((F.col("_i") + first_x).cast("long").alias("x"), "step", F.col("value").alias("loss"))
