"""Ordered numbering and running sums without a single-task window.

A window without ``partitionBy`` puts every row in one task. Instead: (1) the input is
written once to the shared folder, with a row number, so everything above it runs once;
(2) its keys and values alone, without the other columns, are dealt into ranges of the
partition columns, all order columns and the row number, so that rows with equal keys,
and a key that holds most rows, are split over ranges as well; Spark chooses the number
of ranges from the size; (3) one sum per range and group, a table of one row per range
and group, gives each range's starting value; (4) a window inside each range, and the
sums, numbers alone, are shuffled back to where their rows are stored: a table bucketed by
the task that wrote a row, four files per task. The rows, with their texts or ids, are read
from their buckets and joined in place by the row number, with no exchange of their own.
No row is lost: null keys sort first, null groups are groups, an empty input gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import bucketed_once, written_once

#: Bits of ``monotonically_increasing_id`` below the number of the writing task.
_TASK_SHIFT = 33
#: Parts (files) that a writing task deals its rows into, so that few tasks still fill the buckets evenly.
_PARTS = 4


def running_totals(df: DataFrame, values: dict[str, Column], order_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), inclusive: bool = True) -> DataFrame:
    """Running sums of several values at once (E6) in ``order_cols`` order within
    ``partition_cols``; rows with equal keys come in the order they are read."""
    place = {c: f"c{i}" for i, c in enumerate(df.columns)}  # no name of the input can clash with those added here
    named = df.select(*(F.col(f"`{c}`").alias(n) for c, n in place.items()),
                      *(v.cast("long").alias(f"_v{i}") for i, v in enumerate(values.values())))
    numbered = named.withColumn("_row", F.monotonically_increasing_id())
    task = F.shiftright("_row", _TASK_SHIFT) * _PARTS + F.col("_row") % _PARTS
    rows, buckets = bucketed_once(numbered.withColumn("_task", task), "_task", "order-rows")
    groups = {f"_g{i}": F.col(place[c]) for i, c in enumerate(partition_cols)}
    order = {f"_o{i}": F.col(place[c]) for i, c in enumerate(order_cols)}
    sums = [f"_v{i}" for i in range(len(values))]
    keys = rows.select("_row", *[c.alias(n) for n, c in {**groups, **order}.items()], *sums)
    ranged = keys.repartitionByRange(*groups, *order, "_row")
    keys = written_once(ranged.withColumn("_range", F.spark_partition_id()), "order-keys")

    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = keys.groupBy(*groups, "_range").agg(*[F.sum(v).alias(v) for v in sums])
    starts = per_range.select(F.col("_range").alias("_r"), *[F.col(g).alias(f"_s{g}") for g in groups],
                              *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_b{v}") for v in sums])
    inside = Window.partitionBy(*groups, "_range").orderBy(*order, "_row") \
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    keys = keys.select("_row", "_range", *groups, *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(v) for v in sums])
    same = F.col("_range") == F.col("_r")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_s{g}"))
    totals = keys.join(starts, same).select(
        task.alias("_task"), "_row", *[(F.col(f"_b{v}") + F.col(v)).cast("long").alias(f"_t{v}") for v in sums])
    out = rows.drop(*sums).join(totals.repartition(buckets, "_task").hint("merge"), ["_task", "_row"])
    kept = [F.col(n).alias(c) for c, n in place.items() if c not in values]
    return out.select(*kept, *[F.col(f"_t{v}").alias(name) for name, v in zip(values, sums)])


def prefix_sum(df: DataFrame, value: Column | str, order_cols: Sequence[str],
               partition_cols: Sequence[str] = (), out: str = "cum", inclusive: bool = False) -> DataFrame:
    """Running sum of ``value`` before each row (with ``inclusive``: up to it)."""
    val = F.col(value) if isinstance(value, str) else value
    return running_totals(df, {out: val}, order_cols, partition_cols, inclusive)


def row_index(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
              out: str = "idx") -> DataFrame:
    """Dense 0-based position in ``order_cols`` order within ``partition_cols``."""
    return prefix_sum(df, F.lit(1), order_cols, partition_cols, out=out)


def take_rows(df: DataFrame, order_cols: Sequence[str], n: int | None) -> DataFrame:
    """P5: the first n rows in order (all rows when n is None). A top-k, not a full sort."""
    if n is None:
        return df
    return df.orderBy(*order_cols).limit(int(n))


def shard_rows(df: DataFrame, index_col: str, num_shards: int, shard: int | None = None,
               mode: str = "modulo", total: int | None = None) -> DataFrame:
    """The share of one worker. ``modulo``: index mod n == shard. ``contiguous``:
    equal ranges, the first ``total % n`` shares one row longer. With ``shard=None``
    a ``worker`` column is added instead of filtering."""
    idx = F.col(index_col)
    if mode == "modulo":
        worker = F.pmod(idx, F.lit(num_shards))
    elif mode == "contiguous":
        if total is None:
            total = df.count()
        base, extra = divmod(int(total), num_shards)
        cut = extra * (base + 1)
        worker = F.when(idx < cut, F.floor(idx / F.lit(base + 1))).otherwise(
            F.lit(extra) + F.floor((idx - F.lit(cut)) / F.lit(max(base, 1))))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out = df.withColumn("worker", worker.cast("int"))
    if shard is None:
        return out
    return out.where(F.col("worker") == shard).drop("worker")
