"""Training windows and step planning on top of the shard manifest.

A reader of rank r starts a shard at ``B*T*r`` and moves ``B*T*N`` tokens per
window; it leaves the shard when the next window would not fit, and wraps to
shard 0 after the last. In closed form the number of windows of a shard of
length L for rank r is ``max(1, (L - 1 - B*T*r) div (B*T*N))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import written_once

# Evaluation every 250 steps, 20 validation windows, checkpoint
# every 5,000 steps (and at the last step).
EVAL_EVERY = 250
VAL_WINDOWS = 20
CHECKPOINT_EVERY = 5000


def window_counts(manifest: DataFrame, B: int, T: int, N: int) -> DataFrame:
    """K6: windows per (split, shard, rank). Fails naming the shard and rank when a
    shard is too short for the first window of a rank."""
    bt = B * T
    ranks = manifest.select("split", "shard", "name", "n_tokens",
                            F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("rank"))
    L = F.col("n_tokens")
    first_end = F.lit(bt) * F.col("rank") + F.lit(bt + 1)
    n = F.greatest(F.lit(1).cast("long"),
                   F.floor((L - 1 - F.lit(bt) * F.col("rank")) / F.lit(bt * N)).cast("long"))
    msg = F.concat(F.lit("shard "), F.col("name"), F.lit(" too short for a window of rank "),
                   F.col("rank").cast("string"))
    return ranks.select("split", "shard", "name", "rank", "n_tokens",
                        F.when(first_end <= L, n).otherwise(F.raise_error(msg).cast("long")).alias("windows"))


def plan_steps(manifest: DataFrame, total_batch: int, B: int, T: int, N: int) -> DataFrame:
    """K7: gradient accumulation, micro-batches and optimiser steps per split."""
    if total_batch % (B * T * N) != 0:
        raise ValueError("total_batch must be divisible by B * T * N")
    accum = total_batch // (B * T * N)
    btn = B * T * N
    g = manifest.groupBy("split").agg(
        F.sum(F.floor((F.col("n_tokens") - 1) / F.lit(btn))).cast("long").alias("micro_batches"),
        F.count(F.lit(1)).cast("long").alias("shards"))
    steps = F.floor(F.col("micro_batches") / F.lit(accum)).cast("long")
    return g.select("split", "shards", F.lit(accum).cast("long").alias("grad_accum"), "micro_batches",
                    F.when(steps > 0, steps).otherwise(
                        F.raise_error(F.lit("shards do not hold enough tokens for one step")).cast("long")
                    ).alias("max_steps"))


def step_schedule(spark: SparkSession, max_steps: int, eval_every: int = EVAL_EVERY,
                  checkpoint_every: int = CHECKPOINT_EVERY) -> DataFrame:
    """K8: per step, whether to evaluate, generate and checkpoint."""
    s = F.col("id")
    last = s == F.lit(max_steps - 1)
    evaluate = (F.pmod(s, F.lit(eval_every)) == 0) | last
    return spark.range(max_steps).select(
        s.alias("step"), last.alias("last_step"), evaluate.alias("evaluate"),
        (((s > 0) & (F.pmod(s, F.lit(eval_every)) == 0)) | last).alias("generate"),
        (evaluate & (s > 0) & ((F.pmod(s, F.lit(checkpoint_every)) == 0) | last)).alias("checkpoint"))


def window_ordinals(counts: DataFrame) -> DataFrame:
    """Each rank's windows in reading order: (split, rank, ordinal, shard, k).
    The running count over shards is over the small (shard x rank) table."""
    w = Window.partitionBy("split", "rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    c = counts.withColumn("first", F.coalesce(F.sum("windows").over(w), F.lit(0)).cast("long"))
    e = c.select("split", "rank", "shard", "first",
                 F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)).alias("k"))
    return e.select("split", "rank", (F.col("first") + F.col("k")).alias("ordinal"), "shard", "k")


def assign_windows(counts: DataFrame, reads: DataFrame, B: int, T: int, N: int) -> DataFrame:
    """K9 core: ``reads`` has (split, rank, read) with the read number of that rank
    from the start; the rank wraps to shard 0 after its last window.

    Where all shards of a split but the last are full, as K2 packs them, a rank has the same
    number of windows in each of them, and the shard and window of a read are arithmetic on
    three numbers per (split, rank): windows of a full shard, last shard, all windows. Reads
    of ranks whose shards differ (manifests from elsewhere) find theirs by a join on the
    windows in reading order, which is empty otherwise."""
    bt = B * T
    ends = counts.groupBy("split", "rank").agg(
        F.min_by("windows", "shard").alias("full"), F.max_by("windows", "shard").alias("last"),
        F.max("shard").alias("end"), F.count(F.lit(1)).alias("n"), F.sum("windows").cast("long").alias("total"),
        F.min("windows").alias("least"), F.max("windows").alias("most"))
    # equal before the last: the sum fits, and no shard has more windows (or, but for the last, fewer) than the first
    even = (F.col("end") + 1 == F.col("n")) & (F.col("most") == F.col("full")) & \
        (F.col("least") == F.col("last")) & (F.col("total") == F.col("full") * F.col("end") + F.col("last"))
    ends = ends.select("split", "rank", "full", "end", "total", even.alias("even"))
    r = reads.join(F.broadcast(ends), ["split", "rank"])  # one row per split and rank
    r = r.withColumn("ordinal", F.expr("read % total"))
    near = r.where("even").withColumn("shard", F.least(F.expr("ordinal div full"), F.col("end"))) \
        .withColumn("k", F.col("ordinal") - F.col("shard") * F.col("full"))
    odd = counts.join(F.broadcast(ends.where("not even").select("split", "rank")), ["split", "rank"], "left_semi")
    far = r.where("not even").join(window_ordinals(odd), ["split", "rank", "ordinal"])
    w = near.unionByName(far)
    return w.withColumn("start", (F.lit(bt) * F.col("rank") + F.col("k") * F.lit(bt * N)).cast("long")) \
        .drop("total", "ordinal", "full", "end", "even")


def assign_steps(spark: SparkSession, counts: DataFrame, max_steps: int, grad_accum: int,
                 B: int, T: int, N: int, split: str = "train") -> DataFrame:
    """K9: which window every (step, micro step, rank) reads."""
    reads = spark.range(max_steps * grad_accum).select(
        F.lit(split).alias("split"), F.col("id").alias("read"),
        F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("rank"))
    a = assign_windows(counts.where(F.col("split") == split), reads, B, T, N)
    return a.select("split", (F.col("read") / grad_accum).cast("long").alias("step"),
                    F.pmod(F.col("read"), F.lit(grad_accum)).cast("long").alias("micro_step"),
                    "rank", "read", "shard", "k", "start")


def validation_windows(spark: SparkSession, counts: DataFrame, B: int, T: int, N: int,
                       n: int = VAL_WINDOWS, split: str = "val") -> DataFrame:
    """The reader is reset; the first n windows of each rank, wrapping."""
    reads = spark.range(n).select(F.lit(split).alias("split"), F.col("id").alias("read"),
                                  F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("rank"))
    return assign_windows(counts.where(F.col("split") == split), reads, B, T, N) \
        .select("split", "rank", "read", "shard", "k", "start")


def cut_windows(chunks: DataFrame, windows: DataFrame, B: int, T: int, shard_size: int,
                chunk_size: int, keys: tuple[str, ...] = ("split", "rank", "read")) -> DataFrame:
    """K4 + K5: the B*T+1 tokens of each window from the chunk rows, then x and y.

    A window is a range over the token stream; it is turned into an equi-join on
    the chunk ids it covers (at most ceil((B*T+1)/chunk)+1 of them)."""
    bt = B * T
    C = F.lit(chunk_size).cast("long")
    g = F.col("shard") * F.lit(shard_size).cast("long") + F.col("start")
    w = windows.withColumn("_g", g)

    def piece(c):
        lo = F.greatest(c * C, F.col("_g"))
        hi = F.least(F.col("_g") + F.lit(bt + 1), (c + 1) * C)
        return F.struct(c.alias("chunk"), (lo - c * C).alias("off"), (hi - lo).alias("len"))

    spans = F.transform(F.sequence(F.floor(F.col("_g") / C).cast("long"),
                                   F.floor((F.col("_g") + F.lit(bt)) / C).cast("long")), piece)
    e = w.select(*keys, F.explode(spans).alias("p")).select(*keys, "p.chunk", "p.off", "p.len")
    j = e.join(chunks.select("split", "chunk", "tokens"), ["split", "chunk"])
    j = j.select(*keys, "chunk", F.slice("tokens", (F.col("off") + 1).cast("int"), F.col("len").cast("int")).alias("piece"))
    buf = j.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("chunk", "piece"))).alias("parts")) \
        .select(*keys, F.flatten(F.transform("parts", lambda s: s["piece"])).alias("buf"))
    return buf.select(*keys, F.slice("buf", 1, bt).alias("x"), F.slice("buf", 2, bt).alias("y"))


def window_rows(windows: DataFrame, B: int, T: int, keys: tuple[str, ...] = ("split", "rank", "read")) -> DataFrame:
    """K5 shape: (B, T) rows of one window as B rows with ``row`` 0..B-1."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(B - 1)),
                       lambda b: F.struct(b.alias("row"), F.slice("x", b * T + 1, T).alias("x"),
                                          F.slice("y", b * T + 1, T).alias("y")))
    return windows.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.row", "r.x", "r.y")


def window_buffers(chunks: DataFrame, counts: DataFrame, B: int, T: int, N: int, shard_size: int,
                   chunk_size: int, wanted: DataFrame | None = None) -> DataFrame:
    """K4 without a join on chunks: every window of every rank, cut from the chunk rows.

    Window starts are multiples of B*T inside a shard, so the windows of all ranks
    tile the shard in blocks of B*T tokens: block j is the body of window
    (rank j mod N, k j div N), and its first token is the last token of the window
    of block j-1. Each chunk is cut into pieces per block (each token goes to one
    window, block heads to two), grouped by window; windows beyond a rank's count
    (the unused tail of a shard) are dropped by the formula of K6, with the last shard and
    its length per split. ``wanted`` (split, shard, rank, k) keeps these windows only,
    before anything is grouped. Output: (split, shard, rank, k, x, y)."""
    bt = B * T
    per_shard = shard_size // chunk_size
    BT = F.lit(bt).cast("long")
    c0 = F.pmod(F.col("chunk"), F.lit(per_shard)).cast("long") * F.lit(chunk_size)  # chunk start in its shard
    n = F.size("tokens").cast("long")

    def body(j):
        lo = F.greatest(j * BT, c0)
        hi = F.least((j + 1) * BT, c0 + n)
        return F.struct(j.alias("block"), lo.alias("pos"),
                        F.slice("tokens", (lo - c0 + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))

    bodies = F.transform(F.sequence(F.floor(c0 / BT).cast("long"), F.floor((c0 + n - 1) / BT).cast("long")), body)
    # block heads inside this chunk: the extra token of the previous block's window
    first_head = F.ceil(c0 / BT).cast("long")
    last_head = F.floor((c0 + n - 1) / BT).cast("long")
    heads = F.transform(
        F.filter(F.sequence(first_head, F.greatest(last_head, first_head)),
                 lambda j: (j >= 1) & (j * BT >= c0) & (j * BT < c0 + n)),
        lambda j: F.struct((j - 1).alias("block"), (j * BT).alias("pos"),
                           F.slice("tokens", (j * BT - c0 + 1).cast("int"), 1).alias("piece")))
    pieces = chunks.select("split", "shard", F.explode(F.concat(bodies, heads)).alias("p")) \
        .select("split", "shard", "p.block", "p.pos", "p.piece")
    pieces = pieces.withColumn("rank", F.pmod(F.col("block"), F.lit(N)).cast("int")) \
        .withColumn("k", F.floor(F.col("block") / N).cast("long"))
    ends = counts.groupBy("split").agg(F.max("shard").alias("_end"), F.max_by("n_tokens", "shard").alias("_n"))
    pieces = pieces.join(F.broadcast(ends), "split")  # one row per split
    length = F.when(F.col("shard") < F.col("_end"), F.lit(shard_size)).otherwise(F.col("_n"))
    pieces = pieces.withColumn("_room", length - 1 - F.lit(bt) * F.col("rank")) \
        .where(F.col("k") < F.greatest(F.lit(1), F.expr(f"_room div {bt * N}"))).drop("_end", "_n", "_room")
    if wanted is not None:
        pieces = pieces.join(wanted.select("split", "shard", "rank", "k").distinct(), ["split", "shard", "rank", "k"], "left_semi")
    w = pieces.groupBy("split", "shard", "rank", "k").agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
    buf = F.flatten(F.transform("parts", lambda s: s["piece"]))
    return w.select("split", "shard", "rank", "k", buf.alias("buf")) \
        .select("split", "shard", "rank", "k", F.slice("buf", 1, bt).alias("x"), F.slice("buf", 2, bt).alias("y"))


def needed_chunks(windows: DataFrame, B: int, T: int, shard_size: int, chunk_size: int) -> DataFrame:
    """(split, shard, chunk) that the B*T+1 tokens of the windows lie in."""
    first = F.expr(f"shard * {shard_size // chunk_size} + start div {chunk_size}")
    last = F.expr(f"shard * {shard_size // chunk_size} + (start + {B * T}) div {chunk_size}")
    return windows.select("split", F.col("shard").cast("long").alias("shard"),
                          F.explode(F.sequence(first, last)).alias("chunk")).distinct()


# Chunks named one by one up to this many (a few MB); more of them are most of a store, which is then read plainly.
MAX_NAMED_CHUNKS = 50_000


def only_chunks(stored: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows of a shard store that are needed. The few keys are broadcast, so Spark prunes the folders of other
    shards when the query runs, and the range of chunks, two scalars, skips row groups inside the files left."""
    needed = written_once(needed, "needed-chunks")
    if needed.count() > MAX_NAMED_CHUNKS:
        return stored
    ends = needed.agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    near = stored.where(F.col("chunk").between(ends.select("lo").scalar(), ends.select("hi").scalar()))
    # a store with several shards in a folder prunes by that folder, and says how many there are
    place, width = ("folder", stored.schema["folder"].metadata["shards"]) if "folder" in stored.columns else ("shard", 1)
    keys = needed.select(F.col("split").alias("_split"), (F.col("shard") - F.col("shard") % width).alias("_place"),
                         F.col("chunk").alias("_chunk"))
    same = (F.col("split") == F.col("_split")) & (F.col(place) == F.col("_place")) & (F.col("chunk") == F.col("_chunk"))
    return near.join(F.broadcast(keys), same, "left_semi")


def read_windows(buffers: DataFrame, reads: DataFrame, keys=("split", "rank", "read")) -> DataFrame:
    """The windows that the reads of K9 / K10 take, by an equi-join on (split, rank, shard, k)."""
    return reads.select(*keys, "shard", "k").join(buffers, ["split", "rank", "shard", "k"]) \
        .select(*keys, "x", "y")
