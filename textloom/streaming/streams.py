"""Structured Streaming versions of the batch flows.

The same column functions run on streamed rows. Sinks are files in the shared
checkpoint folder; every query has its own streaming checkpoint, so a restarted
query resumes, and ``foreachBatch`` writers overwrite the partition of their
batch id, so a retried micro-batch leaves no duplicate.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.errors import AnalysisException

from textloom.operators.encoders import BYTES, Encoder
from textloom.operators.order import row_index
from textloom.operators.pack import pack_chunks
from textloom.plans.chat import sft_examples
from textloom.plans.corpus import ranges_of_ids
from textloom.session import scratch_path, written_once


def run_available(query) -> None:
    """Waits for an ``availableNow`` query and raises its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_sft(spark: SparkSession, instructions: DataFrame, sink: str, checkpoint: str,
               max_len: int = 1024, encoder: Encoder = BYTES) -> None:
    """Streamed instruction rows -> P2, P3, P4, B8 -> parquet sink (append)."""
    ex = sft_examples(instructions, max_len, encoder).select(
        "conv_id", "turn", "ids", F.col("prompt_len").cast("long").alias("prompt_len"))
    q = (ex.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    run_available(q)


def put_batch(df: DataFrame, path: str, batch_id: int, *within: str) -> None:
    """Writes the rows of a micro-batch as the partition of its id; a retried batch replaces what it wrote before."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", *within).parquet(path))


def before_batch(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the batches before ``batch_id`` wrote; no rows if there is no such folder yet."""
    try:
        return spark.read.schema(f"{schema}, batch_id long").parquet(path).where(F.col("batch_id") < batch_id)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing folder means: no state yet
            raise
        return spark.createDataFrame([], f"{schema}, batch_id long")


def of_batch(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What batch ``batch_id`` alone wrote, from its own folder: the folders of other batches are not even listed, so a
    batch costs the same however many came before it. No rows if it wrote none."""
    try:
        return spark.read.schema(f"{schema}, batch_id long").option("basePath", path).parquet(f"{path}/batch_id={batch_id}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch_id long")


def last_before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the last batch before ``batch_id`` that wrote anything wrote: the one just before it, or, if that wrote
    nothing, the last one found."""
    if batch_id == 0:
        return spark.createDataFrame([], f"{schema}, batch_id long")
    just = of_batch(spark, path, batch_id - 1, schema)
    if just.inputFiles():
        return just
    past = before_batch(spark, path, batch_id, schema)
    last = past.agg(F.max("batch_id").alias("b")).first()["b"]
    return past.where(F.col("batch_id") == F.lit(last))


WORKER_STATE = "worker int, seen long, taken long"


def stream_valid_rows(spark: SparkSession, instructions: DataFrame, sink: str, state: str, checkpoint: str, max_rows: int,
                      workers: int = 1, order_cols=("conv_id", "turn"), max_len: int = 1024, encoder: Encoder = BYTES) -> None:
    """X1 with the cap of P6: every worker takes each ``workers``-th row of the stream and stops at ``max_rows`` valid ones.

    The state of a worker is how many rows it has seen and taken. Each micro-batch adds one row per worker to the state
    folder under its id and reads only those of the batches before it, so a batch that is run again, after a crash between
    its two writes too, makes the same rows. Rows have positions of arrival: batch after batch, ``order_cols`` within one.
    Rows of workers that have all they need are counted but not encoded; once all have, a batch reads nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        past = before_batch(spark, state, batch_id, WORKER_STATE).groupBy("worker").agg(
            F.sum("seen").alias("seen"), F.sum("taken").alias("taken")).collect()  # one row per worker
        taken = {w: 0 for w in range(workers)} | {r["worker"]: r["taken"] for r in past}
        if all(n >= max_rows for n in taken.values()):
            return
        at = F.lit(sum(r["seen"] for r in past)) + F.col("arrival")
        left = F.element_at(F.create_map(*[F.lit(x) for w, n in taken.items() for x in (w, max(0, max_rows - n))]), F.col("worker"))
        rows = row_index(batch, list(order_cols), out="arrival")
        rows = written_once(rows.withColumn("worker", F.pmod(at, F.lit(workers)).cast("int")), "stream-shares")
        own = F.row_number().over(Window.partitionBy("worker").orderBy("arrival"))
        valid = sft_examples(rows.where(left > 0), max_len, encoder).withColumn("nth", own)
        # the constant limit is what Spark cuts to before the shuffle; a worker's own is at most that
        valid = valid.where((F.col("nth") <= max_rows) & (F.col("nth") <= left))
        put_batch(valid.select("worker", *order_cols, "ids", F.col("prompt_len").cast("long").alias("prompt_len")), sink, batch_id)
        seen = rows.groupBy("worker").agg(F.count(F.lit(1)).alias("seen"))
        new = spark.read.parquet(sink).where(F.col("batch_id") == batch_id).groupBy("worker").agg(F.count(F.lit(1)).alias("taken"))
        put_batch(seen.join(new, "worker", "left").select("worker", "seen", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")),
                  state, batch_id)

    q = (instructions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run_available(q)


COUNTERS = "total long, correct long, correct_norm long"


def stream_accuracy(spark: SparkSession, items: DataFrame, score: Callable[[DataFrame], DataFrame], counters: str,
                    checkpoint: str) -> None:
    """Items are scored as they arrive (E1-E4) and counted. ``score`` makes (correct, correct_norm) rows of items;
    an item is one row with its endings, so it is whole within its micro-batch, and what it is scored with (a loss
    table) is static. The state is one row of counters per batch id, so a batch that is run again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put_batch(score(batch).agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("correct"), F.lit(0)).cast("long").alias("correct"),
                                   F.coalesce(F.sum("correct_norm"), F.lit(0)).cast("long").alias("correct_norm")), counters, batch_id)

    q = (items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run_available(q)


def accuracy_result(spark: SparkSession, counters: str) -> DataFrame:
    """E5 of all batches so far."""
    t = spark.read.schema(f"{COUNTERS}, batch_id long").parquet(counters).agg(
        *[F.sum(c).cast("long").alias(c) for c in ("total", "correct", "correct_norm")])
    return t.select("*", (F.col("correct") / F.col("total")).alias("acc"), (F.col("correct_norm") / F.col("total")).alias("acc_norm"))


CHUNK_ROW = "split string, shard long, chunk long, chunk_in_shard long, tokens array<int>, n_tokens long, closed boolean"
TAIL_ROW = "split string, total long, ids array<int>"


def stream_pack(spark: SparkSession, docs: DataFrame, shards: str, state: str, checkpoint: str, shard_size: int,
                chunk_size: int, encoder: Encoder = BYTES) -> None:
    """Packs documents as they arrive, with any encoder.

    The state is one row per split: its tokens so far and the ids of its unfinished chunk, fewer than ``chunk_size``.
    A micro-batch puts that tail in front of its documents, packs both (K1, K2), and writes the chunks under its id; full
    ones are closed and never written again, what is left of each split is the next tail. Each batch reads the state of
    the one before it alone, so a batch that is run again makes the same chunks.

    Its documents are encoded by all tasks at once, in ranges of their order, and stored with their places within a range,
    in a folder that the next batch overwrites. One sum per range and split, with the tokens so far ahead of the first
    range, makes starts of them."""
    encoded = scratch_path(spark, "pack-ids")

    def write(batch: DataFrame, batch_id: int) -> None:
        tails = last_before(spark, state, batch_id, TAIL_ROW).drop("batch_id")  # one row per split
        made = ranges_of_ids(batch, encoder)
        made.write.mode("overwrite").parquet(encoded)
        rows = spark.read.schema(made.schema).parquet(encoded)
        sums = rows.groupBy("split", "range").agg(F.sum("n").alias("n")).unionByName(
            tails.select("split", F.lit(-1).alias("range"), F.col("total").alias("n")))  # one row per split and range
        ahead = Window.partitionBy("split").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select(F.col("split").alias("_s"), F.col("range").alias("_r"),
                             F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
        new = rows.join(F.broadcast(starts), F.col("split").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
        open_ = tails.where(F.size("ids") > 0).select("split", (F.col("total") - F.size("ids")).alias("start"), "ids")
        parts = new.select("split", (F.col("ahead") + F.col("before")).alias("start"), "ids").unionByName(open_)
        chunks = pack_chunks(parts, shard_size, chunk_size)
        put_batch(chunks.withColumn("closed", F.col("n_tokens") == chunk_size), shards, batch_id, "closed")

        totals = sums.groupBy(F.col("split").alias("_s")).agg(F.sum("n").alias("total"))
        rest = of_batch(spark, shards, batch_id, CHUNK_ROW).where("NOT closed")  # at most one chunk per split
        now = totals.join(rest, F.col("_s").eqNullSafe(F.col("split")), "left").select(
            F.col("_s").alias("split"), "total", F.coalesce("tokens", F.array().cast("array<int>")).alias("ids"))
        put_batch(now, state, batch_id)

    q = (docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run_available(q)


def streamed_chunks(spark: SparkSession, shards: str, state: str, shard_size: int, chunk_size: int) -> DataFrame:
    """The closed chunks, and each split's open one as its last; same layout as ``pack_chunks``, nothing is assembled."""
    every = spark.read.schema(f"{CHUNK_ROW}, batch_id long").parquet(shards)
    tails = spark.read.schema(f"{TAIL_ROW}, batch_id long").parquet(state)
    last = tails.agg(F.max("batch_id").alias("b")).scalar()
    per = shard_size // chunk_size
    chunk = F.expr(f"total div {chunk_size}")
    open_ = tails.where((F.col("batch_id") == last) & (F.size("ids") > 0)).select(
        "split", F.expr(f"total div {shard_size}").alias("shard"), chunk.alias("chunk"),
        F.pmod(chunk, F.lit(per)).cast("long").alias("chunk_in_shard"), F.col("ids").alias("tokens"),
        F.size("ids").cast("long").alias("n_tokens"))
    return every.where("closed").select(*open_.columns).unionByName(open_)


def stream_metric_log(spark: SparkSession, folder: str, sink: str, checkpoint: str) -> None:
    """Parses log lines as files arrive; newest value per kind (by step)."""
    from textloom.sources.io import parse_metric_lines

    lines = spark.readStream.text(folder)
    latest = parse_metric_lines(lines).groupBy("kind").agg(
        F.max("step").alias("step"), F.max_by("value", "step").alias("value"),
        F.count(F.lit(1)).cast("long").alias("lines"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (latest.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run_available(q)


#: Bytes of a row group of a staged file.
ROW_GROUP_BYTES = 4 << 20


def stage_files(df: DataFrame, path: str, key: str | list[str], rows_per_file: int = 50_000, min_files: int = 4,
                fmt: str = "parquet") -> None:
    """Writes ``df`` as a sequence of files in ``key`` order, null keys first, so that a file stream sees them arrive in
    dataset order. An arrival is a range of row positions, so a key with many rows is split over arrivals. All arrivals
    are written by one job, in row groups that several tasks can read; then their files are named one after another."""
    columns = df.columns
    df = row_index(df, [key] if isinstance(key, str) else key, out="_arrival")  # of stored rows and keys, so not made twice
    n = df.count()
    if n == 0:
        df.select(*columns).limit(0).write.mode("append").format(fmt).save(path)
        return
    files = max(min_files, -(-n // rows_per_file))
    size = -(-n // files)
    cut = df.withColumn("_arrival", F.floor(F.col("_arrival") / size).cast("long")).repartition("_arrival")
    folder = f"{path.rstrip('/')}/_arrivals-{uuid4().hex[:12]}"  # in the same store, and hidden from readers
    cut.write.partitionBy("_arrival").option("parquet.block.size", ROW_GROUP_BYTES).format(fmt).save(folder)
    name_in_order(df.sparkSession, folder, "_arrival", path)


def name_in_order(spark: SparkSession, folder: str, column: str, path: str) -> None:
    """Moves the files of ``folder``, written by ``column``, into ``path``, by the numbers in ``column``: names and times
    change, no bytes are copied. Each file's time is later than that of any before it, as file streams go by times; where
    the store sets no later time, that is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(folder), hadoop.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max([s.getModificationTime() for s in fs.listStatus(target) if s.isFile()], default=0)
    parts = [(int(s.getPath().getName().split("=")[1]), s.getPath()) for s in fs.listStatus(source) if s.isDirectory()]
    for i, part in sorted(parts, key=lambda p: p[0]):
        for file in sorted((f.getPath() for f in fs.listStatus(part)), key=lambda f: f.getName()):
            named = hadoop.Path(target, f"arrival-{i:08d}-{file.getName()}")
            if not fs.rename(file, named):
                raise OSError(f"can't name {named}")
            fs.setTimes(named, max(last + 1, int(time.time() * 1000)), -1)
            before, last = last, fs.getFileStatus(named).getModificationTime()
            if last <= before:
                raise OSError(f"the files of {path} have no order: the store set no later time")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
