"""Sources and sinks."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import coerce_text
from textloom.sources import npy

SPLITS = ("train", "val")

CHOICE_SCHEMA = T.StructType([
    T.StructField("ind", T.LongType()),
    T.StructField("ctx", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("endings", T.ArrayType(T.StringType())),
])

INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("system_prompt", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("response", T.StringType()),
])

METRIC_KINDS = ("val", "hella", "train")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test layout."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet", text_col: str = "text",
                   key: str | None = "doc_id") -> DataFrame:
    """A corpus; only the key and text columns are read (pruned at the scan)."""
    if fmt == "text":
        df = spark.read.text(path).withColumnRenamed("value", text_col)
    else:
        df = spark.read.format(fmt).load(path)
    if text_col not in df.columns:  # a row without the column has no text
        df = df.withColumn(text_col, F.lit(None).cast("string"))
    cols = [coerce_text(text_col).alias("text")]
    if key is not None and key in df.columns:
        cols.insert(0, F.col(key).alias("doc_id"))
    return df.select(*cols)


def read_choice_items(spark: SparkSession, path: str) -> DataFrame:
    """Multiple-choice items as JSON lines with an explicit schema."""
    return spark.read.schema(CHOICE_SCHEMA).json(path)


def read_instructions(spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False,
                      schema: T.StructType = INSTRUCTION_SCHEMA, **options) -> DataFrame:
    """S3: instruction rows, batch or streamed (``options`` of the file stream, as maxFilesPerTrigger); missing columns
    come back null."""
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.schema(schema).format(fmt).load(path)


def write_shards(chunks: DataFrame, path: str, mode: str = "overwrite", packed: bool = True, per_folder: int = 1) -> None:
    """Packed chunks as parquet partitioned by split and shard, rows in chunk order.

    Output of ``pack_chunks`` is already partitioned by groups of chunks of one shard,
    so each shard is written by a few tasks without another shuffle (``packed``).
    Other input is first partitioned the same way (by split and shard group). With ``per_folder`` above 1 (and chunks
    packed with as many ``group_shards``) so many consecutive shards share a folder and a file: the folder has the number of
    the first one, and ``shard_in_folder`` what is to be added."""
    if not packed:
        chunks = chunks.repartition("split", (F.col("chunk") / 8).cast("long"))
    at = F.pmod(F.col("shard"), F.lit(per_folder)).cast("long")
    chunks = chunks.withColumn("shard_in_folder", at).withColumn("shard", F.col("shard") - F.col("shard_in_folder"))
    (chunks.sortWithinPartitions("split", "shard", "chunk")
     .write.mode(mode).partitionBy("split", "shard").parquet(path))


def whole_shards(rows: DataFrame, per_folder: int = 1) -> DataFrame:
    """Rows of a store with their own shard; ``folder`` (its metadata: shards in one) is the partition to prune by."""
    folder = F.col("shard").cast("long")
    return rows.withColumn("folder", folder.alias("folder", metadata={"shards": per_folder})) \
        .withColumn("shard", F.col("shard").cast("long") + F.col("shard_in_folder")).drop("shard_in_folder")


def read_shards(spark: SparkSession, path: str, split: str) -> DataFrame:
    """The chunks of one split (partition pruning; other splits are not even listed), ids widened to long.
    Refuses an unknown split and a split without shards."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    try:
        df = spark.read.option("basePath", path).parquet(os.path.join(path, f"split={split}"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no shards found for split {split}") from None
    if df.select("chunk").limit(1).count() == 0:  # one probe, not a scan
        raise ValueError(f"no shards found for split {split}")
    return whole_shards(df).drop("folder").withColumn("tokens", F.col("tokens").cast("array<bigint>"))


def list_shards(manifest: DataFrame, split: str) -> DataFrame:
    """Shard names that contain the split name, sorted as strings."""
    return manifest.where(F.col("name").contains(split)).orderBy("name")


def metric_lines(metrics: DataFrame) -> DataFrame:
    """S7 format: ``{step} val {v:.4f}``, ``{step} hella {v:.4f}``, ``{step} train {v:.6f}``."""
    v = F.when(F.col("kind") == "train", F.format_string("%.6f", F.col("value"))) \
        .otherwise(F.format_string("%.4f", F.col("value")))
    return metrics.select("step", "kind", F.concat_ws(" ", F.col("step").cast("string"), F.col("kind"), v).alias("line"))


def write_metric_log(metrics: DataFrame, path: str) -> None:
    """S7 write: text files of lines, in file name order in (step, kind order of the loop)
    order; the folder is replaced, like the file emptied at start."""
    order = F.when(F.col("kind") == "val", 0).when(F.col("kind") == "hella", 1).otherwise(2)
    metric_lines(metrics).withColumn("_o", order).orderBy("step", "_o").select("line") \
        .write.mode("overwrite").text(path)


def parse_metric_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """S7 read: ``step kind value`` -> (step int, kind string, value double)."""
    parts = F.split(F.col(col), " ")
    return lines.select(parts.getItem(0).cast("int").alias("step"), parts.getItem(1).alias("kind"),
                        parts.getItem(2).cast("double").alias("value"))


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_metric_lines(spark.read.text(path))


def export_npy(chunks: DataFrame, manifest: DataFrame, folder: str, name: str = "corpus") -> None:
    """S6 export: one ``{name}_{split}_{shard:06d}.npy`` per shard through the ``npy_shards`` data source.

    Chunks are partitioned by shard, joined to their shard's length in that partitioning and sorted by chunk, so a task
    streams one shard after the other into files; they appear in the folder once all tasks have succeeded."""
    spark = chunks.sparkSession
    npy.register(spark)
    lengths = manifest.select("split", "shard", F.col("n_tokens").cast("long").alias("shard_tokens"))
    rows = chunks.select("split", F.col("shard").cast("long").alias("shard"), F.col("chunk").cast("long").alias("chunk"),
                         F.col("tokens").cast("array<int>").alias("tokens")).repartition("split", "shard")
    (rows.join(lengths, ["split", "shard"], "left").sortWithinPartitions("split", "shard", "chunk")
     .write.format(npy.FORMAT).option("name", name).mode("append").save(npy.qualified(spark, folder)))


def import_npy(spark: SparkSession, folder: str, chunk_size: int = npy.CHUNK_SIZE) -> DataFrame:
    """S6 import: ``.npy`` shards back to (split, shard, chunk_in_shard, tokens) rows, by ranges of bytes."""
    npy.register(spark)
    return spark.read.format(npy.FORMAT).option("chunk_size", chunk_size).load(npy.qualified(spark, folder))
