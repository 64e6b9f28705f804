"""Stored shards of a corpus: packed once for a session and an input, read by every window query.

A store is the parquet layout of ``write_shards`` (a folder per split and shard, or per some consecutive shards of a split
that has very many; rows in chunk order), so a read of some windows opens the folders of their shards alone and, inside a
file, the row groups of their chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.encoders import BYTES, Encoder
from textloom.plans.corpus import corpus_chunks, shards_per_folder
from textloom.session import scratch_path
from textloom.sources.io import whole_shards, write_shards

STORE_ROW = "chunk long, chunk_in_shard long, tokens array<int>, n_tokens long, shard_in_folder long, split string, shard long"


def input_mark(table: DataFrame) -> tuple:
    """What tells the files of a table from any later ones at the same place: their number, sizes and times."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum("file_size"), F.max("file_modification_time"),
                           F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))).first())


def shard_store(spark: SparkSession, docs: DataFrame, mark: tuple, split: str, shard_size: int, chunk_size: int,
                encoder: Encoder = BYTES) -> DataFrame:
    """The chunks of one split of ``docs`` (split, doc_id, text) from its store. Only that split is read and encoded,
    and only if the session has no store of it yet; ``mark`` is the input's ``input_mark``."""
    stores = spark.__dict__.setdefault("_textloom_stores", {})
    folds = spark.__dict__.setdefault("_textloom_store_folds", {})
    key = (spark.sparkContext.applicationId, mark, split, shard_size, chunk_size, encoder)
    if key not in stores:
        path = scratch_path(spark, f"shards-{split}")
        docs = docs.where(F.col("split") == split)
        folds[path] = shards_per_folder(docs, shard_size)
        write_shards(corpus_chunks(docs, shard_size, chunk_size, encoder, folds[path]), path, per_folder=folds[path])
        stores[key] = path
    rows = spark.read.schema(STORE_ROW).parquet(stores[key]).where(F.col("split") == split)
    return whole_shards(rows, folds[stores[key]])
