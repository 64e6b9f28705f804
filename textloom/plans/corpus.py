"""Corpus to token shards: documents -> byte ids -> offsets -> chunks -> manifest.

Plan shape: the offsets are a prefix sum over (split, doc_id, length) only, joined
back to the texts, which are encoded after that, cut into pieces per chunk and
shuffled once more by (split, chunk group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.tokens import byte_encode_length, prepend
from textloom.operators.encoders import BYTES, Encoder
from textloom.operators.pack import pack_chunks, shard_manifest, split_totals, token_offsets

# Sizes used on the test tables (the reference's own are 100M-token shards).
TEST_SHARD_SIZE = 65_536
TEST_CHUNK_SIZE = 4_096

#: Folders of a split's store. Up to so many shards have one each; of more, some consecutive ones share a folder, as
#: every folder and file costs a task, and the driver's listing, the same however few tokens it holds.
MAX_FOLDERS = 1024


def document_offsets(docs: DataFrame) -> DataFrame:
    """K1 over (split, doc_id, text): adds n_tokens (EOT included) and start."""
    return token_offsets(docs, F.lit(1) + BYTES.length("text"))


def document_ids(docs: DataFrame, encoder: Encoder = BYTES) -> DataFrame:
    """T4 + T5 + T6: ids = [delimiter] + ids of the text."""
    return encoder.with_ids(docs, ids=F.col("text")).withColumn("ids", prepend("ids", encoder.eot))


def placed_ids(docs: DataFrame, encoder: Encoder = BYTES) -> DataFrame:
    """(split, start, ids) of a corpus (split, doc_id, text). An encoder that knows lengths without encoding
    encodes after the offsets; any other one encodes once, before them."""
    if encoder.length("text") is None:
        ids = document_ids(docs, encoder).select("split", "doc_id", "ids")
        ids = token_offsets(ids, F.size("ids"))
    else:
        ids = document_ids(token_offsets(docs, F.lit(1) + encoder.length("text")), encoder)
    return ids.select("split", "start", "ids")


def ranges_of_ids(docs: DataFrame, encoder: Encoder = BYTES) -> DataFrame:
    """(range, split, before, n, ids) of a corpus (split, doc_id, text): texts are dealt into ranges of their order, so
    that all tasks encode however few files or row groups they came in, and encoded once. ``before``: the ids ahead of
    a row in its split and range. Rows with equal keys come in the order they are read."""
    order = ["split", "doc_id", "_row"]
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return encoder.with_places(rows, "text", "split").withColumn("range", F.spark_partition_id())


def corpus_chunks(docs: DataFrame, shard_size: int = TEST_SHARD_SIZE, chunk_size: int = TEST_CHUNK_SIZE,
                  encoder: Encoder = BYTES, group_shards: int = 1) -> DataFrame:
    """K2 over a corpus (split, doc_id, text)."""
    return pack_chunks(placed_ids(docs, encoder), shard_size, chunk_size, group_shards=group_shards)


def corpus_totals(docs: DataFrame, shard_size: int = TEST_SHARD_SIZE) -> DataFrame:
    """K3 totals: computed from lengths only; no token array is built."""
    lengths = docs.select("split", (F.lit(1) + byte_encode_length("text")).cast("long").alias("n_tokens"))
    return split_totals(lengths, shard_size)


def shards_per_folder(docs: DataFrame, shard_size: int = TEST_SHARD_SIZE) -> int:
    """How many consecutive shards share a folder of a store, so that no split has more than ``MAX_FOLDERS`` of them. By
    bytes of the texts: an estimate for encoders with other lengths, which moves the bound and no result."""
    most = corpus_totals(docs, shard_size).agg(F.max("shards")).first()[0] or 1
    return -(-most // MAX_FOLDERS)


def corpus_manifest(docs: DataFrame, shard_size: int = TEST_SHARD_SIZE, name: str = "corpus") -> DataFrame:
    return shard_manifest(corpus_totals(docs, shard_size), shard_size, name)


def assign_split(train: DataFrame, val: DataFrame) -> DataFrame:
    """Two corpora as one, rows labelled by the corpus they come from."""
    label = lambda df, name: df.select(F.lit(name).alias("split"), *df.columns)
    return label(train, "train").unionByName(label(val, "val"))
