"""Packing documents into fixed-size token shards (K1-K3).

The sequential packer of a single process is replaced by a closed form: every
document knows its start in the endless token stream of its split (a prefix sum
of lengths, K1); a shard is ``offset div shard_size``. Shards are stored as rows
of ``chunk_size`` tokens, so a row never holds a whole shard and a document may
straddle any number of chunk and shard borders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.order import prefix_sum

# The reference's shard size (tokens per shard). Chunk rows of 62,500
# tokens give 1,600 rows per shard.
REFERENCE_SHARD_SIZE = 100_000_000
DEFAULT_CHUNK_SIZE = 62_500


def token_offsets(docs: DataFrame, n_tokens, key: str = "doc_id", split_col: str = "split",
                  out: str = "start") -> DataFrame:
    """K1: start of each document in the token stream of its split (exclusive prefix sum).

    ``n_tokens`` is a column with the document's token count (delimiter included);
    it should be cheap (e.g. an octet length) so that the offsets are computed on
    lengths only and the token arrays are shuffled once, later, into chunks."""
    d = docs.withColumn("n_tokens", n_tokens.cast("long"))
    return prefix_sum(d, "n_tokens", [key], [split_col], out=out, inclusive=False)


# Tokens of one aggregation group (64 MB of ids).
GROUP_TOKENS = 16_000_000


def pack_chunks(docs: DataFrame, shard_size: int, chunk_size: int, ids_col: str = "ids",
                start_col: str = "start", split_col: str = "split",
                group_tokens: int = GROUP_TOKENS, group_shards: int = 1) -> DataFrame:
    """K2: concatenates documents in order and cuts rows of ``chunk_size`` tokens.

    Input rows: (split, start, ids). Output: (split, shard, chunk, chunk_in_shard,
    n_tokens, tokens); ``chunk`` counts from 0 within the split.

    Pieces are shuffled once, by (split, group) where a group is ``group_tokens`` of
    consecutive chunks (at most one shard, or ``group_shards`` whole ones, for stores that keep
    so many in a folder), and aggregated per chunk inside that partitioning (a hash partitioning on a subset of the grouping keys needs no second
    exchange). The output stays partitioned by group: a shard is written by a few
    tasks (about shard_size / group_tokens) without another shuffle, while the
    aggregation runs over many bounded groups in parallel."""
    if shard_size % chunk_size != 0:
        raise ValueError("chunk_size must divide shard_size")
    per_shard = shard_size // chunk_size
    group = max(1, min(per_shard, group_tokens // chunk_size)) if group_shards == 1 else per_shard * group_shards
    C = F.lit(chunk_size).cast("long")
    ids = F.col(ids_col)
    start = F.col(start_col).cast("long")
    n = F.size(ids).cast("long")
    end = start + n

    def piece(c):
        lo = F.greatest(c * C, start)
        hi = F.least(end, (c + 1) * C)
        return F.struct(c.alias("chunk"), lo.alias("pos"),
                        F.slice(ids, (lo - start + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))

    pieces = F.when(n > 0, F.transform(F.sequence(F.floor(start / C).cast("long"),
                                                   F.floor((end - 1) / C).cast("long")), piece))
    exploded = docs.select(F.col(split_col).alias("split"),
                           F.explode(pieces).alias("p")).select("split", "p.chunk", "p.pos", "p.piece")
    exploded = exploded.withColumn("_grp", F.floor(F.col("chunk") / group).cast("long"))
    grouped = exploded.repartition("split", "_grp").groupBy("split", "_grp", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
    tokens = F.flatten(F.transform(F.col("parts"), lambda s: s["piece"]))
    return grouped.select(
        "split",
        (F.col("chunk") / per_shard).cast("long").alias("shard"),
        "chunk",
        F.pmod(F.col("chunk"), F.lit(per_shard)).cast("long").alias("chunk_in_shard"),
        tokens.alias("tokens"),
    ).withColumn("n_tokens", F.size("tokens").cast("long"))


def split_totals(offsets: DataFrame, shard_size: int, split_col: str = "split") -> DataFrame:
    """K3 totals per split: documents, tokens, shards, tokens in the last shard
    (0 on an exact fill; what the reference returns as its token count)."""
    g = offsets.groupBy(F.col(split_col).alias("split")).agg(
        F.count(F.lit(1)).cast("long").alias("documents"),
        F.sum("n_tokens").cast("long").alias("tokens"))
    size = F.lit(shard_size).cast("long")
    return g.select(
        "split", "documents", "tokens",
        F.ceil(F.col("tokens") / size).cast("long").alias("shards"),
        F.pmod(F.col("tokens"), size).cast("long").alias("last_shard_tokens"))


def shard_manifest(totals: DataFrame, shard_size: int, name: str = "corpus") -> DataFrame:
    """K3: one row per shard: split, shard, file name, token count."""
    size = F.lit(shard_size).cast("long")
    m = totals.select("split", "tokens", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    return m.select(
        "split", "shard",
        F.concat(F.lit(f"{name}_"), F.col("split"), F.lit("_"),
                 F.lpad(F.col("shard").cast("string"), 6, "0")).alias("name"),
        F.least(size, F.col("tokens") - F.col("shard") * size).cast("long").alias("n_tokens"))
