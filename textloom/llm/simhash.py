"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has a bit for each bit that more than half of its shingles' XXH64 values have set.
Fingerprints link when they differ in at most ``radius`` bits. The candidate tables come from a covering family
of masks: every bit position gets a non-zero vector of ``radius + 1`` bits, and the mask of a non-zero vector v
keeps the positions whose vector has an odd product with v. Any ``radius`` differing positions leave some v
whose products with all of them are even, so the pair agrees under that mask: 2^(radius+1) - 1 tables find every
pair, with no chance of a miss.

Copies of a fingerprint are one node. Buckets aren't expanded into pairs: a bucket's rows arrive sorted, small
buckets are compared at each distance in the sorted order, and large ones are searched breadth-first against
what isn't reached yet, giving at most one link per node, which is all that components need. Buckets above
``split`` nodes are dealt again by a second covering family on the remaining bits, which again loses no pair.

Edge rows: a null or empty text has no shingle and fingerprint zero, and is linked like any other. A row with a
null id takes part; its component is the smallest id there, null only if no row has one. Repeated rows are
linked. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import keep_rows, rows_of, stored, text_bytes
from textloom.llm.components import components

#: Buckets above this many fingerprints are dealt again.
SPLIT = 2_000
#: Shingles hashed at a time.
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    import xxhash

    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        part = words[at:at + STEP + shingle - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in joined), np.uint64)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, tie, fp long) per row; ``tie`` is a hash of the text, to tell rows with one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle, seed) for (t,) in rows_of([b], "t")]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["id", "tie", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), tie(text_col).alias("tie"), text_bytes(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, tie long, fp long")


def tie(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def covering_masks(radius: int, seed: int) -> list[int]:
    """Masks of which, for any ``radius`` positions of 64, one keeps none of them."""
    vectors = np.random.default_rng(seed).permutation(np.resize(np.arange(1, 2 ** (radius + 1)), 64))
    return [sum(1 << i for i, x in enumerate(vectors) if bin(int(x) & v).count("1") % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _tables(fps: DataFrame, masks: list[int], extra: Column | None = None) -> DataFrame:
    keys = F.array(*(F.xxhash64(*([extra] if extra is not None else []), F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m))))
                     for k, m in enumerate(masks)))
    return fps.select(F.explode(keys).alias("key"), "fp")


def bucket_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of one bucket: a spanning forest of all close pairs."""
    left, a, b = fps.copy(), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = []
            for node in front:
                near = np.bitwise_count(left ^ node) <= radius
                if near.any():
                    reached.append(left[near])
                    a.append(np.full(int(near.sum()), node))
                    b.append(reached[-1])
                    left = left[~near]
            front = np.concatenate(reached) if reached else left[:0]
    none = np.zeros(0, fps.dtype)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links(tables: DataFrame, radius: int, split: int | None) -> DataFrame:
    """Links of sorted buckets; of those above ``split`` rows, the rows themselves (link to itself, with the key)."""

    def flush(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        of = np.repeat(np.arange(len(starts)), sizes)
        out = []
        small = 32
        for lag in range(1, int(min(small, sizes.max()))):
            i = np.flatnonzero((of[lag:] == of[:-lag]) & (sizes[of[lag:]] <= small))
            i = i[np.bitwise_count(fps[i] ^ fps[i + lag]) <= radius]
            out.append((fps[i], fps[i + lag], np.zeros(len(i), np.int64)))
        for g in np.flatnonzero(sizes > small):
            own = fps[starts[g]:starts[g] + sizes[g]]
            if split is not None and len(own) > split:
                out.append((own, own, np.full(len(own), keys[starts[g]])))
            else:
                a, b = bucket_links(own, radius)
                out.append((a, b, np.zeros(len(a), np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*out)], ["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []
        for batch in batches:
            k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last bucket may go on in the next batch
            if keys and cut:
                joined = np.concatenate([*keys, k[:cut]]), np.concatenate([*fps, f[:cut]])
                yield from flush(joined[0], joined[1].view(np.uint64))
                keys, fps = [], []
            elif cut:
                yield from flush(k[:cut], f[:cut].view(np.uint64))
            elif keys and keys[-1][-1] != k[-1]:
                yield from flush(np.concatenate(keys), np.concatenate(fps).view(np.uint64))
                keys, fps = [], []
            keys.append(k[cut:])
            fps.append(f[cut:])
        if keys:
            yield from flush(np.concatenate(keys), np.concatenate(fps).view(np.uint64))

    dealt = tables.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long, key long")


def close_links(fps: DataFrame, radius: int = 3, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits of each other."""
    found = stored(_links(_tables(fps, covering_masks(radius, 1)), radius, split), "simhash-links")
    links = found.where("key = 0").select("a", "b")
    large = found.where("key <> 0").select("key", F.col("a").alias("fp"))
    if large.isEmpty():
        return links
    second = _tables(large, covering_masks(radius, 2), F.col("key"))
    return links.unionByName(_links(second, radius, None).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                    seed: int = 42, split: int = SPLIT) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (signed 64 bits), ``component_id``."""
    rows, named = _components(docs, id_col, text_col, shingle, radius, seed, split)
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, seed: int, split: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprints, and per fingerprint its component's smallest id and first (null, id, tie)."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-rows")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "tie")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"), F.min(place).alias("place"))
    roots = components(close_links(rows.select("fp").distinct(), radius, split))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "place", F.coalesce("root", "fp").alias("root"))
    nodes = stored(nodes, "simhash-nodes")
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"), F.min("place").alias("stays"))
    return rows, nodes.join(ids, "root").select("fp", "component_id", "stays")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                     seed: int = 42, split: int = SPLIT) -> DataFrame:
    """The input rows that stay, one of each component, with all their columns: the row with the smallest id."""
    rows, named = _components(docs, id_col, text_col, shingle, radius, seed, split)
    own = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("tie") == F.col("stays.tie"))
    first = F.row_number().over(Window.partitionBy("id", "tie").orderBy("fp")) == 1  # of rows repeated whole
    decisions = rows.withColumn("first", first).join(named, "fp").select("id", "tie", (own & F.col("first")).alias("kept"))
    return keep_rows(docs, {"id": F.col(id_col).cast("long"), "tie": tie(text_col)}, decisions)


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
