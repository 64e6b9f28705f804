"""Skew-safe exact deduplication with DataFrame operations only.

Documents are equal when their texts are identical after lower-casing A-Z; a null text counts as empty.
The digest only finds candidates. Their whole texts are then compared at every stage, since the text itself
is a grouping key:

1. local: the map-side partial aggregate keeps one row per (digest, salt, text) of a task;
2. salted: rows of one digest are merged in ``salts`` separate groups, so that a text that makes up a third of
   all rows is spread over tasks;
3. global: the salts' winners, at most ``salts`` rows per text, are combined.

Digests that occur once need no text comparison. Texts that share a digest without being equal stay apart:
their rows are matched to the groups by the text.

Edge rows: a row with a null id takes part and never stays while another row of its group has an id; of rows
that repeat the id that stays, one is marked kept. An empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import ascii_lower, broadcast_if, keep_rows, stored

#: Candidate digests up to this many rows (about 40 bytes each) are broadcast; beyond it the join shuffles.
BROADCAST_DIGESTS = 200_000


def sha256(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                 digest: Callable[[Column], Column] = sha256,
                 broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """One row per input row: ``id_col``, ``digest`` (of the normalised text), ``keep_id``, ``group_size``, ``kept``."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    docs = docs.select(F.col(id_col).alias("id"), text.alias("t")).withColumn("digest", digest(F.col("t")))
    keys = stored(docs.select("id", "digest"), "dedup-keys")
    repeated = stored(keys.groupBy("digest").count().where("count > 1").select("digest"), "dedup-digests")
    suspects = docs.join(broadcast_if(repeated, broadcast_digests), "digest")

    salt = F.pmod(F.xxhash64(F.coalesce("id", F.lit(0))), F.lit(salts))
    salted = (suspects.groupBy("digest", salt.alias("salt"), "t")
              .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    groups = salted.groupBy("digest", "t").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    variants = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    groups = stored(groups.withColumn("variants", variants)
                    .withColumn("t", F.when(F.col("variants") > 1, F.col("t"))), "dedup-groups")

    # rows that repeat both id and text: only the first of them may stay
    one = Window.partitionBy("id", "digest").orderBy("digest")
    numbered = keys.withColumn("copy", F.row_number().over(one))
    plain = groups.where("variants = 1").select("digest", "keep_id", "group_size")
    mixed = groups.where("variants > 1")
    out = [numbered.join(plain, "digest", "left").select("id", "digest", "keep_id", "group_size", "copy")]
    if not mixed.isEmpty():
        clash = mixed.select("digest").distinct()
        out[0] = out[0].join(clash, "digest", "left_anti")
        copy = F.row_number().over(Window.partitionBy("id", "digest", "t").orderBy("digest"))
        own = docs.join(clash, "digest", "left_semi").withColumn("copy", copy)
        out.append(own.join(mixed.select("digest", "t", "keep_id", "group_size"), ["digest", "t"])
                   .select("id", "digest", "keep_id", "group_size", "copy"))
    rows = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.coalesce("keep_id", "id")
    return rows.select(F.col("id").alias(id_col), "digest", keep.alias("keep_id"), size.alias("group_size"),
                       (F.col("id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with all their columns; of a row that is repeated whole one stays."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    decisions = exact_groups(docs, id_col, text_col).select(F.col(id_col).alias("id"), "digest", "kept")
    return keep_rows(docs, {"id": F.col(id_col), "digest": sha256(text)}, decisions)
