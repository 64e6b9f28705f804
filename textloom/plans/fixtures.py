"""Inputs of the reference's flows built from the driver's tables.

- corpus: ``documents`` with split ``val`` when ``doc_id % 20 = 0``, else ``train``;
- instructions: ``conversations``, each user turn with the next assistant turn;
- choice items: ``benchmark`` cut in halves, four endings per item;
- logits: ``embeddings`` as 64 logits with ``label`` as target;
- byte losses: a unigram byte model from ``documents`` standing in for a network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.text import coerce_text
from textloom.operators.order import row_index
from textloom.session import written_once
from textloom.sources.io import read_table

VAL_EVERY = 20
N_ENDINGS = 4


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1 + P9: (split, doc_id, text)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    split = F.when(F.pmod(F.col("doc_id"), F.lit(VAL_EVERY)) == 0, F.lit("val")).otherwise(F.lit("train"))
    return d.select(split.alias("split"), F.col("doc_id").cast("long").alias("doc_id"),
                    coerce_text("text").alias("text"))


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows (conv_id, turn, system_prompt, question, response).

    One row per user turn; the response is the next turn's text when that turn
    is the assistant's, else null. The system prompt is the conversation's system
    turn (null if none). Turns are numbered densely within their conversation, which
    takes gaps and repeated turn numbers, and the next turn is an equi-join on
    (conv_id, number + 1), a key unique per row, so a conversation holding a large share
    of all turns is spread over many tasks."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c = written_once(row_index(c, ["turn"], ["conv_id"], out="_n"), "turns")
    nxt = c.select("conv_id", (F.col("_n") - 1).alias("_n"), F.col("role").alias("next_role"),
                   F.col("text").alias("next_text"))
    t = c.join(nxt, ["conv_id", "_n"], "left")
    users = t.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"),
        F.when(F.col("next_role") == "assistant", F.col("next_text")).alias("response"))
    system = c.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("system_prompt"))
    return users.join(system, "conv_id", "left").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "system_prompt", "question", "response")


def choice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiple-choice items (item, ctx, label, endings[4]).

    Words are cut at single spaces; ctx is the first ``n div 2`` words; the own
    ending (second half) sits at ``label = item % 4``; ending e is the second half
    of item ``(item + e - label) mod count``. The other halves are fetched with an
    equi-join on that item id, so no item is broadcast."""
    b = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item"), "text")
    words = F.split(F.col("text"), " ")
    half = (F.size(words) / 2).cast("int")
    halves = b.select("item", F.array_join(F.slice(words, 1, half), " ").alias("ctx"),
                      F.array_join(F.slice(words, half + 1, F.size(words)), " ").alias("tail"))
    count = halves.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    lab = F.pmod(F.col("item"), F.lit(N_ENDINGS)).cast("int")
    want = halves.select("item", "ctx", lab.alias("label"),
                         F.explode(F.sequence(F.lit(0), F.lit(N_ENDINGS - 1))).alias("ending"))
    want = want.withColumn("src", F.pmod(F.col("item") + F.col("ending") - F.col("label"), F.lit(count)))
    tails = halves.select(F.col("item").alias("src"), "tail")
    j = want.join(tails, "src")
    return j.groupBy("item", "ctx", "label").agg(
        F.sort_array(F.collect_list(F.struct("ending", "tail"))).alias("e")) \
        .select("item", "ctx", "label", F.transform("e", lambda s: s["tail"]).alias("endings"))


def logits_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, logits array<double>, target int) from ``embeddings``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("long").alias("row_id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("logits"),
                    F.col("label").cast("int").alias("target"))


def byte_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(token int, loss double) for every id of the byte encoder:
    ``-ln((count(b) + 1) / (total + 256))`` over the UTF-8 bytes of all documents
    (special ids have count 0). Counted with a map-side partial aggregate, so at
    most 256 rows per task leave the map side."""
    from textloom.functions.tokens import BYTE_VOCAB_SIZE

    d = read_table(spark, sf_dir, "documents").select(coerce_text("text").alias("text"))
    # one Latin-1 character per UTF-8 byte; counted as characters (a native generator
    # and a partial aggregate) and turned into byte values on the <= 256 result rows
    chars = F.split(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"), "")
    counts = d.select(F.explode(chars).alias("ch")).where(F.col("ch") != "").groupBy("ch").agg(
        F.count(F.lit(1)).alias("n")).select(F.ascii("ch").cast("int").alias("token"), "n")
    ids = spark.range(BYTE_VOCAB_SIZE).select(F.col("id").cast("int").alias("token"))
    c = ids.join(counts, "token", "left").fillna(0, ["n"])
    w = Window.partitionBy(F.lit(0))  # 266 rows: the total over one small task
    tot = F.sum("n").over(w)
    return c.select("token", (-F.ln((F.col("n") + 1) / (tot + 256))).alias("loss"))
