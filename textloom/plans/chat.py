"""Instruction rows to masked chat batches, and documents to warm-up batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import chat_full, chat_prompt, coerce_text, normalize_text
from textloom.functions.tokens import truncate
from textloom.operators.collate import assign_batches, collate_chat, collate_warmup
from textloom.operators.encoders import BYTES, Encoder
from textloom.operators.order import take_rows

# Chat batches of 4 rows capped at 1,024 tokens; warm-up batches of
# 8 rows capped at 100 tokens.
CHAT_BATCH = 4
CHAT_MAX_LEN = 1024
WARMUP_BATCH = 8
WARMUP_MAX_LEN = 100


def chat_text(instr: DataFrame) -> DataFrame:
    """P2 + P3 + P4: normalised parts, incomplete rows dropped, prompt and full text."""
    n = instr.select("*", normalize_text("system_prompt").alias("_s"), normalize_text("question").alias("_q"),
                     normalize_text("response").alias("_r"))
    n = n.where((F.col("_q") != "") & (F.col("_r") != ""))
    prompt = chat_prompt(F.col("_s"), F.col("_q"))
    return n.withColumn("prompt_text", prompt).withColumn("full_text", chat_full(prompt, F.col("_r"))) \
        .drop("_s", "_q", "_r")


def sft_examples(instr: DataFrame, max_len: int = CHAT_MAX_LEN, encoder: Encoder = BYTES) -> DataFrame:
    """Prompt and full text encoded apart and truncated; rows with fewer than
    two ids or no response token left are dropped."""
    t = chat_text(instr)
    t = encoder.with_ids(t, _p=F.col("prompt_text"), ids=F.col("full_text"))
    t = t.withColumn("_p", truncate("_p", max_len)).withColumn("ids", truncate("ids", max_len))
    t = t.withColumn("prompt_len", F.least(F.size("_p"), F.size("ids")))
    return t.where((F.size("ids") >= 2) & (F.col("prompt_len") < F.size("ids"))).drop("_p")


def take_valid_rows(examples: DataFrame, order_cols, n: int | None, worker_col: str | None = None) -> DataFrame:
    """First n rows after all drops (all when n is None), a top-k and no numbering. With
    ``worker_col`` the cap holds for each worker: up to n rows of every worker's share, which
    Spark cuts to n before the shuffle."""
    if n is None or worker_col is None:
        return take_rows(examples, order_cols, n)
    first = F.row_number().over(Window.partitionBy(worker_col).orderBy(*order_cols))
    return examples.withColumn("_n", first).where(F.col("_n") <= int(n)).drop("_n")


def chat_batches(instr: DataFrame, batch_size: int = CHAT_BATCH, max_len: int = CHAT_MAX_LEN,
                 max_rows: int | None = None, order_cols=("conv_id", "turn"), encoder: Encoder = BYTES) -> DataFrame:
    ex = take_valid_rows(sft_examples(instr, max_len, encoder), list(order_cols), max_rows)
    b = assign_batches(ex, list(order_cols), batch_size)
    return collate_chat(b, max_len, encoder.eot, encoder.pad)


def warmup_ids(docs: DataFrame, max_len: int = WARMUP_MAX_LEN, encoder: Encoder = BYTES) -> DataFrame:
    """P1 + T4 + T8: text coerced (no strip), encoded, first ``max_len`` ids."""
    ids = encoder.with_ids(docs.select(*[c for c in docs.columns if c != "text"], coerce_text("text").alias("text")),
                           ids=F.col("text"))
    return ids.withColumn("ids", truncate("ids", max_len)).drop("text")


def warmup_batches(docs: DataFrame, batch_size: int = WARMUP_BATCH, max_len: int = WARMUP_MAX_LEN,
                   max_rows: int | None = None, order_cols=("doc_id",), encoder: Encoder = BYTES) -> DataFrame:
    """P5 (cap on raw rows, before encoding) + B1 + B3-B6 with pad = EOS."""
    if max_rows is not None:
        docs = take_rows(docs, order_cols, max_rows)
    b = assign_batches(warmup_ids(docs, max_len, encoder), list(order_cols), batch_size)
    return collate_warmup(b, max_len, encoder.eot)
