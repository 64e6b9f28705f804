"""Training-data pipeline over ``documents``: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes what its predecessor kept, written as Parquet and read again; all but the last return rows with
the columns of ``documents``. Null and empty texts are rejected by the first stage; every stage takes them, ties,
repeated rows, empty tables and extra columns without failing, as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import crf, exact_dedup, mixing, packing, simhash
from textloom.llm.common import prepare, stored, table, training_row

#: A document stays if its text has letters and one language has this share of its words.
MIN_LANGUAGE_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in which no language has a clear share."""
    prepare(spark)
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))  # no name can clash with the predictions'
    at = {n: f"c{i}" for i, n in enumerate(names)}
    model = crf.train(docs.where(training_row("doc_id", 5)))
    out = crf.predict(plain, model, at["doc_id"], at["text"], keep=tuple(plain.columns), id_out="id")
    kept = out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SHARE))
    return kept.select(*(F.col(at[n]).alias(n) for n in names))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, letters A-Z in either case, stays: that with the largest id."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: that with the smallest id."""
    prepare(spark)
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture reads them; those it doesn't read go."""
    prepare(spark)
    return mixing.mixed_rows(docs, F.array("source"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, as packed for training."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("source_mixing", mix_sources), ("vector_packing", pack_sequences)]

#: The first and last stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = stored(out, f"pipeline-{name}") if k < len(STAGES) - 1 else out
    return docs
