"""Function-extension surface (U1-U3): the user's own encoder, document map and
collate function, run in Arrow batches on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ENCODERS: dict = {}

#: Characters of text that a user function gets at a time, and rows of tables without text columns. A single longer
#: text is a batch of its own; what Spark sends at once (10,000 rows) may be many times this.
BATCH_CHARS = 1 << 19
BATCH_ROWS = 256


def small_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in the same order in frames of at most ``BATCH_ROWS`` rows and about ``BATCH_CHARS`` characters, so
    that a worker's memory depends on these and not on how many rows Spark puts into a batch."""
    for pdf in batches:
        strings = [c for c in pdf.columns if pdf[c].dtype.kind not in "biufcmM"]
        at = 0
        while at < len(pdf):
            part = pdf.iloc[at:at + BATCH_ROWS]
            chars = sum((part[c].map(lambda v: len(v) if isinstance(v, str | bytes) else 0) for c in strings),
                        pd.Series(0, part.index)).cumsum()
            n = max(1, int((chars <= BATCH_CHARS).sum()))
            yield part.iloc[:n].reset_index(drop=True)
            at += n


def with_encoder(df: DataFrame, factory: Callable[[], Callable[[list[str]], list[list[int]]]],
                 text_col: str = "text", out: str = "ids", keep=("doc_id",)) -> DataFrame:
    """The user's tokenizer over rows. ``factory`` builds the encoder once per
    Python worker (cached by the factory); the encoder maps a list of texts to a
    list of id lists."""
    keep = list(keep)

    def run(batches):
        enc = _ENCODERS.get(factory)
        if enc is None:
            enc = _ENCODERS[factory] = factory()
        for pdf in small_batches(batches):
            texts = pdf[text_col].fillna("").astype(str).tolist()
            res = pdf[keep].copy()
            res[out] = enc(texts)
            yield res

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]
                       + [f"{out} array<int>"])
    return df.select(*keep, F.col(text_col)).mapInPandas(run, schema)


def map_documents(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user function over documents in parallel, in the batches of ``small_batches``; order is by
    the key column of the result, not by file order."""
    def run(batches):
        for pdf in small_batches(batches):
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def collate(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
            batch_col: str = "batch_id") -> DataFrame:
    """The user's batch function, one call per batch (a bounded group)."""
    return df.groupBy(batch_col).applyInPandas(fn, schema)
