"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import ensure_checkpoint_dir, scratch_path, ship_package

#: The words of every contract: runs of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch that the pipeline's stages send to a task's Python worker; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Shared folder, worker-side package and the session's bound on Arrow batches, for callers outside the entry module."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts the lineage, so a lost
    executor costs no recomputation, and a table that is used twice is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` does the same for pure ASCII, and faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def training_row(id_col: str, modulus: int) -> Column:
    """The contracts' fold: crc32 of the id as text is not divisible by ``modulus`` (null id: as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus != 0


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint behind a count of a stored table; beyond the bound the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def keep_rows(docs: DataFrame, keys: dict[str, Column], decisions: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keeps, with all their columns.

    ``keys`` are expressions on ``docs`` that the columns of the same names in ``decisions`` hold, one row there per
    row here, and ``kept``. Keys with no kept row go; of a key with several rows as many stay as were kept. Only
    keys that lose rows are matched, by broadcast behind a count or else by a shuffle."""
    short = stored(decisions.groupBy(*keys).agg(F.sum(F.col("kept").cast("long")).alias("stay"), F.count(F.lit(1)).alias("all"))
                   .where("stay < all"), "keep-rows").toDF(*(f"r_{k}" for k in keys), "stay", "all")
    rows = renamed(docs, **{f"l_{k}": c for k, c in keys.items()})
    same = lambda: _all([F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys])
    out = rows.join(broadcast_if(short, broadcast_rows), same(), "left_anti")
    part = short.where("stay > 0")
    if not part.isEmpty():
        number = F.row_number().over(Window.partitionBy(*(f"l_{k}" for k in keys)).orderBy(F.lit(0)))
        some = rows.join(part, same()).withColumn("number", number).where("number <= stay")
        out = out.unionByName(some.select(*out.columns))
    return named_again(out, docs)


def renamed(docs: DataFrame, **extra: Column) -> DataFrame:
    """The table with its columns as c0, c1 and so on, so that no name can clash with the ``extra`` columns added."""
    return docs.select(*(docs[f"`{c.replace('`', '``')}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)),
                       *(c.alias(k) for k, c in extra.items()))


def named_again(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``renamed`` rows under the names they had."""
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time, as tuples of Python values."""
    for b in batches:
        cols = [b.column(b.schema.get_field_index(n)) for n in names]
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in cols)
