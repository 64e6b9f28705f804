"""Cross-document line frequency: boilerplate lines by the number of documents of a host that carry them.

Lines are normalised (A-Z lower-cased, white space runs as one space, none at the ends) and hashed. A line is common on a host when
more than ``max_share`` per cent of the host's different documents have it, and more than ``max_documents``; a limit
that follows the host's size gives the same verdicts on a small and a large crawl of it. Exact copies of a document count
once, since removing those is another operator's work. Common lines are removed, and a document of which too little
is left is rejected, as is one that fails the base rules on words and repeated word windows.

Only DataFrame functions are used. Counts are partial aggregates on (host, line), so neither a hot host nor a
hot line meets in one task; the join with the common lines is a broadcast only behind a count of them.

Edge rows: a null text has no words and fails the base rules. A null host is a host of its own. Null and repeated
ids are kept as they are: each row is a document. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WORD, ascii_lower, broadcast_if, stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MAX_DOCUMENTS = 3
MAX_SHARE = 2  # per cent of a host's different documents
MIN_LEFT_SHARE = 30  # per cent of the words
MIN_LEFT_WORDS = 20
#: Common lines up to this many rows (host and hash) are broadcast; beyond it the join shuffles.
BROADCAST_LINES = 200_000


def repeat_positions(hashes: Column, sorted_windows: Column) -> Column:
    """Positions of windows whose hash occurs twice or more; both arguments must be plain columns."""
    same = lambda e, k: F.coalesce(F.get(sorted_windows, k)["h"] == e["h"], F.lit(False))
    marked = F.transform(sorted_windows, lambda e, i: F.when(same(e, i - 1) | same(e, i + 1), e["i"]))
    return F.filter(marked, lambda x: x.isNotNull())


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   with_text: bool = False) -> DataFrame:
    """Per row its base figures, a digest of its text and the hash and words of each line that has a word."""
    t = F.col("t")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumns({
        "words": F.array_remove(F.split(t, SPACE), ""),
        "lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
    })
    n = F.size("words")
    window = F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                         lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    own = F.transform(F.col("lines"), lambda x: F.struct(
        F.xxhash64(F.trim(F.regexp_replace(ascii_lower(x), SPACE, " "))).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    rows = rows.select("row", "id", "host", *(["t"] if with_text else []), F.xxhash64("t").alias("digest"), own.alias("lines"),
                       n.cast("long").alias("n_words"),
                       F.char_length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
                       (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("sorted", F.when(repeated, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    rows = rows.withColumn("at", repeat_positions(F.col("windows"), F.col("sorted")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(i, i + 1, i + 2)))))
    return rows.withColumn("n_repeat_words", covered.cast("long")).drop("windows", "sorted", "at")


def common_lines(lines: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float | None = MAX_SHARE,
                 broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """(host, h) of lines that more than ``max_documents`` different documents of the host have, and more than
    ``max_share`` per cent of its different documents if that is given."""
    own = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    if max_share is not None:  # a null hash counts the host's documents
        own = F.concat(own, F.array(F.lit(None).cast("long")))
    counts = lines.select("host", "digest", F.explode(own).alias("h")).groupBy("host", "h").agg(F.countDistinct("digest").alias("documents"))
    counts = counts.where(F.col("documents") > max_documents)
    if max_share is not None:
        counts = stored(counts, "line-counts")
        hosts = counts.where("h IS NULL").select("host", F.col("documents").alias("of"))
        counts = counts.where("h IS NOT NULL").join(broadcast_if(hosts, broadcast_lines), "host").where(F.col("documents") * 100 > F.col("of") * max_share)
    return counts.select("host", "h")


def line_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   max_documents: int = MAX_DOCUMENTS, min_left_share: int = MIN_LEFT_SHARE,
                   min_left_words: int = MIN_LEFT_WORDS, broadcast_lines: int = BROADCAST_LINES,
                   with_text: bool = False, max_share: float | None = MAX_SHARE) -> DataFrame:
    """One row per document with its base figures, ``n_removed_words`` and ``kept``; ``with_text`` adds the text
    without its common lines. ``max_share`` is in per cent of a host's different documents, ``max_documents`` the least
    count; with no share the limit is ``max_documents`` on every host."""
    lines = stored(document_lines(docs, id_col, text_col, host_col, with_text), "lines")
    common = stored(common_lines(lines, max_documents, max_share, broadcast_lines), "common-lines")
    each = lines.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.n")
    hit = each.join(broadcast_if(common, broadcast_lines), ["host", "h"])
    removed = hit.groupBy("row").agg(F.sum("n").cast("long").alias("removed"), *([F.collect_set("h").alias("gone")] if with_text else []))
    out = lines.join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("removed", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (100 * left < min_left_share * F.col("n_words")) | (left < min_left_words)
    extra = []
    if with_text:
        key = lambda x: F.xxhash64(F.trim(F.regexp_replace(ascii_lower(x), SPACE, " ")))
        clean = F.array_join(F.filter(F.split("t", "\n"), lambda x: ~(x.rlike(WORD) & F.array_contains("gone", key(x)))), "\n")
        extra = [F.when(F.col("gone").isNull(), F.col("t")).otherwise(clean).alias("clean_text")]
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed_words", *extra)
