"""Fill-in-middle transformation by in-place block rotation.

A text is a bytearray of its UTF-8 bytes. One scan finds the bytes at which its two cuts fall (code points are
counted, continuation bytes are not), the sentinels are inserted at the cuts, and the blocks change places by
rotations of three reversals each, which swap bytes from both ends in steps of bounded size. Restoring scans the
output for its sentinels, inverts the rotation and takes the sentinels out: the exact text again, from output and
form alone.

Prefix, middle and suffix follow from the decimal id alone, so reruns agree whatever the partitioning. Rows go
through tasks as they lie; nothing is shuffled.

Edge rows: a null or empty text is plain and its output empty. A null id counts as ''. A text that holds a sentinel
is plain, so a restored text is never ambiguous. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import rows_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes swapped at a time, and bytes scanned at a time.
STEP = 1 << 16


def _reverse(v: np.ndarray, start: int, end: int) -> None:
    """Reverses v[start:end] in place, ``STEP`` bytes from either end at a time."""
    while end - start > 1:
        k = min(STEP, (end - start) // 2)
        left = v[start:start + k].copy()
        v[start:start + k] = v[end - k:end][::-1]
        v[end - k:end] = left[::-1]
        start, end = start + k, end - k


def rotate(buf: bytearray, start: int, mid: int, end: int) -> None:
    """Exchanges the neighbouring blocks [start, mid) and [mid, end) in place."""
    v = np.frombuffer(buf, np.uint8)
    for a, b in ((start, mid), (mid, end), (start, end)):
        _reverse(v, a, b)


def byte_cuts(text: bytes, points: list[int]) -> list[int]:
    """Bytes at which code points ``points`` (ascending; the text's length is allowed) begin."""
    out, seen, at = [], 0, 0
    want = list(points)
    while want:
        block = np.frombuffer(text, np.uint8, min(STEP, len(text) - at), at)
        starts = np.flatnonzero((block & 0xC0) != 0x80)
        while want and want[0] < seen + len(starts):
            out.append(at + int(starts[want.pop(0) - seen]))
        seen, at = seen + len(starts), at + len(block)
        if at >= len(text):
            out += [len(text)] * len(want)
            break
    return out


def transform(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text with its parts in the order of ``form``; cuts are in code points."""
    if form == "plain":
        return text
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    a, b = byte_cuts(text, [first, second])
    buf = bytearray(text)
    buf[b:b] = s
    buf[a:a] = m
    buf[0:0] = p
    a, b = a + len(p), b + len(p) + len(m)  # prefix block [0, a), middle block [a, b), suffix block [b, end)
    rotate(buf, a if form == "psm" else 0, b, len(buf))
    return bytes(buf)


def restore(output: bytes, form: str) -> bytes:
    """The text of an output."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    buf = bytearray(output)
    if form == "psm":  # [prefix][suffix][middle]: the last two change back
        start, mid = buf.index(s), buf.index(m)
    else:  # [suffix][prefix][middle]: the first goes behind the others
        start, mid = 0, buf.index(p)
    size = mid - start
    rotate(buf, start, mid, len(buf))
    b = len(buf) - size
    a = buf.index(m)
    for at, mark in ((b, s), (a, m), (0, p)):
        del buf[at:at + len(mark)]
    return bytes(buf)


def plan(id_col: str, text_col: str, rate: int, spm_rate: int) -> dict[str, Column]:
    """n, form and the two cuts of a row, as columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    n = F.char_length(text).cast("long")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (n == 0) | marked | (h[2] % 100 >= rate)
    cuts = [h[k] % (n + 1) for k in (0, 1)]
    return {"n": n, "form": F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm"),
            "first": F.least(*cuts), "second": F.greatest(*cuts)}


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """Per row: ``id_col``, n, form, prefix_chars and middle_chars (null if plain), output.

    ``rate`` of 100 texts are transformed, ``spm_rate`` of 100 of these with the suffix first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [transform(*row).decode() for row in rows_of([b], "text", "first", "second", "form")]
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.string())], [*b.schema.names[:-1], "output"])

    p = plan(id_col, text_col, rate, spm_rate)
    rows = docs.select(F.col(id_col).alias("id"), *(c.alias(k) for k, c in p.items()),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    done = rows.mapInArrow(run, f"id {kind}, n long, form string, first long, second long, output string")
    cut = F.col("form") != "plain"
    return done.select(F.col("id").alias(id_col), "n", "form", F.when(cut, F.col("first")).alias("prefix_chars"),
                       F.when(cut, F.col("second") - F.col("first")).alias("middle_chars"), "output")


def restore_texts(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """The rows with their exact text as ``restored``, rebuilt from output and form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [restore(o.encode(), f).decode() for o, f in rows_of([b], output_col, form_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, "restored"])

    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, restored string")
