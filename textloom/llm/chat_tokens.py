"""Chat formatting at the level of tokens.

Every segment (a role name, a text) is encoded on its own and the template's control strings are spliced in as
reserved ids, so no token spans a border and no text can produce a control id. Control strings that occur in
texts are escaped besides, so that the rendered string is safe as well: a backslash is doubled, and a backslash
and a hyphen go behind the first character of every control string. The loss mask of a turn is a prefix sum
over +1 where a segment with loss begins and -1 where it ends.

Encoding is per row. A conversation is a run of turn rows in order, with the position of each row's first
token, so that a conversation of any length is no single value. Rows are dealt into ranges of conversation, turn, role and
the first characters of the text, so that a conversation that holds most rows is spread over tasks; each task sorts its
range by whole texts, encodes it and keeps running totals. What the conversation at the head of a range has in earlier
ranges is added afterwards, from two sums a range. Only rows with one conversation, turn, role and beginning of the text
meet in a task, and the digest of a conversation, which can't be combined from parts.

Edge rows: a null text or role is empty. Turns are ordered by turn, role and text, null turns first. Rows with a
null conversation id are one conversation. Repeated rows are turns of their own. An empty table gives no turn.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import rows_of, stored
from textloom.llm.packing import encoder

#: Control strings of the template, in the order of their reserved ids.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")
BEGIN, END, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, TEXT, TURN_END = range(len(CONTROLS))
#: Strings that mean an id of the vocabulary itself.
VOCABULARY_CONTROLS = ("<|endoftext|>",)
LOSS_ROLE = "assistant"

TURNS = "conv_id long, turn_index long, token_start long, ids array<int>, loss_mask array<int>"
#: Rows of a range: turns of the conversation at its head and others with their place in this range, and the sums of its
#: first and last conversation. The first sums sort before the last ones.
PLACED = "part long, kind int, conv_id long, n long, at long, ids array<int>, loss_mask array<int>"
HEAD_SUMS, LAST_SUMS, HEAD_TURN, OTHER_TURN = range(4)
#: Characters of a role and a text that range keys hold.
KEY_CHARS = 64


@lru_cache(maxsize=8)
def _pattern(controls: tuple[str, ...]) -> re.Pattern:
    return re.compile("(?=(?:" + "|".join(map(re.escape, controls)) + "))(.)", re.DOTALL)


def escape(text: str, controls: tuple[str, ...] = CONTROLS + VOCABULARY_CONTROLS) -> str:
    return _pattern(controls).sub(r"\1\\-", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\([\\-])", lambda m: "" if m[1] == "-" else "\\", text)


def assemble(segments: list[tuple[list[int], bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of (ids, bears loss) segments."""
    ends = np.cumsum([len(ids) for ids, _ in segments])
    step = np.zeros(int(ends[-1]) + 1, np.int32)
    for (ids, loss), end in zip(segments, ends):
        if loss:
            step[end - len(ids)] += 1
            step[end] -= 1
    return np.concatenate([np.asarray(ids, np.int32) for ids, _ in segments]), np.cumsum(step)[:-1].astype(np.int32)


def _segments(role: str, text: str, encode, first: int) -> list[tuple[list[int], bool]]:
    body = (encode(escape(text)), role == LOSS_ROLE)
    mark = lambda k: ([first + k], False)
    if role == "user":
        return [mark(USER), body, mark(USER_END)]
    if role == "system":
        return [mark(SYSTEM), body, mark(SYSTEM_END)]
    if role == LOSS_ROLE:
        return [body, mark(END)]
    return [mark(ROLE), (encode(escape(role)), False), mark(TEXT), body, mark(TURN_END)]


def _ranges(rows: DataFrame) -> DataFrame:
    """Rows in order, dealt by ranges. The keys that Spark samples for the ranges are short: a long role is cut, and texts
    behind it don't split a range."""
    short = F.char_length("role") < KEY_CHARS
    return rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, KEY_CHARS), F.when(short, F.substring("text", 1, KEY_CHARS))) \
        .sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(rows: DataFrame, tokenizer: tuple[str, str | None, str | None], first_reserved: int) -> DataFrame:
    """Rows (conv_id, turn, role, text) as ``TURNS``: each turn's ids and loss mask, and where they begin. The turns are
    written once to the shared folder."""

    def encode_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        part, now, index, at, head = None, None, 0, 0, True
        for b in batches:
            out = []
            for own, conv_id, role, text in rows_of([b], "part", "conv_id", "role", "text"):
                if part is None:
                    part, now = own, conv_id
                elif conv_id != now:
                    if head:
                        out.append((part, HEAD_SUMS, now, index, at, None, None))
                    now, index, at, head = conv_id, 0, 0, False
                ids, mask = assemble(_segments(role, text, encode, first_reserved))
                out.append((part, HEAD_TURN if head else OTHER_TURN, conv_id, index, at, ids, mask))
                index, at = index + 1, at + len(ids)
            if out:
                yield _placed(out)
        if part is not None:
            yield _placed([(part, k, now, index, at, None, None) for k in ((HEAD_SUMS, LAST_SUMS) if head else (LAST_SUMS,))])

    flat = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = _ranges(flat).select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "role", "text")
    placed = stored(ordered.mapInArrow(encode_in_order, PLACED), "chat-turns")
    # at most two rows a range: what a conversation has in the ranges before the one it heads
    sums = placed.where(F.col("kind").isin(HEAD_SUMS, LAST_SUMS)).select("part", "kind", "conv_id", "n", "at")
    before = Window.partitionBy("conv_id").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    last = F.col("kind") == LAST_SUMS
    carried = sums.select("part", "kind", *(F.coalesce(F.sum(F.when(last, F.col(c))).over(before), F.lit(0)).alias(f"before_{c}") for c in ("n", "at")))
    carried = carried.where(F.col("kind") == HEAD_SUMS).select("part", F.lit(HEAD_TURN).alias("kind"), "before_n", "before_at")
    turns = placed.where(F.col("kind").isin(HEAD_TURN, OTHER_TURN)).join(F.broadcast(carried), ["part", "kind"], "left")
    index, at = (F.col(c) + F.coalesce(f"before_{c}", F.lit(0)) for c in ("n", "at"))
    begins = lambda first, c: F.when(index == 0, F.concat(F.array(F.lit(first)), c)).otherwise(F.col(c))
    return turns.select("conv_id", index.alias("turn_index"), F.when(index == 0, at).otherwise(at + 1).alias("token_start"),
                        begins(first_reserved + BEGIN, "ids").alias("ids"), begins(0, "loss_mask").alias("loss_mask"))


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, *[pa.list_(pa.int32())] * 2]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in PLACED.split(", ")])


def parse(ids: np.ndarray, mask: np.ndarray, decode, first: int) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, characters of the rendered turn) of one turn's ids."""
    marks = np.flatnonzero(ids >= first).tolist()
    chars = sum(len(CONTROLS[ids[i] - first]) for i in marks)
    inner = [i for i in marks if ids[i] - first != BEGIN]
    starts = [i + 1 for i in marks]
    kinds = [ids[i] - first for i in inner]

    def between(lo: int, hi: int) -> str:
        nonlocal chars
        text = decode(ids[lo:hi].tolist())
        chars += len(text)
        return unescape(text)

    if kinds == [USER, USER_END] or kinds == [SYSTEM, SYSTEM_END]:
        role, lo, hi = "user" if kinds[0] == USER else "system", inner[0] + 1, inner[1]
    elif kinds == [END]:
        role, lo, hi = LOSS_ROLE, starts[0] if marks[0] != inner[0] else 0, inner[0]
    elif kinds == [ROLE, TEXT, TURN_END]:
        role, lo, hi = between(inner[0] + 1, inner[1]), inner[1] + 1, inner[2]
    else:
        raise ValueError(f"not a turn: marks {kinds}")
    text = between(lo, hi)
    return role, text, unescape(decode(ids[mask > 0].tolist())), chars


def _values(ids: pa.ListScalar) -> np.ndarray:
    return ids.values.to_numpy()


def read_turns(turns: DataFrame, tokenizer: tuple[str, str | None, str | None], first_reserved: int) -> DataFrame:
    """Formatted turns back as (conv_id, turn_index, role, text, loss_text, formatted_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(tokenizer[0])
        for b in batches:
            pairs = zip(*(map(_values, b.column(b.schema.get_field_index(c))) for c in ("ids", "loss_mask")))
            out = [parse(ids, mask, decode, first_reserved) for ids, mask in pairs]
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, pa.string()) for x in c[:3]), pa.array(c[3], pa.int64())],
                                                 ["conv_id", "turn_index", "role", "text", "loss_text", "formatted_chars"])

    return turns.select("conv_id", "turn_index", "ids", "loss_mask").mapInArrow(
        run, "conv_id long, turn_index long, role string, text string, loss_text string, formatted_chars long")


@lru_cache(maxsize=4)
def decoder(json_path: str):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(json_path)
    return lambda ids: full.decode(ids, skip_special_tokens=False)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``read_turns`` rows: turns, digest of all turns, characters and digest of the loss text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []

        def close():
            n, turns_sha, loss_chars, loss_sha, chars = state
            out.append((now, n, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars))

        for conv_id, role, text, loss, chars in rows_of(batches, "conv_id", "role", "text", "loss_text", "formatted_chars"):
            if state is None or conv_id != now:
                if state is not None:
                    close()
                now, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += chars
            if len(out) >= 10_000:
                yield _batch(out)
                out.clear()
        if state is not None:
            close()
            yield _batch(out)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_index")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
