"""Vector bin packing of training examples into sequences under several limits at once.

An example has a length in tokens, counts as one segment, and bears the loss on some of its tokens; a sequence
has a limit on each of the three. Examples are cut into whole sequences while they are longer than one; what
remains is placed by the dot-product heuristic: the open sequence takes the piece whose demand, weighted by the
demand of all waiting pieces, has the largest product with the room that is left. When nothing fits, a waiting
piece is cut to fill the room, unless less than ``min_cut`` tokens are left.

Packing is local to a task: no shuffle, and no group of documents is gathered. A task keeps at most ``pool``
waiting pieces, each shorter than a sequence, and ends at most one sequence before it is full.
Sequence ids are the task's number in the upper bits and a counter in the lower ones; a retried task makes the
same ones.

Edge rows: a null text is empty, and an empty text is the end id alone. So are null ids; a loss mask of another length
than its ids is an error. Null and repeated ids are kept as they
are, each row is an example. An empty table gives no sequence. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import rows_of

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long")
POOL = 8192
FLUSH = 20_000


@lru_cache(maxsize=4)
def encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """text -> ids of the vocabulary in ``json_path``.

    Texts within Latin script (code points up to U+024F) go through the same vocabulary's ranks, which give the
    same ids several times faster; all others, and every text without a ranks file, through the file itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(json_path)
    whole = lambda text: full.encode(text, add_special_tokens=False).ids
    if not ranks_path:
        return whole
    import base64

    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    special = {t.content: i for i, t in full.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: fast.encode(text, allowed_special="all") if max(text, default="") <= "ɏ" else whole(text)


class Waiting:
    """Waiting pieces by class (length, loss tokens), for the dot-product choice."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, float)
        self.known: dict[tuple[int, int], int] = {}
        self.stacks: list[list] = []
        self.demand = np.zeros((64, 3))
        self.count = np.zeros(64, np.int64)
        self.pieces = self.tokens = 0
        self.total = np.zeros(3)

    def add(self, piece: tuple, length: int, loss: int) -> None:
        k = self.known.get((length, loss))
        if k is None:
            k = self.known[length, loss] = len(self.stacks)
            self.stacks.append([])
            if k == len(self.count):
                self.demand = np.vstack([self.demand, np.zeros_like(self.demand)])
                self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.demand[k] = length, 1, loss
        self.stacks[k].append(piece)
        self.count[k] += 1
        self.pieces += 1
        self.tokens += length
        self.total += self.demand[k]

    def take(self, k: int) -> tuple:
        self.count[k] -= 1
        self.pieces -= 1
        self.tokens -= int(self.demand[k, 0])
        self.total -= self.demand[k]
        return self.stacks[k].pop()

    def best(self, room: np.ndarray) -> int | None:
        """The class that fits into ``room`` with the largest weighted dot product."""
        fits = (self.count > 0) & (self.demand <= room).all(axis=1)
        if not fits.any():
            return None
        weight = self.total / self.limits ** 3
        return int(np.argmax(np.where(fits, self.demand @ (weight * room), -1.0)))

    def longest(self) -> int:
        return int(np.argmax(np.where(self.count > 0, self.demand[:, 0], -1)))


def fill(waiting: Waiting, min_cut: int) -> list[tuple]:
    """Pieces of one sequence, in order. A piece: (document row, first id, ids, loss mask)."""
    room, out = waiting.limits.copy(), []
    while waiting.pieces:
        k = waiting.best(room)
        if k is not None:
            piece = waiting.take(k)
        else:
            cut = int(room[0])
            if cut < min_cut or room[1] < 1 or (waiting.demand[waiting.count > 0, 0] <= cut).all():
                break
            row, start, ids, loss = waiting.take(waiting.longest())
            if loss[:cut].sum() > room[2]:
                cut = int(np.searchsorted(np.cumsum(loss), room[2], side="right"))
            if cut < min_cut:
                waiting.add((row, start, ids, loss), len(ids), int(loss.sum()))
                break
            piece = (row, start, ids[:cut], loss[:cut])
            waiting.add((row, start + cut, ids[cut:], loss[cut:]), len(ids) - cut, int(loss[cut:].sum()))
        out.append(piece)
        room -= (len(piece[2]), 1, int(piece[3].sum()))
    return out


def pack(examples: Iterator[tuple], limits: tuple[int, int, int], min_cut: int, pool: int) -> Iterator[list[tuple]]:
    """Sequences, as lists of pieces, of examples (row, ids, loss mask)."""
    max_tokens, _, max_loss = limits
    waiting = Waiting(limits)
    for row, ids, loss in examples:
        at = 0
        while len(ids) - at > max_tokens or loss[at:].sum() > max_loss:
            end = min(len(ids), at + max_tokens)
            if loss[at:end].sum() > max_loss:
                end = at + int(np.searchsorted(np.cumsum(loss[at:end]), max_loss, side="right"))
            if end - at == max_tokens:
                yield [(row, at, ids[at:end], loss[at:end])]
            else:
                waiting.add((row, at, ids[at:end], loss[at:end]), end - at, int(loss[at:end].sum()))
            at = end
        if at < len(ids):
            waiting.add((row, at, ids[at:], loss[at:]), len(ids) - at, int(loss[at:].sum()))
        if waiting.pieces >= pool:
            while waiting.tokens >= 2 * max_tokens and waiting.pieces > pool // 8:
                yield fill(waiting, min_cut)
    while waiting.pieces:
        yield fill(waiting, min_cut)


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
                   end_id: int = 0, max_tokens: int = 1024, max_segments: int = 64, max_loss: int = 1024,
                   min_cut: int = 16, pool: int = POOL, with_ids: bool = False, ids_col: str | None = None,
                   loss_col: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per piece of every document: its ids followed by ``end_id``, which bears no loss.

    ``ids_col`` takes ids that are made already, as those of ``chat_tokens``, in place of the text, and ``loss_col``
    their loss mask (null or none: every id bears the loss). ``with_ids`` adds the piece's ids, the packed output itself."""
    if loss_col and not ids_col:
        raise ValueError("a loss mask needs ids")
    limits = (max_tokens, max_segments, max_loss)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    types = [pa.int64()] * 8 + [pa.list_(pa.int32())] * with_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None if ids_col else encoder(json_path, ranks_path, pattern)
        sequence = TaskContext.get().partitionId() << 40

        def examples():
            for doc_id, text, mask in rows_of(batches, "doc_id", "text", "loss"):
                ids = np.array([*(encode(text) if encode else text), end_id], np.uint32)
                loss = np.ones(len(ids), np.uint8)
                loss[-1] = 0
                if mask is not None:
                    if len(mask) != len(ids) - 1:
                        raise ValueError(f"example {doc_id}: {len(ids) - 1} ids and a loss mask of {len(mask)}")
                    loss[:-1] = np.array(mask, np.int64) != 0
                yield (doc_id, len(ids)), ids, loss

        rows = []
        for pieces in pack(examples(), limits, min_cut, pool):
            offset = 0
            for (doc_id, n), start, ids, loss in pieces:
                row = (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, sequence, offset, int(loss.sum()))
                rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                offset += len(ids)
            sequence += 1
            if len(rows) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    none = F.array().cast("array<int>")
    text = F.coalesce(F.col(ids_col).cast("array<int>"), none) if ids_col else F.coalesce("text", F.lit(""))
    loss = F.col(loss_col).cast("array<int>") if loss_col else F.lit(None).cast("array<int>")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), loss.alias("loss")).mapInArrow(run, schema)
