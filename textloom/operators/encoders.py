"""The encoder as a parameter of the flows.

An encoder adds id columns to a table (``with_ids``), all other columns kept, in Arrow
batches: bytes, words of a given vocabulary, byte-level BPE with given merges, or the
user's own function. It names the ids of its delimiter (``eot``) and padding (``pad``).
Nothing is shuffled: what an encoder looks up (vocabulary, merges) is bounded by
``MAX_TABLE`` rows, checked, and sent to every task once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.tokens import EOT, PAD, SPECIAL_TOKENS, byte_encode_length, byte_special_ids, prepend

MAX_TABLE = 1 << 20  # rows of a vocabulary or merges table
ROWS_AT_A_TIME = 256  # whole texts encoded before their ids leave the worker
IDS = T.ArrayType(T.IntegerType())

def bounded_rows(table: DataFrame, *cols: str) -> list:
    """Rows of a lookup table in one fetch; an error when it is larger than a vocabulary."""
    rows = table.select(*cols).limit(MAX_TABLE + 1).collect()
    if len(rows) > MAX_TABLE:
        raise ValueError("lookup table larger than a vocabulary")
    return rows


class Specials:
    """Special tokens and their ids: those of a table as ``special_tokens`` or ``read_tokenizer_folder`` give it (token, id,
    roles), or of a dict. The delimiter is the token with the role eos, else <|endoftext|>; padding the one with the
    role pad, else the delimiter."""

    def __init__(self, tokens: DataFrame | dict[str, int]):
        from textloom.operators.vocab import trie_pattern

        rows = [(t, i, ()) for t, i in tokens.items()] if isinstance(tokens, dict) else [
            (r["token"], r["id"], r["roles"]) for r in bounded_rows(tokens, "token", "id", "roles")]
        self.ids = {t: int(i) for t, i, _ in rows}
        role = {name: i for _, i, roles in rows for name in roles or ()}
        self.eot = role.get("eos", self.ids.get("<|endoftext|>"))
        self.pad = role.get("pad", self.ids.get("<|pad|>", self.eot))
        self.pattern = trie_pattern(self.ids)


class Encoder:
    """``arrays`` maps an Arrow array of texts (or of what ``prepare`` makes of a text) to
    an Arrow array of id lists; a null text gives an empty list. Ids outside [0, ``vocab_size``) are an error (T7),
    looked for once per Arrow batch."""

    eot: int
    pad: int
    vocab_size: int = 65536

    def prepare(self, text: Column) -> Column:
        return F.coalesce(text.cast("string"), F.lit(""))

    def encode(self) -> Callable[[pa.Array], pa.Array]:
        raise NotImplementedError

    def length(self, text: str) -> Column | None:
        """Number of ids without encoding, if the encoder knows it."""
        return None

    def with_ids(self, df: DataFrame, **texts: Column) -> DataFrame:
        """``df`` with one id array per named text."""
        schema = T.StructType(df.schema.fields + [T.StructField(n, IDS) for n in texts])
        source = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)],
                           *[self.prepare(c).alias(f"text{i}") for i, c in enumerate(texts.values())])
        return source.mapInArrow(self._batches(len(df.columns), df.columns + list(texts)), schema)

    def _batches(self, kept: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """What runs in a task: the first ``kept`` columns as they are, id lists of the others."""
        made, hi = self.encode, self.vocab_size

        def checked(ids: pa.Array) -> pa.Array:
            ends = pc.min_max(ids.values).as_py()
            if ends["min"] is not None and (ends["min"] < 0 or ends["max"] >= hi):
                raise ValueError(f"token id outside [0, {hi})")
            return ids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrays = made()
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS_AT_A_TIME):
                    b = whole.slice(at, ROWS_AT_A_TIME)
                    ids = [checked(arrays(c)) for c in b.columns[kept:]]
                    yield pa.RecordBatch.from_arrays(b.columns[:kept] + ids, names=names)

        return run

    def with_places(self, df: DataFrame, text: str, group: str) -> DataFrame:
        """(group, before, n, ids) of a table whose rows are in order within its partitions, those of a group in a row:
        ids with the delimiter first, their number, and the ids of the rows of its group ahead of it in its partition. All
        of it in the one pass that encodes."""
        encoded, eot = self._batches(1, [group, "ids"]), self.eot
        schema = T.StructType([df.schema[group], T.StructField("before", T.LongType()), T.StructField("n", T.LongType()),
                               T.StructField("ids", IDS)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = object(), 0  # a group that no row is in
            for b in encoded(batches):
                n = (pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False) + 1).tolist()
                before = []
                for g, k in zip(b.column(0).to_pylist(), n):
                    if g != own:
                        own, total = g, 0
                    before.append(total)
                    total += k
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(before, pa.int64()), pa.array(n, pa.int64()), b.column(1)], names=schema.names)

        placed = df.select(group, self.prepare(F.col(text)).alias("text")).mapInArrow(run, schema)
        return placed.withColumn("ids", prepend("ids", eot))


def id_lists(lists) -> pa.Array:
    """Arrow id lists from numpy or Python lists."""
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def utf8_ids(texts: pa.Array) -> pa.Array:
    """Byte values of texts: the buffer of the texts, widened."""
    b = texts.cast(pa.binary())
    offsets = np.frombuffer(b.buffers()[1], np.int32)[b.offset:b.offset + len(b) + 1] if len(b) else np.zeros(1, np.int32)
    data = b.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(values.astype(np.int32)))


class ByteEncoder(Encoder):
    """UTF-8 bytes; special tokens from 256, or those of ``specials`` with their own ids."""

    eot, pad = EOT, PAD

    def __init__(self, specials: DataFrame | dict[str, int] | None = None):
        self.specials = None
        if specials is not None:
            self.specials = Specials(specials)
            self.eot, self.pad = self.specials.eot, self.specials.pad

    def length(self, text: str) -> Column:
        if self.specials is None:
            return byte_encode_length(text)
        pattern = F.lit(self.specials.pattern)
        t = F.coalesce(F.col(text).cast("string"), F.lit(""))
        return F.octet_length(F.regexp_replace(t, pattern, F.lit(""))) + F.regexp_count(t, pattern)

    def encode(self):
        own = self.specials or Specials(byte_special_ids())
        sid, run, first = own.ids, re.compile(f"({own.pattern})"), {t[0] for t in own.ids}
        hint = "<|" if all(t.startswith("<|") for t in sid) else next(iter(first)) if len(first) == 1 else None

        def cut(text: str):
            return np.concatenate([[sid[p]] if k % 2 else np.frombuffer(p.encode("utf-8"), np.uint8)
                                   for k, p in enumerate(run.split(text))])

        def arrays(texts: pa.Array) -> pa.Array:
            if not sid or hint and not pc.any(pc.match_substring(texts, hint)).as_py():
                return utf8_ids(texts)
            return id_lists([cut(t) if hint is None or hint in t else np.frombuffer(t.encode("utf-8"), np.uint8)
                             for t in texts.to_pylist()])
        return arrays


class PieceEncoder(Encoder):
    """Texts cut in the JVM into special tokens and pieces; ``encode`` maps an Arrow array of
    pieces to id lists."""

    def __init__(self, pieces: Callable[[Column], Column], specials: dict[str, int]):
        from textloom.operators.vocab import trie_pattern

        self.pieces, self.tokens, self.pattern = pieces, list(specials), trie_pattern(specials)

    def prepare(self, text: Column) -> Column:
        from textloom.operators.vocab import special_runs

        t = super().prepare(text)
        runs = F.when(t.rlike(self.pattern), special_runs(t, self.tokens)).otherwise(F.array(t))
        return F.flatten(F.transform(runs, lambda r, i: F.when(i % 2 == 1, F.array(r)).otherwise(self.pieces(r))))


class WordEncoder(PieceEncoder):
    """Ids of the words of ``vocab`` (word, id from 0); unknown words are ``size``, the special
    tokens follow from ``size + 1``, or are those of ``specials`` with their own ids."""

    def __init__(self, vocab: DataFrame, size: int, specials: DataFrame | dict[str, int] | None = None):
        from textloom.operators.vocab import word_pieces

        self.size = size
        own = Specials({t: size + 1 + k for k, (t, _) in enumerate(SPECIAL_TOKENS)} if specials is None else specials)
        self.specials, self.eot, self.pad = own.ids, own.eot, own.pad
        super().__init__(word_pieces, self.specials)
        rows = [(r["word"], r["id"]) for r in bounded_rows(vocab, "word", "id")] + list(self.specials.items())
        self.table = vocab.sparkSession.sparkContext.broadcast(([w for w, _ in rows], [i for _, i in rows]))

    def encode(self):
        table, unknown = self.table, self.size
        words, ids = pa.array(table.value[0], pa.string()), pa.array(table.value[1], pa.int32())

        def arrays(lists: pa.Array) -> pa.Array:
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=offsets[1:])
            found = ids.take(pc.index_in(lists.flatten(), value_set=words)).fill_null(unknown)
            return pa.ListArray.from_arrays(pa.array(offsets), found)
        return arrays


class BpeEncoder(PieceEncoder):
    """Byte-level BPE with given ``merges`` (rank, left, right, id) over byte ids; specials
    as in the byte encoder. A worker keeps the ids of up to ``MAX_TABLE`` pre-tokens."""

    def __init__(self, merges: DataFrame, specials: DataFrame | dict[str, int] | None = None):
        from textloom.operators.vocab import BPE_PRETOKEN, MergeTable

        own = Specials(byte_special_ids() if specials is None else specials)
        self.specials, self.eot, self.pad = own.ids, own.eot, own.pad
        super().__init__(lambda t: F.regexp_extract_all(t, F.lit(BPE_PRETOKEN), 1), self.specials)
        rows = [(r["rank"], r["left"], r["right"], r["id"]) for r in bounded_rows(merges, "rank", "left", "right", "id")]
        self.ranks = merges.sparkSession.sparkContext.broadcast(MergeTable(rows))

    def encode(self):
        from textloom.operators.vocab import _apply_merges

        ranks, known = self.ranks.value, {t: [i] for t, i in self.specials.items()}

        def ids_of(piece: str) -> list[int]:
            ids = known.get(piece)
            if ids is None:
                ids = _apply_merges(list(piece.encode("utf-8")), ranks)
                if len(known) < MAX_TABLE:
                    known[piece] = ids
            return ids

        def arrays(lists: pa.Array) -> pa.Array:
            return id_lists([[i for p in row for i in ids_of(p)] for row in lists.to_pylist()])
        return arrays


class UserEncoder(Encoder):
    """The user's tokenizer. ``factory`` builds it once per task; it maps a list of texts
    to a list of id lists. Ids outside [0, ``vocab_size``) are an error (T7)."""

    def __init__(self, factory: Callable[[], Callable[[list[str]], list]], eot: int, pad: int, vocab_size: int = 65536):
        self.factory, self.eot, self.pad, self.vocab_size = factory, eot, pad, vocab_size

    def encode(self):
        user = self.factory()
        return lambda texts: id_lists(user(texts.to_pylist()))


def decode_ids(df: DataFrame, vocab: DataFrame, out: str = "decoded", ids_col: str = "ids", sep: str = "",
               skip_special: bool = False) -> DataFrame:
    """T10 through a vocabulary (id, piece binary or string, special): the pieces of the ids
    joined by ``sep``, special tokens kept or dropped; bytes that are not UTF-8 become U+FFFD.
    An id that is not in the vocabulary is an error."""
    rows = bounded_rows(vocab.select("id", F.col("piece").cast("binary").alias("piece"), "special"), "id", "piece", "special")
    table = df.sparkSession.sparkContext.broadcast({r["id"]: (bytes(r["piece"]), r["special"]) for r in rows})
    kept, at = len(df.columns), df.columns.index(ids_col)
    names, glue = df.columns + [out], sep.encode("utf-8")

    def run(batches):
        pieces = {i: p for i, (p, _) in table.value.items()}
        drop = {i for i, (_, s) in table.value.items() if s} if skip_special else set()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_A_TIME):
                b = whole.slice(start, ROWS_AT_A_TIME)
                texts = [None if ids is None else glue.join(pieces[i] for i in ids if i not in drop).decode("utf-8", "replace")
                         for ids in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(b.columns[:kept] + [pa.array(texts, pa.string())], names=names)

    return df.mapInArrow(run, T.StructType(df.schema.fields + [T.StructField(out, T.StringType())]))


BYTES = ByteEncoder()
