"""Token column expressions: special tokens, the byte encoder, decode, id checks.

The byte encoder maps text to the ids of its UTF-8 bytes (0-255); special tokens
follow from 256 in the order of their reference ids. It needs no vocabulary
file and runs entirely as JVM expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The special tokens of the tokenizer settings with their ids,
# in id order, and their roles (bos = eos = <|endoftext|>, pad = <|pad|>, the
# other eight are "additional").
SPECIAL_TOKENS = [
    ("<|endoftext|>", 32256),
    ("<|pad|>", 32257),
    ("<|system|>", 32258),
    ("<|user|>", 32259),
    ("<|assistant|>", 32260),
    ("<|memory|>", 32261),
    ("<|dialog|>", 32262),
    ("<|task|>", 32263),
    ("<|im_start|>", 32264),
    ("<|im_end|>", 32265),
]
SPECIAL_ROLES = {"<|endoftext|>": ["bos", "eos"], "<|pad|>": ["pad"]}
REFERENCE_BASE_VOCAB = 32256  # ids 0..32255 are the base vocabulary of the 32k tokenizer

BYTE_VOCAB = 256
IGNORE_INDEX = -100


def byte_special_ids() -> dict[str, int]:
    """Special token -> id under the byte encoder (256 + offset from the first special id)."""
    first = SPECIAL_TOKENS[0][1]
    return {tok: BYTE_VOCAB + (tid - first) for tok, tid in SPECIAL_TOKENS}


EOT = byte_special_ids()["<|endoftext|>"]
PAD = byte_special_ids()["<|pad|>"]
BYTE_VOCAB_SIZE = BYTE_VOCAB + len(SPECIAL_TOKENS)

_SPECIAL_ALT = "|".join(re.escape(t) for t, _ in SPECIAL_TOKENS)
# Cuts text into special tokens and plain runs; plain text is cut at every '<',
# which the byte encoder does not notice.
SPECIAL_SPLIT_PATTERN = f"({_SPECIAL_ALT}|[^<]+|<)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def utf8_byte_ids(c) -> Column:
    """ids of the UTF-8 bytes of a string; '' and null give []. Each byte becomes
    one Latin-1 character, whose code point is the byte value."""
    t = _col(c)
    latin = F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")
    ids = F.transform(F.split(latin, ""), lambda ch: F.ascii(ch))
    return F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.array().cast("array<int>")).otherwise(ids)


def byte_encode(c, specials: bool = True) -> Column:
    """T4 + T5 with the byte encoder: literal special tokens map to their id,
    everything else to its bytes. Rows without '<|' take the short path."""
    t = _col(c)
    plain = utf8_byte_ids(t)
    if not specials:
        return plain
    sid = byte_special_ids()
    pieces = F.regexp_extract_all(t, F.lit(SPECIAL_SPLIT_PATTERN), 1)
    table = F.create_map(*[x for tok, i in sid.items() for x in (F.lit(tok), F.lit(i))])

    def piece_ids(p):
        hit = F.element_at(table, p)
        return F.when(hit.isNotNull(), F.array(hit)).otherwise(utf8_byte_ids(p))

    split_path = F.flatten(F.transform(pieces, piece_ids))
    return F.when(F.instr(t, "<|") > 0, split_path).otherwise(plain)


def byte_encode_length(c, specials: bool = True) -> Column:
    """size(byte_encode(c)) computed cheaply: octet length unless a special token may occur."""
    t = _col(c)
    plain = F.coalesce(F.octet_length(t), F.lit(0))
    if not specials:
        return plain
    return F.when(F.instr(t, "<|") > 0, F.size(byte_encode(t, True))).otherwise(plain)


def byte_decode(ids, skip_special: bool = False) -> Column:
    """Ids back to text. Specials are written as their literal token or dropped."""
    a = _col(ids)
    sid = byte_special_ids()
    if skip_special:
        a = F.filter(a, lambda x: x < BYTE_VOCAB)

    def hexof(x):
        expr = F.when(x < BYTE_VOCAB, F.lpad(F.hex(x), 2, "0"))
        for tok, i in sid.items():
            expr = expr.when(x == i, F.lit(tok.encode("utf-8").hex().upper()))
        return expr

    return F.decode(F.unhex(F.array_join(F.transform(a, hexof), "")), "UTF-8")


def prepend(ids, token_id: int) -> Column:
    """Delimiter first; an empty document becomes [token_id]."""
    return F.concat(F.array(F.lit(token_id)), _col(ids))


def checked_ids(ids, hi: int = 65536) -> Column:
    """The ids, or a task failure when one lies outside [0, hi)."""
    a = _col(ids)
    ok = F.forall(a, lambda x: (x >= 0) & (x < hi))
    msg = F.lit(f"token id outside [0, {hi})")
    return F.when(ok, a).otherwise(F.raise_error(msg).cast("array<int>"))


def truncate(ids, n: int) -> Column:
    """First n ids."""
    return F.slice(_col(ids), 1, n)


def keep_last(ids, n: int) -> Column:
    """Last n ids (context crop)."""
    a = _col(ids)
    return F.when(F.size(a) > n, F.slice(a, -n, n)).otherwise(a)


def ids_text(ids) -> Column:
    """Array of ints as a space-separated string, for output and comparison."""
    return F.array_join(_col(ids).cast("array<string>"), " ")
