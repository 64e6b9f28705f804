"""Special tokens (T1-T3) and the word encoder (T4 ``words``, T11, T12).

The word encoder cuts text into letter runs, digit runs and runs of other
non-space characters; its vocabulary is the top V words of a corpus by (count
desc, word), unknown words map to V. Special tokens are split off first.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.tokens import SPECIAL_ROLES, SPECIAL_TOKENS

# Word pattern (letters, digits, other non-space runs); the space
# class is written out so that both regex engines agree on it.
WORD_PATTERN = r"(\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\x0B\f\r ]+)"


def trie_pattern(tokens) -> str:
    """A pattern that matches the longest of ``tokens`` at a place: their trie, branch by branch, ends last. Python and
    Java read it alike."""
    trie: dict = {}
    for t in tokens:
        if not t:
            raise ValueError("a special token can't be empty")
        node = trie
        for c in t:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        text = ""
        while len(node) == 1 and "" not in node:  # a run without branches
            c, node = next(iter(node.items()))
            text += _escaped(c)
        if set(node) == {""}:
            return text
        branches = [_escaped(c) + pattern(n) for c, n in sorted(node.items()) if c]
        return text + "(?:" + "|".join(branches) + ")" + ("?" if "" in node else "")

    return pattern(trie) if trie else r"(?!)"


def _escaped(c: str) -> str:
    return "\\" + c if c in r"\^$.|?*+()[]{}<>-#&~" else c


#: Marks around special tokens while a text is cut; both are written otherwise where a text holds them.
_ESC, _OWN, _CUT = "\x01", "\x02", "\x03"


def special_runs(text, tokens):
    """T5 in the JVM: the text cut at its special tokens, plain runs and tokens in turn (the first run is plain, some are
    empty). Leftmost first, longest first; a token inside a longer or overlapping one that was taken isn't seen."""
    pattern = trie_pattern([t.replace(_ESC, _ESC + _OWN) for t in tokens])
    t = F.replace(text, F.lit(_ESC), F.lit(_ESC + _OWN))
    parts = F.split(F.regexp_replace(t, F.lit(f"({pattern})"), F.lit(f"{_ESC}{_CUT}$1{_ESC}{_CUT}")), f"{_ESC}{_CUT}")
    return F.transform(parts, lambda r: F.replace(r, F.lit(_ESC + _OWN), F.lit(_ESC)))


def special_tokens(spark: SparkSession, base: int | None = None) -> DataFrame:
    """(token, id, roles, special). ``base`` re-bases the ids on another
    vocabulary (e.g. 256 for the byte encoder); None keeps the reference ids."""
    first = SPECIAL_TOKENS[0][1]
    rows = [(t, (i if base is None else base + i - first), SPECIAL_ROLES.get(t, ["additional"]), True)
            for t, i in SPECIAL_TOKENS]
    return spark.createDataFrame(rows, "token string, id int, roles array<string>, special boolean")


def resolve_token_id(vocab: DataFrame, role: str) -> DataFrame:
    """Id of a role. eos: by role, else the literal <|endoftext|>, else an error;
    pad: by role, else eos."""
    by_role = F.max(F.when(F.array_contains("roles", role), F.col("id")))
    eos = F.coalesce(F.max(F.when(F.array_contains("roles", "eos"), F.col("id"))),
                     F.max(F.when(F.col("token") == "<|endoftext|>", F.col("id"))))
    if role == "pad":
        val = F.coalesce(by_role, eos)
    elif role == "eos":
        val = eos
    else:
        val = by_role
    return vocab.agg(F.when(val.isNotNull(), val).otherwise(
        F.raise_error(F.lit(f"{role} token not found")).cast("int")).alias(f"{role}_id"))


def vocab_size(base_size: int, vocab: DataFrame) -> DataFrame:
    """Entries including the special tokens (32,266 for the 32k tokenizer)."""
    return vocab.agg((F.lit(base_size) + F.count(F.lit(1))).cast("long").alias("vocab_size"))


def word_pieces(text) -> F.Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(WORD_PATTERN), 1)


def word_vocab(docs: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """Vocabulary: top ``size`` words by (count desc, word). The counts are a
    distributed aggregate; only the top ``size`` rows (a bounded top-k) are ranked."""
    counts = docs.select(F.explode(word_pieces(text_col)).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).cast("long").alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col("word")).limit(size)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("count").desc(), F.col("word"))  # over at most ``size`` rows
    return top.withColumn("id", (F.row_number().over(w) - 1).cast("int"))


def word_encode(df: DataFrame, vocab: DataFrame, size: int, text_col: str = "text", out: str = "ids") -> DataFrame:
    """T4 ``words``: per row, ids of its words in order (unknown = size, specials from size + 1),
    looked up inside the row."""
    from textloom.operators.encoders import WordEncoder

    return WordEncoder(vocab, size).with_ids(df, **{out: F.col(text_col)})


def compare_encoders(df: DataFrame, counts: dict, split_col: str = "split") -> DataFrame:
    """T11 + T12: rows and token totals of one corpus under several encoders, in one pass."""
    aggs = [F.count(F.lit(1)).cast("long").alias("documents")]
    aggs += [F.sum(c).cast("long").alias(f"{name}_tokens") for name, c in counts.items()]
    return df.groupBy(split_col).agg(*aggs)


# Byte-level pre-tokens: a run of letters, digits or other non-space characters with
# at most one leading space, or a run of spaces; together they cover the text.
BPE_PRETOKEN = r"( ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+)"


# Pre-tokens up to this many bytes are merged by looking at all pairs each time.
SHORT = 24


def _apply_merges(ids: list[int], ranks: dict) -> list[int]:
    """Standard BPE: merge the adjacent pair of lowest rank, everywhere, until none is left."""
    if len(ids) > SHORT:
        return merge_long(np.asarray(ids, np.int64), ranks).tolist()
    while len(ids) > 1:
        best = min((ranks.get(p, _NO_RANK) for p in zip(ids, ids[1:])), key=lambda r: r[0])
        if best is _NO_RANK:
            break
        at = [k for k, p in enumerate(zip(ids, ids[1:])) if ranks.get(p) == best]
        out, i, starts = [], 0, set(at)
        while i < len(ids):
            if i in starts:
                out.append(best[1])
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out
    return ids


_NO_RANK = (float("inf"), -1)


class MergeTable(dict):
    """(left, right) -> (rank, id), and the same as sorted arrays for many pairs at once."""

    def __init__(self, rows):
        super().__init__(((int(a), int(b)), (int(r), int(i))) for r, a, b, i in rows)
        pairs = np.array([(a << 32) | b for a, b in self], np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.rank = np.array([v[0] for v in self.values()], np.int64)[order]
        self.made = np.array([v[1] for v in self.values()], np.int64)[order]
        if len(np.unique(self.rank)) != len(self.rank):
            raise ValueError("two merges have one rank")

    def __reduce__(self):
        return MergeTable, ([(r, a, b, i) for (a, b), (r, i) in self.items()],)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair's merge, -1 where it has none."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        want = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, at, -1)


def merge_long(ids: np.ndarray, ranks: dict) -> np.ndarray:
    """The same merges over a linked list of symbols and a heap of ranks: each rank has the places whose pair had it
    when it was noted. A rank is taken once for all its places, and only the two neighbours of a merged pair get a new
    rank, so the work is that of the merges made (n log n in all), not a pass over the text for each."""
    table = ranks if isinstance(ranks, MergeTable) else MergeTable([(r, a, b, i) for (a, b), (r, i) in ranks.items()])
    n = len(ids)
    sym = np.append(ids, -1)  # place n is a wall that no merge has
    after, ahead = np.arange(1, n + 2), np.arange(-1, n)
    places: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def note(at: np.ndarray) -> None:
        found = table.find(sym[at], sym[after[at]])
        at, found = at[found >= 0], found[found >= 0]
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else []
        for lo, hi in zip(starts, [*starts[1:], len(found)]):
            k = int(found[lo])
            if k not in places:
                places[k] = []
                heapq.heappush(heap, (int(table.rank[k]), k))
            places[k].append(at[lo:hi])

    note(np.arange(n - 1))
    while heap:
        _, k = heapq.heappop(heap)
        at = np.unique(np.concatenate(places.pop(k)))
        left, right = table.pairs[k] >> 32, table.pairs[k] & 0xFFFFFFFF
        at = at[(sym[at] == left) & (sym[after[at]] == right)]  # what is still there
        if left == right and len(at) > 1:  # of a run a a a every second pair
            head = np.r_[True, after[at[:-1]] != at[1:]]
            first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        sym[at], sym[gone] = table.made[k], -2  # a place that was merged away is in no pair
        after[at] = after[gone]
        ahead[after[at]] = at
        before = ahead[at]
        note(np.unique(np.concatenate([before[before >= 0], at[after[at] < n]])))
    return sym[:n][sym[:n] >= 0]


def bpe_encode(df: DataFrame, merges: DataFrame, text_col: str = "text", out: str = "ids") -> DataFrame:
    """T4 ``bpe``: byte-level BPE with a given merges table over byte ids (0-255; specials
    from 256 as in the byte encoder)."""
    from textloom.operators.encoders import BpeEncoder

    return BpeEncoder(merges).with_ids(df, **{out: F.col(text_col)})


def read_tokenizer_folder(spark: SparkSession, folder: str) -> DataFrame:
    """T1 from a tokenizer's folder: ``added_tokens.json`` (token -> id) and the roles of
    ``special_tokens_map.json`` (``*_token`` keys; a role is a string or an object with
    ``content``). Same columns as ``special_tokens``."""
    def text(name):
        return spark.read.text(f"{folder.rstrip('/')}/{name}", wholetext=True)

    ids = text("added_tokens.json").select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
    raw = text("special_tokens_map.json").select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "v"))
    single = raw.where(F.col("key").endswith("_token"))
    roles = single.select(F.coalesce(F.get_json_object("v", "$.content"), F.col("v")).alias("token"),
                          F.regexp_replace("key", "_token$", "").alias("role"))
    roles = roles.where(F.col("role").isin("bos", "eos", "pad")).groupBy("token").agg(
        F.array_sort(F.collect_set("role")).alias("roles"))
    return ids.join(roles, "token", "left").select(
        "token", "id", F.coalesce("roles", F.array(F.lit("additional"))).alias("roles"), F.lit(True).alias("special"))


def write_tokenizer_folder(vocab: DataFrame, folder: str) -> None:
    """The two files of ``read_tokenizer_folder`` from a special-token table (a few rows)."""
    def put(df, name):
        df.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/{name}")

    put(vocab.agg(F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("m")), "added_tokens.json")
    roles = vocab.select("token", F.explode("roles").alias("role")).where(F.col("role") != "additional")
    put(roles.agg(F.map_from_entries(F.collect_list(F.struct(F.concat("role", F.lit("_token")), "token"))).alias("m")),
        "special_tokens_map.json")
