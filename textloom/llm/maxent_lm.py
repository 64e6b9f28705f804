"""Hashed maximum-entropy language model with a class-factored softmax.

log p(word | history) = log p(class | history) + log p(seen | class) + log p(leaf | class, history) + log p(word | leaf).

Classes are the ``HEAD`` most frequent words, each alone, the end of a text, and ``TAIL`` classes of all other
words by a hash of their last two bytes. The class model is a softmax over hashed features of the two classes
before: a bias, the last one, the pair (n-grams) and the one before the last (skip).

The words of a tail class are dealt into ``LEAVES`` leaves by two digits of a hash. Each digit is a softmax over hashed
features of the two words before, the words themselves and not their classes: the last one, the pair (n-grams) and the
one before the last (skip), beside the digit's share of the training tokens as a fixed bias. Words of one leaf follow
their training counts with absolute discounting; what a class's words lose by it is the probability of a word not seen,
which has no leaf.

The class loss depends on the corpus only through how often each class follows each pair of classes. These
counts are summed over all training documents by Spark, and the gradient updates run over that table, in
tasks, with the diagonal of the curvature as step size. The table is bounded by the number of classes. The gradient of
the word features is taken over all training documents in every round: tasks send the rows they touched, which are
added up by slices of the table. The word table has a row for every ``TOKENS_A_ROW`` training tokens, at most
``MAX_WORD_ROWS``, so that it may be broadcast.

Documents are dealt into blocks of about ``BLOCK_BYTES``. A block's texts are split once: its distinct words are
numbered by falling frequency, and the numbers of its tokens are stored with the words' hashes, classes and leaves.
All passes after that (class counts, rounds over the word features, scores) read the numbers.

Word counts grow with the corpus and are never broadcast. A block asks for the counts of its distinct words only, and
gets back those that differ from its own. A block's numbers and counts then meet in one task and are scored with numpy.

Edge rows: a null or empty text is the end token alone. A null id counts as the empty string for the fold.
Repeated rows are separate training texts. Without training rows the unigram score is 0 and the model's scores
are those of zero weights. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from textloom.llm.common import rows_of, stored, text_bytes

BLOCK_BYTES = 16 << 20
HEAD, TAIL = 47, 48
CLASSES = 1 + HEAD + TAIL  # class 0: the end of a text
STATES = CLASSES + 1       # the last state: before the first word
FEATURES = 8192
#: Rows of the feature table whose gradients meet in one task.
SLICE = 1024
#: Digits of a tail word's leaf, values of a digit, leaves of a class, and the nodes where a digit is chosen.
DIGITS, RADIX = 2, 16
LEAVES = RADIX ** DIGITS
NODES = TAIL * (1 + RADIX)
#: Rows of the table of word features: one for so many training tokens, within these bounds (a row has RADIX floats).
TOKENS_A_ROW, MIN_WORD_ROWS, MAX_WORD_ROWS = 1024, 1 << 14, 1 << 18
ONES = np.ones(RADIX, np.float32)
#: Rows of the word table sent as one row of a shuffle.
WORD_SLICE = 4096
#: Stands for the end of a text in tables of words; a word holds no white space.
END = b"\n"
#: Words handled at a time.
STEP_WORDS = 200_000
#: Choices of a digit whose scores are worked out at a time, few enough for the cache.
CHOICES = 4000
#: Blocks whose gradients of the word features are added up by one task, where there are tasks enough.
BLOCKS_A_TASK = 4

#: Numbered blocks hold rows of two kinds: one a block (no place), and one for each of its words.
NUMBERED = ("block long, ids array<long>, training array<boolean>, lengths binary, numbers binary, hashed binary, tail binary, code binary, "
            "place int, word binary, n long")
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tail_class(word: bytes) -> int:
    return 1 + HEAD + zlib.crc32(word[-2:]) % TAIL


def tail_class_column(word: Column) -> Column:
    return F.lit(1 + HEAD) + F.crc32(F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)) % TAIL


def leaf_code(word: bytes) -> int:
    return (zlib.crc32(word) >> 16) % LEAVES


def leaf_code_column(word: Column) -> Column:
    return F.shiftright(F.crc32(word), 16) % LEAVES


class _Classes(dict):
    """word, or its last two bytes -> its class; head words are there from the start."""

    def __missing__(self, word: bytes) -> int:
        self[word] = c = tail_class(word)
        return c


def states_before(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The pair of classes before each token, as one number; ``starts``: first tokens of the texts."""
    last = np.r_[CLASSES, classes[:-1]]
    last[starts] = CLASSES
    skip = np.r_[CLASSES, last[:-1]]
    skip[starts] = CLASSES
    return skip.astype(np.int64) * STATES + last


def features_of(pairs: np.ndarray) -> np.ndarray:
    """Hashed features of pairs of classes: bias, last, pair, skip."""
    skip, last = pairs // STATES, pairs % STATES
    raw = np.stack([np.zeros_like(pairs), 1 + last, 1 + STATES + skip * STATES + last, 1 + STATES + STATES ** 2 + skip], axis=1)
    mixed = raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(FEATURES)).astype(np.int64)


@dataclass
class Lexicon:
    """Class, leaf within the class and hash of distinct words."""
    kind: np.ndarray
    code: np.ndarray
    hashed: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], head: list[bytes]) -> Lexicon:
        known = _Classes({END: 0, **{w: 1 + i for i, w in enumerate(head)}})
        n = len(words)
        return cls(np.fromiter((known[w] for w in words), np.int64, n), np.fromiter(map(leaf_code, words), np.int64, n),
                   np.fromiter(map(xxh64_intdigest, words), np.uint64, n))

    @classmethod
    def stored(cls, hashed: bytes, tail: bytes, code: bytes, head: list[bytes]) -> Lexicon:
        """Of a numbered block's words; the first is the end of a text. Head words are told by hash, class and leaf."""
        own = cls(np.frombuffer(tail, np.uint8).astype(np.int64) + 1 + HEAD, np.frombuffer(code, np.uint8).astype(np.int64),
                  np.frombuffer(hashed, np.uint64))
        known = {(xxh64_intdigest(w), tail_class(w), leaf_code(w)): 1 + i for i, w in enumerate(head)}
        for i in np.flatnonzero(np.isin(own.hashed, np.array([h for h, _, _ in known], np.uint64))).tolist():
            own.kind[i] = known.get((int(own.hashed[i]), int(own.kind[i]), int(own.code[i])), own.kind[i])
        own.kind[0] = 0
        return own

    def leaves(self) -> np.ndarray:
        """Number of a word's leaf in the model's tables; a class of one word is its own leaf."""
        return np.where(self.kind <= HEAD, self.kind, 1 + HEAD + (self.kind - 1 - HEAD) * LEAVES + self.code)


def leaf_choices(lexicon: Lexicon, numbers: np.ndarray, starts: np.ndarray, rows: int, seen: np.ndarray | None = None):
    """For each digit of the tail words among ``numbers`` (places in the lexicon; ``starts``: first tokens of the
    texts): the tokens' places, the node, the digit, and the rows of last, pair and skip, of ``rows``, a power of two.
    ``seen``: words with a leaf."""
    hashed = lexicon.hashed[numbers]
    last = np.r_[np.uint64(0), hashed[:-1]]
    last[starts] = 0
    skip = np.r_[np.uint64(0), last[:-1]]
    skip[starts] = 0
    tail_words = lexicon.kind > HEAD if seen is None else (lexicon.kind > HEAD) & seen
    at = np.flatnonzero(tail_words[numbers])
    tail, code = lexicon.kind[numbers[at]] - 1 - HEAD, lexicon.code[numbers[at]]
    last, skip = last[at] * np.uint64(0x9E3779B97F4A7C15), skip[at] * np.uint64(0xC2B2AE3D27D4EB4F)
    for node, digit in ((tail, code // RADIX), (TAIL + tail * RADIX + code // RADIX, code % RADIX)):
        own = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        raw = (last + own, (last ^ np.uint64(1)) + (skip >> np.uint64(1)) + own, (skip ^ np.uint64(2)) + own)
        yield at, node, digit, [_row(x, rows) for x in raw]


def _row(x: np.ndarray, rows: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(rows - 1)).astype(np.int64)


def digit_scores(prior: np.ndarray, weights: np.ndarray, node: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Unnormalised log p(digit | node, history), a row per choice. A row of weights moves by at most 1 a round and the
    prior is at most 0, so its exponential stays small."""
    x, own = prior.take(node, axis=0), np.empty((len(node), RADIX), np.float32)
    for f in features:
        x += weights.take(f, axis=0, out=own, mode="clip")
    return x


def class_logs(weights: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log p(class | pair) for each pair."""
    x = weights[features_of(pairs)].sum(axis=1)
    x -= x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _documents(docs: DataFrame, id_col: str, text_col: str, training: Column) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"), training.alias("training"))


def numbered(docs: DataFrame) -> DataFrame:
    """Blocks of documents as stored numbers (``NUMBERED``). A block's words have places by falling frequency and hash,
    behind the end of a text; its row has the documents' ids, folds and lengths, the places of all tokens, and hash, tail
    class and leaf of each place. A word's row has its training count in the block. A table without blocks: its partitions."""
    if "block" not in docs.columns:
        docs = docs.withColumn("block", F.spark_partition_id().cast("long"))

    def number(key: tuple, texts: pa.Table) -> pa.Table:
        training = texts.column("training").to_numpy()
        text = pa.concat_arrays([b.column("text") for b in texts.to_batches()]).cast(pa.string(), safe=False)  # any bytes
        parts = pc.ascii_split_whitespace(pc.ascii_lower(text))
        own = parts.flatten()
        some = pc.greater(pc.binary_length(own), 0)  # white space at a text's ends leaves an empty part there
        behind = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))][np.r_[0, np.cumsum(pc.list_value_length(parts).to_numpy())]]
        lengths = np.diff(behind) + 1
        own = own.filter(some).dictionary_encode()
        words = [*own.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), END]
        size = len(words)
        numbers = np.full(int(lengths.sum()), size - 1)
        inside = np.ones(len(numbers), bool)
        inside[np.cumsum(lengths) - 1] = False
        numbers[inside] = own.indices.to_numpy()
        hashed = np.fromiter(map(xxh64_intdigest, words), np.uint64, size)
        often = np.bincount(numbers, minlength=size)
        often[-1] = len(numbers) + 1  # the end comes first
        order = np.lexsort((hashed, -often))
        rank = np.empty(size, np.uint32)
        rank[order] = np.arange(size, dtype=np.uint32)
        classes = _Classes()
        tail = np.fromiter((classes[w[-2:]] for w in words), np.int64, size)[order] - 1 - HEAD
        code = (np.fromiter(map(zlib.crc32, words), np.int64, size)[order] >> 16) % LEAVES
        n = np.bincount(numbers[np.repeat(training, lengths)], minlength=size)[order]
        blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        ids = pa.array([texts.column("doc_id").to_pylist()], pa.list_(pa.int64()))
        block = {"block": pa.array([key[0].as_py()], pa.int64()), "ids": ids, "training": pa.array([training.tolist()], pa.list_(pa.bool_())),
                 "lengths": blob(lengths, np.int64), "numbers": blob(rank[numbers], np.uint32), "hashed": blob(hashed[order], np.uint64),
                 "tail": blob(tail, np.uint8), "code": blob(code, np.uint8)}
        own = {"block": pa.array(np.full(size, key[0].as_py()), pa.int64()), "place": pa.array(np.arange(size), pa.int32()),
               "word": pa.array(words, pa.binary()).take(pa.array(order)), "n": pa.array(n, pa.int64())}
        types = {k: v.type for k, v in {**block, **own}.items()}
        whole = lambda x, n: pa.table([x.get(k, pa.nulls(n, types[k])) for k in types], list(types))
        return pa.concat_tables([whole(block, 1), whole(own, size)])

    return stored(docs.groupBy("block").applyInArrow(number, NUMBERED), "lm-blocks", compression="zstd")


def _block_rows(blocks: DataFrame) -> DataFrame:
    return blocks.where("place IS NULL").drop("place", "word", "n")


def _training_steps(batches: Iterator[pa.RecordBatch], head: list[bytes]) -> Iterator[tuple[Lexicon, np.ndarray, np.ndarray]]:
    """Training texts of numbered blocks by steps: the block's words, the tokens' places and the texts' first tokens."""
    for training, lengths, numbers, *words in rows_of(batches, "training", "lengths", "numbers", "hashed", "tail", "code"):
        training, lengths = np.array(training, bool), np.frombuffer(lengths, np.int64)
        numbers = np.frombuffer(numbers, np.uint32)[np.repeat(training, lengths)]
        lexicon = Lexicon.stored(*words, head)
        for _, own, starts in _steps(numbers, lengths[training]):
            yield lexicon, own, starts


def _steps(numbers: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Whole texts of about ``STEP_WORDS`` words at a time: which texts, their tokens, the texts' first tokens."""
    first = np.r_[0, np.cumsum(lengths)]
    lo = 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(first[:-1], first[lo] + STEP_WORDS)))
        yield slice(lo, hi), numbers[first[lo]:first[hi]].astype(np.int64), first[lo:hi] - first[lo]
        lo = hi


def word_table(docs: DataFrame, blocks: int, numbers: DataFrame | None = None) -> DataFrame:
    """(block, place, word, n, c, first): distinct words of each block with their training count there and everywhere.
    Rows whose counts agree are left out unless they are a word's first. ``numbers``: the documents' numbered blocks."""
    rows = (numbered(docs) if numbers is None else numbers).where("place IS NOT NULL")
    same = Window.partitionBy("word")
    rows = rows.select("block", "place", "word", "n", F.sum("n").over(same).alias("c"),
                       (F.min("block").over(same) == F.col("block")).alias("first"))
    return stored(rows.where("first OR c <> n"), "lm-words")


@dataclass
class Model:
    head: list[bytes]
    tokens: int
    types: int
    sizes: np.ndarray      # training tokens, types and discount of each class
    kinds: np.ndarray
    discount: np.ndarray
    weights: np.ndarray
    mass: np.ndarray | None = None          # discounted training tokens of each leaf
    prior: np.ndarray | None = None         # (NODES, RADIX): log share of a digit at its node
    word_weights: np.ndarray | None = None  # (rows, RADIX)


def _class_table(words: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The head words, and per class and leaf: tokens, types, words seen once, words seen twice."""
    seen = words.where("first AND c > 0")
    top = seen.where(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(HEAD).select("word").collect()
    head = [bytes(r["word"]) for r in top]
    kind = F.when(F.col("word") == F.lit(END), F.lit(0).cast("bigint"))
    for i, w in enumerate(head):
        kind = kind.when(F.col("word") == F.lit(w), F.lit(1 + i).cast("bigint"))
    kind = kind.otherwise(tail_class_column(F.col("word")))
    once = lambda k: F.sum((F.col("c") == k).cast("long"))
    table = np.zeros((CLASSES, LEAVES, 4), np.int64)
    leaf = F.when(F.col("k") > HEAD, leaf_code_column(F.col("word"))).otherwise(F.lit(0).cast("bigint"))
    for r in seen.withColumn("k", kind).groupBy("k", leaf.alias("leaf")).agg(
            F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"), once(1).alias("n1"), once(2).alias("n2")).collect():  # one row a leaf
        table[int(r["k"]), int(r["leaf"])] = r["c"], r["v"], r["n1"], r["n2"]
    return head, table


def _class_counts(blocks: DataFrame, head: list[bytes]) -> DataFrame:
    """(pair, classes, counts): how often each class follows each pair of classes in the training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES * CLASSES, np.int64)
        for lexicon, numbers, starts in _training_steps(batches, head):
            own = lexicon.kind[numbers]
            np.add.at(total, states_before(own, starts) * CLASSES + own, 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells // CLASSES), pa.array(cells % CLASSES), pa.array(total[cells])], ["pair", "class", "n"])

    cells = _block_rows(blocks).drop("block", "ids").mapInArrow(count, "pair long, class long, n long")
    sums = cells.groupBy("pair", "class").agg(F.sum("n").alias("n"))
    pairs = sums.groupBy("pair").agg(F.collect_list(F.struct("class", "n")).alias("x"))  # at most CLASSES entries
    return stored(pairs.select("pair", "x.class", "x.n").toDF("pair", "classes", "counts"), "lm-pairs")


def fit_weights(pairs: DataFrame, totals: np.ndarray, rounds: int, ridge: float, tasks: int = 2) -> np.ndarray:
    """Gradient updates of the class model over the table of pairs. A task sends its sums of gradient and curvature for
    the feature rows it touched, by slices of the table; the slices are added up in tasks too, and the driver gets the
    steps of the touched rows alone."""
    context = pairs.sparkSession.sparkContext
    weights = np.zeros((FEATURES, CLASSES))
    start = np.log((totals + 0.5) / (totals + 0.5).sum())
    weights[features_of(np.zeros(1, np.int64))[0, 0]] = start

    def sums(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, h = np.zeros((2, FEATURES, CLASSES), np.float32)
            touched = np.zeros(FEATURES, bool)
            rows = list(rows_of(batches, "pair", "classes", "counts"))  # bounded by the number of pairs
            for at in range(0, len(rows), 1024):
                part = rows[at:at + 1024]
                pair = np.array([r[0] for r in part])
                n = np.zeros((len(part), CLASSES))
                for i, (_, k, x) in enumerate(part):
                    n[i, k] = x
                p = np.exp(class_logs(shared.value, pair))
                size = n.sum(axis=1, keepdims=True)
                for f in features_of(pair).T:
                    touched[f] = True
                    np.add.at(g, f, (n - size * p).astype(np.float32))
                    np.add.at(h, f, (size * p * (1 - p)).astype(np.float32))
            for k in range(0, FEATURES, SLICE):
                own = k + np.flatnonzero(touched[k:k + SLICE])
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int64()), pa.array([own.tolist()], pa.list_(pa.int32())),
                                                      pa.array([g[own].tobytes()], pa.binary()), pa.array([h[own].tobytes()], pa.binary())],
                                                     ["slice", "own", "g", "h"])
        return run

    def steps(shared):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            first = key[0].as_py() * SLICE
            g, h = np.zeros((2, SLICE, CLASSES))
            touched = np.zeros(SLICE, bool)
            for own, *parts in rows_of(table.to_batches(), "own", "g", "h"):
                at = np.array(own) - first
                touched[at] = True
                for x, part in zip((g, h), parts):
                    x[at] += np.frombuffer(part, np.float32).reshape(-1, CLASSES)
            own = np.flatnonzero(touched)
            # the four features of a pair move together, hence the damping
            step = np.clip(0.3 * (g[own] - ridge * shared.value[first + own]) / (h[own] + ridge + 0.5), -0.7, 0.7)
            return pa.table([pa.array([(first + own).tolist()], pa.list_(pa.int32())),
                             pa.array([step.astype(np.float32).tobytes()], pa.binary())], ["own", "step"])
        return run

    dealt = pairs.repartition(tasks)
    for _ in range(rounds):
        shared = context.broadcast(weights.astype(np.float32))
        parts = (dealt.mapInArrow(sums(shared), "slice long, own array<int>, g binary, h binary")
                 .groupBy("slice").applyInArrow(steps(shared), "own array<int>, step binary").collect())  # a row per slice
        shared.destroy()
        if not parts:
            break
        for r in parts:  # a row without counts has weight 0 and stays there
            weights[r["own"]] += np.frombuffer(r["step"], np.float32).reshape(-1, CLASSES)
    return weights


def leaf_prior(tokens: np.ndarray) -> np.ndarray:
    """Log share of each digit at its node, from the discounted tokens of the tail classes' leaves (TAIL, LEAVES)."""
    first = tokens.reshape(TAIL, RADIX, RADIX).sum(axis=2)
    x = np.concatenate([first, tokens.reshape(TAIL * RADIX, RADIX)]) + 0.01
    return np.log(x / x.sum(axis=1, keepdims=True)).astype(np.float32)


def word_rows(tokens: int) -> int:
    """Rows of the word table for so many training tokens: a power of two."""
    return min(MAX_WORD_ROWS, max(MIN_WORD_ROWS, 1 << (max(1, tokens // TOKENS_A_ROW) - 1).bit_length()))


def add_gradient(lexicon: Lexicon, numbers: np.ndarray, starts: np.ndarray, prior: np.ndarray, weights: np.ndarray,
                 g: np.ndarray, n: np.ndarray) -> None:
    """Adds the gradient of these texts' digits to ``g`` (a line per value of a digit), and how often each row was used to
    ``n``. Lines are summed one at a time, so that the sums being added to stay in the cache."""
    moved = weights.any()  # else the first round: all are 0
    for _, node, digit, features in leaf_choices(lexicon, numbers, starts, len(weights)):
        miss = np.empty((RADIX, len(node)))
        if not moved:
            share = np.exp(prior)
            np.take(-(share / (share @ ONES)[:, None]).T.astype(float), node, axis=1, out=miss, mode="clip")
        for lo in range(0, len(node) if moved else 0, CHOICES):
            part = slice(lo, lo + CHOICES)
            x = digit_scores(prior, weights, node[part], [f[part] for f in features])
            np.exp(x, out=x)
            x /= -(x @ ONES)[:, None]
            miss[:, part] = x.T
        miss[digit, np.arange(len(node))] += 1
        for f in features:
            for line, own in zip(g, miss):
                line += np.bincount(f, own, len(line))
            n += np.bincount(f, minlength=len(n))


def fit_word_weights(docs: DataFrame, head: list[bytes], prior: np.ndarray, rows: int, rounds: int, ridge: float,
                     blocks: DataFrame | None = None) -> np.ndarray:
    """Gradient updates of the digits' features over all training documents. The step of a row is its gradient over a bound
    of the curvature of the three features that move together. Sums are added up as they arrive, by slices of the table.
    A task adds up several blocks, so that fewer sums are sent. ``blocks``: the documents' numbered blocks."""
    context = docs.sparkSession.sparkContext
    weights = np.zeros((rows, RADIX), np.float32)
    texts = _block_rows(numbered(docs) if blocks is None else blocks).drop("block", "ids")
    texts = texts.coalesce(max(2 * context.defaultParallelism, -(-texts.count() // BLOCKS_A_TASK)))

    def sums(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fixed, own = shared.value
            g, n = np.zeros((RADIX, rows)), np.zeros(rows)
            for lexicon, numbers, starts in _training_steps(batches, head):
                add_gradient(lexicon, numbers, starts, fixed, own, g, n)
            for lo in range(0, rows, WORD_SLICE):
                touched = lo + np.flatnonzero(n[lo:lo + WORD_SLICE])
                if len(touched):
                    yield _slice_row(lo // WORD_SLICE, touched, g[:, touched].T, n[touched])
        return run

    def steps(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value[1]
            total: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # at most the whole table
            for k, touched, g, n in rows_of(batches, "slice", "own", "g", "n"):
                if k not in total:
                    total[k] = np.zeros((WORD_SLICE, RADIX)), np.zeros(WORD_SLICE)
                at = np.frombuffer(touched, np.int64) - k * WORD_SLICE
                total[k][0][at] += np.frombuffer(g, np.float32).reshape(-1, RADIX)
                total[k][1][at] += np.frombuffer(n, np.float32)
            for k, (g, n) in total.items():
                at = np.flatnonzero(n)
                step = (g[at] - ridge * own[k * WORD_SLICE + at]) / (0.45 * n[at, None] + ridge)
                yield _slice_row(k, k * WORD_SLICE + at, np.clip(step, -1, 1), n[at])
        return run

    schema = "slice long, own binary, g binary, n binary"
    for _ in range(rounds):
        shared = context.broadcast((prior, weights))  # bounded: MAX_WORD_ROWS rows
        parts = texts.mapInArrow(sums(shared), schema).repartition("slice").mapInArrow(steps(shared), schema)
        for r in parts.select("own", "g").collect():  # a row per slice
            weights[np.frombuffer(r["own"], np.int64)] += np.frombuffer(r["g"], np.float32).reshape(-1, RADIX)
        shared.destroy()
    return weights


def _slice_row(k: int, own: np.ndarray, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    packed = [pa.array([x.tobytes()], pa.binary()) for x in (own.astype(np.int64), g.astype(np.float32), n.astype(np.float32))]
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *packed], ["slice", "own", "g", "n"])


def train(docs: DataFrame, words: DataFrame, rounds: int = 12, ridge: float = 2.0, word_rounds: int = 3,
          blocks: DataFrame | None = None) -> Model:
    blocks = numbered(docs) if blocks is None else blocks
    head, table = _class_table(words)
    size, kinds, once, twice = table.sum(axis=1).T.astype(float)
    discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
    discount[:1 + HEAD] = 0
    weights = fit_weights(_class_counts(blocks, head), size, rounds, ridge)
    mass = table[:, :, 0] - discount[:, None] * table[:, :, 1]
    prior, tokens = leaf_prior(mass[1 + HEAD:]), int(size.sum())
    word_weights = fit_word_weights(docs, head, prior, word_rows(tokens), word_rounds, ridge, blocks)
    return Model(head, tokens, int(kinds.sum()), size, kinds, discount, weights.astype(np.float32),
                 np.r_[mass[:1 + HEAD, 0], mass[1 + HEAD:].reshape(-1)], prior, word_weights)


def word_logs(model: Model, classes: np.ndarray, counts: np.ndarray, leaves: np.ndarray | None = None) -> np.ndarray:
    """log10 p(seen | class) p(word | leaf) of words with these training counts (without leaves: p(word | class)); count 0: log10
    p(not seen | class)."""
    size, d = model.sizes[classes], model.discount[classes]
    lost = d * model.kinds[classes]
    mass = size - lost if leaves is None else model.mass[leaves]
    known = (size - lost) / np.maximum(size, 1) * (counts - d) / np.maximum(mass, 1e-9)
    unseen = np.where(size > 0, lost / np.maximum(size, 1), 1.0)
    p = np.where(counts > 0, known, unseen)
    return np.where(classes <= HEAD, 0.0, np.log10(np.maximum(p, 1e-300)))


def leaf_logs(model: Model, lexicon: Lexicon, numbers: np.ndarray, starts: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """log10 p(leaf | class, history) of each token; 0 for a class of one word and for words not seen."""
    out = np.zeros(len(numbers))
    for at, node, digit, features in leaf_choices(lexicon, numbers, starts, len(model.word_weights), seen):
        for lo in range(0, len(at), CHOICES):
            part = slice(lo, lo + CHOICES)
            x = digit_scores(model.prior, model.word_weights, node[part], [f[part] for f in features])
            own = x[np.arange(len(x)), digit[part]]
            out[at[part]] += (own - np.log(np.exp(x, out=x) @ ONES)) / np.log(10)
    return out


def score(docs: DataFrame, words: DataFrame, model: Model, blocks: DataFrame | None = None) -> DataFrame:
    """Scores of all documents, block by block, from the block's numbers and the counts it asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: features by classes, MAX_WORD_ROWS

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        own = shared.value
        logs = class_logs(own.weights, np.arange(STATES * STATES)) / np.log(10)
        ((ids, training, lengths, numbers, *stored_words),) = rows_of(
            block.to_batches(), "ids", "training", "lengths", "numbers", "hashed", "tail", "code")
        training, lengths, numbers = np.array(training, bool), np.frombuffer(lengths, np.int64), np.frombuffer(numbers, np.uint32)
        lexicon = Lexicon.stored(*stored_words, own.head)
        kind = lexicon.kind
        n = np.bincount(numbers[np.repeat(training, lengths)], minlength=len(kind)).astype(np.int64)
        n[counts.column("place").to_numpy()] = counts.column("c").to_numpy()
        base = np.log10((n + 0.1) / (own.tokens + 0.1 * (own.types + 1)))
        inner = word_logs(own, kind, n, lexicon.leaves())
        out = {k: np.zeros(len(ids)) for k in ("base", "score", "known")}
        for which, own_tokens, starts in _steps(numbers, lengths):
            classes = kind[own_tokens]
            total = logs[states_before(classes, starts), classes] + inner[own_tokens] + leaf_logs(own, lexicon, own_tokens, starts, n > 0)
            for name, x in (("base", base[own_tokens]), ("score", total), ("known", (n[own_tokens] > 0).astype(float))):
                out[name][which] = np.add.reduceat(x, starts)
        return pa.table([pa.array(ids, pa.int64()), pa.array(~training), pa.array(lengths), pa.array(out["known"].astype(np.int64)),
                         pa.array(np.full(len(ids), own.tokens)), pa.array(out["base"]), pa.array(out["score"])],
                        [x.split()[0] for x in SCHEMA.split(", ")])

    rows = _block_rows(numbered(docs) if blocks is None else blocks)
    asked = words.where("c <> n").select("block", "place", "c")
    return rows.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, SCHEMA)


def score_documents(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, rounds: int = 12) -> DataFrame:
    """Trains on the rows where ``training`` holds and scores all rows."""
    rows = _documents(docs, id_col, text_col, training)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    numbers = numbered(rows)
    words = word_table(rows, blocks, numbers)
    return score(rows, words, train(rows, words, rounds, blocks=numbers), numbers)
