"""Language identification of code-switched text with a linear-chain conditional random field.

Each word of a text gets a language. A word's score for a language is the sum of learned weights of its features:
letter bigrams and trigrams (those at the word's ends include its border), affixes of three letters, and the word
itself when it is in the lexicon of frequent training words. Transition weights between the languages of
neighbouring words are learned with them. Label probabilities are those of the forward-backward algorithm; a
document's shares are their means over its words with letters, and its language is the largest share.

Training rows are a sample bounded by ``docs_per_label`` for each label, drawn by a hash of the id; whole texts
are used. They are spliced into sequences that switch documents every few words, so that transitions between
languages occur. The gradient of the log-likelihood is summed over blocks in Spark; the driver holds the weights
(``BUCKETS`` and the lexicon, by labels) and nothing that grows with the corpus. Every label is learned; more labels
than ``max_labels`` are an error.

Forward-backward runs over many texts at once: texts are cut into pieces of ``PIECE`` words, the pieces' products
of transfer matrices are chained, and then all pieces are finished side by side. The result is that of the plain
recursion over the whole text.

Edge rows: a null text, or one without a letter, is ``und`` with score 0. Ids, labels and other columns are never
used in a prediction. Null labels don't train. Without any training row all rows are ``und``. Repeated rows are
predicted alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from textloom.llm.common import rows_of, stored

BUCKETS = 1 << 15
LEXICON = 4096
PIECE = 64
#: Words between two switches of a training sequence, and words of a training sequence.
SPLICE, SEQUENCE = 40, 640
#: Words whose scores a task keeps; the store starts anew beyond it.
KEPT_TYPES = 100_000
#: Word scores (words by labels) that are labelled at a time.
STEP_SCORES = 250_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(types: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature bucket) of every n-gram and affix of the words, and which words have letters."""
    code = np.frombuffer(("\n" + "\n".join(types) + "\n").encode("utf-32-le"), np.uint32)
    code = code[(code == 10) | _letters()[code]].astype(np.uint64)
    edge = code == 10
    word = np.cumsum(edge) - 1
    has = np.zeros(len(types) + 1, bool)
    has[word[~edge]] = True
    own, hashed = [], []
    for n in (2, 3, 4):
        if len(code) < n:
            continue
        parts = [slice(k, len(code) - n + 1 + k) for k in range(n)]
        keep = ~np.logical_or.reduce([edge[p] for p in parts[1:-1]]) if n > 2 else ~(edge[parts[0]] & edge[parts[1]])
        if n == 4:  # affixes: one end is the word's border
            keep &= edge[parts[0]] ^ edge[parts[3]]
        h = np.full(int(keep.sum()), n, np.uint64)
        for p in parts:
            h = (h ^ code[p][keep]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        own.append(word[parts[0]][keep])
        hashed.append((h % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(own), np.concatenate(hashed), has[:len(types)]


def words_of(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets and lexicon, by label
    transitions: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)


def emissions(types: list[str], weights: np.ndarray, lexicon: dict[str, int], found: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    own, hashed, has = found or features(types)
    out = np.stack([np.bincount(own, w[hashed], len(types)) for w in weights.T], axis=1)
    known = np.fromiter((lexicon.get(t, -1) for t in types), np.int64, len(types))
    out[known >= 0] += weights[BUCKETS + known[known >= 0]]
    return out, has


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Label probabilities of the words of texts that lie one after another; with ``pairs`` also the expected
    number of each transition."""
    n, labels = scores.shape
    pieces = -(-lengths // PIECE)
    first = np.cumsum(pieces) - pieces
    total = int(pieces.sum())
    begin = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(n) - begin[text]
    row, col = first[text] + inside // PIECE, inside % PIECE
    e = np.zeros((PIECE, labels, total))  # pieces last: every operation runs along them
    e[col, :, row] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real = np.zeros((PIECE, total), bool)
    real[col, row] = True
    step = np.exp(transitions - transitions.max())
    starts = np.zeros(total, bool)
    starts[first] = True

    def forward(state: np.ndarray, t: int) -> np.ndarray:
        """One word further: state (labels, anything, pieces), scaled to a largest value of 1."""
        moved = (step.T @ state.reshape(labels, -1)).reshape(state.shape)
        if t == 0:
            moved = np.where(starts, state, moved)
        moved *= e[t][:, None]
        size = moved.max(axis=(0, 1))
        return np.where(real[t], moved / np.where(real[t], size, 1), state)

    product = np.repeat(np.eye(labels)[:, :, None], total, axis=2)  # label now, label before the piece
    for t in range(PIECE):
        product = forward(product, t)
    enter, leave = np.ones((labels, total)), np.ones((labels, total))
    for k in range(1, int(pieces.max(initial=0))):
        at = first[pieces > k] + k
        x = np.einsum("ip,jip->jp", enter[:, at - 1], product[:, :, at - 1])
        enter[:, at] = x / x.max(axis=0)
    for k in range(int(pieces.max(initial=0)) - 1, 0, -1):
        at = first[pieces > k] + k
        x = np.einsum("jip,jp->ip", product[:, :, at], leave[:, at])
        leave[:, at - 1] = x / x.max(axis=0)

    alpha = np.empty((PIECE, labels, total))
    state = enter[:, None]
    for t in range(PIECE):
        state = forward(state, t)
        alpha[t] = state[:, 0]
    beta, ahead = np.empty((PIECE, labels, total)), leave
    for t in range(PIECE - 1, -1, -1):
        beta[t] = ahead
        x = step @ (e[t] * ahead)
        size = x.max(axis=0)
        ahead = np.where(real[t], x / np.where(size > 0, size, 1), ahead)
    both = alpha * beta
    out = (both / both.sum(axis=1, keepdims=True).clip(1e-300))[col, :, row]
    if not pairs:
        return out
    before = np.concatenate([enter[None], alpha[:-1]])[col, :, row]
    after = (e * beta)[col, :, row]
    inner = inside > 0
    norm = ((before @ step) * after).sum(axis=1)
    expected = step * (before[inner].T @ (after[inner] / norm[inner].clip(1e-300)[:, None]))
    return out, expected


def _block_arrays(pairs: list[tuple[str, int]]) -> tuple:
    """Training sequences of one block: word types, their features, and per word its type and label."""
    rng = np.random.default_rng(0)
    spans = []
    for text, label in pairs:
        w = words_of(text)
        spans += [(w[k:k + SPLICE], label) for k in range(0, len(w), SPLICE)]
    order = rng.permutation(len(spans))
    place: dict[str, int] = {}
    types, gold = [], []
    for i in order:
        for w in spans[i][0]:
            types.append(place.setdefault(w, len(place)))
            gold.append(spans[i][1])
    return list(place), np.array(types, np.int32), np.array(gold, np.int32)


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
          docs_per_label: int = 200, max_labels: int = 200, blocks: int = 12, rounds: int = 16, rate: float = 0.2,
          ridge: float = 1e-6) -> Model:
    """Fits a model to at most about ``docs_per_label`` documents of each label (a documented bound). All labels are
    learned; more than ``max_labels``, whose weights the driver would have to hold, are an error."""
    named = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["label"]: r["n"] for r in named.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
              .limit(max_labels + 1).collect()}
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels; a larger max_labels takes more driver memory")
    labels = sorted(counts)
    if not labels:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(s, k, min(1.0, docs_per_label / counts[s])) for k, s in enumerate(labels)], "label string, k int, part double")
    draw = F.xxhash64(F.lit("train"), F.col(id_col), F.col(text_col))
    sample = (named.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), draw.alias("h"))
              .join(F.broadcast(wanted), "label")
              .where(F.pmod("h", F.lit(1 << 20)) < F.col("part") * (1 << 20))
              .select("text", "k", F.pmod(F.shiftright("h", 24), F.lit(blocks)).alias("block")))

    def prepare(table: pa.Table) -> pa.Table:
        """A block of the bounded sample as arrays: one row."""
        pairs = sorted(zip(table.column("text").to_pylist(), table.column("k").to_pylist()))
        types, of, gold = _block_arrays(pairs)
        return pa.table([pa.array([types], pa.list_(pa.string())), pa.array([of], pa.list_(pa.int32())), pa.array([gold], pa.list_(pa.int32()))],
                        ["types", "of", "gold"])

    data = stored(sample.groupBy("block").applyInArrow(prepare, "types array<string>, of array<int>, gold array<int>"), "crf-blocks")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for types, of in rows_of(batches, "types", "of"):
            n = np.bincount(of, minlength=len(types))
            yield pa.RecordBatch.from_arrays([pa.array(types, pa.string()), pa.array(n, pa.int64())], ["w", "n"])

    frequent = (data.select("types", "of").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
                .where(F.col("n") > 1).orderBy(F.desc("n"), "w").limit(LEXICON).collect())
    lexicon = {r["w"]: i for i, r in enumerate(frequent)}
    shape = (BUCKETS + len(lexicon), len(labels))

    def gradient(weights: np.ndarray, transitions: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for types, of, gold in rows_of(batches, "types", "of", "gold"):
                if not of:
                    continue
                own, hashed, _ = found = features(types)
                known = np.fromiter((lexicon.get(t, -1) for t in types), np.int64, len(types))
                scores, _ = emissions(types, weights, lexicon, found)
                of, gold = np.array(of), np.array(gold)
                lengths = np.diff(np.r_[np.arange(0, len(of), SEQUENCE), len(of)])
                p, moves = marginals(scores[of], lengths, transitions, pairs=True)
                p[np.arange(len(of)), gold] -= 1
                by_type = np.stack([np.bincount(of, -x, len(types)) for x in p.T], axis=1)
                g = np.zeros(shape)
                for k in range(shape[1]):
                    g[:BUCKETS, k] = np.bincount(hashed, by_type[own, k], BUCKETS)
                hit = known >= 0
                g[BUCKETS + known[hit]] += by_type[hit]
                seen = np.zeros_like(moves)
                inner = np.arange(1, len(of))[np.arange(1, len(of)) % SEQUENCE != 0]
                np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
                yield pa.RecordBatch.from_arrays([pa.array([g.astype(np.float32).tobytes()], pa.binary()), pa.array([(seen - moves).tobytes()], pa.binary()),
                                                  pa.array([len(of)], pa.int64())], ["g", "t", "n"])
        return run

    spread = data.repartition(blocks)
    weights, transitions = np.zeros(shape), np.zeros((len(labels),) * 2)
    slow = [np.zeros(shape), np.zeros_like(transitions)]
    square = [np.zeros(shape), np.zeros_like(transitions)]
    for r in range(1, rounds + 1):
        parts = spread.mapInArrow(gradient(weights, transitions), "g binary, t binary, n long").collect()  # a row per block
        n = sum(x["n"] for x in parts)
        if not n:
            break
        grads = [sum(np.frombuffer(x["g"], np.float32).reshape(shape).astype(float) for x in parts) / n - ridge * weights,
                 sum(np.frombuffer(x["t"]).reshape(transitions.shape) for x in parts) / n - ridge * transitions]
        for k, (value, g) in enumerate(zip((weights, transitions), grads)):
            slow[k] = 0.9 * slow[k] + 0.1 * g
            square[k] = 0.95 * square[k] + 0.05 * g * g
            value += rate * (slow[k] / (1 - 0.9 ** r)) / (np.sqrt(square[k] / (1 - 0.95 ** r)) + 1e-7)
    return Model(labels, weights, transitions, lexicon)


class _Places(dict):
    """word -> its number, given at first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class _Scores:
    """Scores of words met so far in a task."""

    def __init__(self, model: Model):
        self.model, self.place = model, _Places()
        self.scores, self.has = np.zeros((0, len(model.labels))), np.zeros(0, bool)

    def rows(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.place) > KEPT_TYPES:
            self.__init__(self.model)
        known = len(self.place)
        out = np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        fresh = list(islice(self.place, known, None))
        if fresh:
            scores, has = emissions(fresh, self.model.weights, self.model.lexicon)
            if len(self.place) > len(self.has):
                more = 2 * len(self.place) - len(self.has)
                self.scores = np.concatenate([self.scores, np.zeros((more, self.scores.shape[1]))])
                self.has = np.concatenate([self.has, np.zeros(more, bool)])
            self.scores[known:len(self.place)], self.has[known:len(self.place)] = scores, has
        return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_words: bool = False,
            keep: tuple[str, ...] = (), id_out: str | None = None) -> DataFrame:
    """(id, lang_pred, score) per row and the columns to ``keep``, which pass by unread; ``with_words`` adds the
    label of every word (null: no letter)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: buckets and lexicon, by labels
    rows = docs.select(*keep, F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    passed = rows.drop("_text").schema
    schema = passed.add("lang_pred", "string").add("score", "double")
    if with_words:
        schema = schema.add("word_labels", ArrayType(StringType()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        store, step = _Scores(own), STEP_SCORES // max(1, len(own.labels))

        def label(head: list[pa.Array], texts: list[list[str]]) -> pa.RecordBatch:
            langs, scores, tags = ["und"] * len(texts), [0.0] * len(texts), [[None] * len(w) for w in texts]
            full = [i for i, w in enumerate(texts) if w and own.labels]
            if full:
                rows = store.rows([texts[i] for i in full])
                lengths = np.array([len(texts[i]) for i in full])
                p = marginals(store.scores[rows], lengths, own.transitions)
                has = store.has[rows]
                begin = np.cumsum(lengths) - lengths
                mass = np.add.reduceat(p * has[:, None], begin)
                n = np.add.reduceat(has.astype(np.int64), begin)
                for i, m, k, b in zip(full, mass, n, begin):
                    if k:
                        langs[i], scores[i] = own.labels[int(m.argmax())], min(1.0, float(m.max() / k))
                    if with_words:
                        tags[i] = [own.labels[x] if h else None for x, h in zip(p[b:b + len(texts[i])].argmax(axis=1), has[b:b + len(texts[i])])]
            cols = [*head, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays(cols + ([pa.array(tags, pa.list_(pa.string()))] if with_words else []), names)

        for b in batches:
            head, texts, n, at = b.columns[:-1], [], 0, 0
            for i, (text,) in enumerate(rows_of([b], "_text"), 1):
                texts.append(words_of(text))
                n += len(texts[-1]) + PIECE
                if n >= step or i == b.num_rows:
                    yield label([c.slice(at, i - at) for c in head], texts)
                    texts, n, at = [], 0, i

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_out or id_col)
