import inspect
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from textloom.llm import maxent_lm
from textloom.llm.common import training_row
from textloom.llm.maxent_lm import (CLASSES, END, FEATURES, HEAD, LEAVES, MAX_WORD_ROWS, NODES, RADIX, STATES, TAIL, Lexicon, Model, _documents,
                                    class_logs, features_of, fit_weights, fit_word_weights, leaf_choices,
                                    leaf_code, leaf_code_column, leaf_logs, leaf_prior, score, score_documents, states_before,
                                    tail_class, tail_class_column, train, word_logs, word_rows, word_table)

from conftest_llm import ascii_lower, words


def trains(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def brute(rows):
    tokens = [(d[0], [*words(ascii_lower(d[1])), "\n"]) for d in rows]
    count = Counter(w for i, t in tokens if trains(i) for w in t)
    n, v = sum(count.values()), len(count)
    return sorted(((i, not trains(i), len(t), sum(count[w] > 0 for w in t), n,
                    round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in tokens), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 24, 4000])
def test_counts_and_base_score_equal_brute_force(edge, edge_docs, no_docs, block_bytes):
    out = score_documents(edge, training_row("doc_id", 10), block_bytes=block_bytes, rounds=2).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str)
    assert got == brute(edge_docs)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert score_documents(no_docs, training_row("doc_id", 10)).count() == 0


def test_no_training_row(edge, edge_docs):
    out = score_documents(edge.where("doc_id IS NOT NULL"), edge.doc_id < 0, rounds=2).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in out} == {(0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in out)


def test_model_beats_the_unigram_on_held_out_text(spark):
    rng = random.Random(3)
    vocab = [["a", "b", "c", "dog", "cat"], ["un", "deux", "trois", "chien", "chat"]]
    rare = ["".join(rng.choices("klmnop", k=5)) for _ in range(3000)]

    def text(i):
        own, out = vocab[i % 2], [0]
        for _ in range(rng.randint(20, 120)):
            out.append((out[-1] + rng.choice([1, 1, 1, 2])) % 5)
        return " ".join(own[k] if rng.random() < 0.9 else rng.choice(rare) for k in out)

    docs = spark.createDataFrame([(i, text(i)) for i in range(600)], "doc_id long, text string")
    held = [r for r in score_documents(docs, training_row("doc_id", 10)).collect() if r.held_out]
    per = lambda k: sum(r[k] for r in held) / sum(r.n_tokens for r in held)
    assert len(held) > 30 and per("score") > per("base_score") + 0.3


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 1, (FEATURES, CLASSES))
    pairs = np.arange(0, STATES * STATES, 7)
    assert np.allclose(np.exp(class_logs(weights, pairs)).sum(axis=1), 1)
    sizes, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    counts = np.array([5, 2, 1, 1])
    k = 1 + HEAD
    sizes[k], kinds[k] = counts.sum(), len(counts)
    discount = np.full(CLASSES, 0.4)
    model = Model([], 9, 4, sizes, kinds, discount, weights)
    p = 10 ** word_logs(model, np.full(5, k), np.r_[counts, 0])
    assert p.sum() == pytest.approx(1)
    assert 10 ** word_logs(model, np.array([k + 1]), np.array([0]))[0] == pytest.approx(1)  # a class without words


def test_states_and_features():
    classes = np.array([3, 4, 0, 0, 5, 0])  # texts: [3 4 end], [end], [5 end]
    got = states_before(classes, np.array([0, 3, 4]))
    none = CLASSES
    assert got.tolist() == [none * STATES + none, none * STATES + 3, 3 * STATES + 4, none * STATES + none, none * STATES + none, none * STATES + 5]
    assert features_of(got).shape == (6, 4) and len(set(features_of(got)[:, 0])) == 1


def test_tail_class_is_the_same_in_both_engines(spark):
    own = [b"a", b"ab", b"abc", "é".encode(), "xß".encode(), b"."]
    df = spark.createDataFrame([(w,) for w in own], "word binary")
    assert [r[0] for r in df.select(tail_class_column(df.word)).collect()] == [tail_class(w) for w in own]
    assert all(1 + HEAD <= tail_class(w) < 1 + HEAD + TAIL for w in own)


def test_table_and_rounds_hold_the_features():
    raw = 1 + 2 * STATES + STATES ** 2
    used = np.unique(features_of(np.arange(STATES * STATES)))
    assert FEATURES >= 8192 and len(used) > 0.6 * raw  # 4096 buckets: at most 43 % have one
    assert all(inspect.signature(f).parameters["rounds"].default >= 12 for f in (score_documents, train))


def test_weights_equal_dense_updates(spark):
    rng = np.random.default_rng(2)
    pairs = rng.choice(STATES * STATES, 300, replace=False)
    rows = [(int(p), sorted(rng.choice(CLASSES, 3, replace=False).tolist()), rng.integers(1, 50, 3).tolist()) for p in pairs]
    n = np.zeros((len(rows), CLASSES))
    for i, (_, k, x) in enumerate(rows):
        n[i, k] = x
    totals = n.sum(axis=0)
    weights = np.zeros((FEATURES, CLASSES))
    weights[features_of(np.zeros(1, np.int64))[0, 0]] = np.log((totals + 0.5) / (totals + 0.5).sum())
    for _ in range(3):
        p = np.exp(class_logs(weights, pairs))
        size = n.sum(axis=1, keepdims=True)
        g, h = np.zeros((2, FEATURES, CLASSES))
        for f in features_of(pairs).T:
            np.add.at(g, f, n - size * p)
            np.add.at(h, f, size * p * (1 - p))
        weights = weights + np.clip(0.3 * (g - 2.0 * weights) / (h + 2.5), -0.7, 0.7)
    got = fit_weights(spark.createDataFrame(rows, "pair long, classes array<long>, counts array<long>"), totals, 3, 2.0)
    assert np.allclose(got, weights, atol=1e-3)


def _prose(n, seed=5):
    """Texts of common words and words that few texts have."""
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    own = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    return [(i, " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(own) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def _fit(spark, rows):
    docs = _documents(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", training_row("doc_id", 10))
    docs = docs.selectExpr("*", "0L AS block").cache()
    table = word_table(docs, 1)
    return docs, table, train(docs, table, rounds=2)


def _brute_score(model, text, count):
    """The model's score, word by word, in plain arithmetic."""
    head = {w: 1 + i for i, w in enumerate(model.head)}
    kind = lambda w: 0 if w == END else head.get(w) or tail_class(w)
    total, before = 0.0, []
    for w in [*text.encode().lower().split(), END]:
        k = kind(w)
        last = kind(before[-1]) if before else CLASSES
        skip = kind(before[-2]) if len(before) > 1 else CLASSES
        total += class_logs(model.weights, np.array([skip * STATES + last]))[0, k] / math.log(10)
        if k > HEAD:
            c, d, size = count.get(w, 0), model.discount[k], model.sizes[k]
            if not c:
                total += math.log10(d * model.kinds[k] / size) if size else 0
            else:
                lexicon = Lexicon.of([*before[-2:], w], model.head)
                for at, node, digit, rows in leaf_choices(lexicon, np.arange(len(lexicon.kind)), np.array([0]), len(model.word_weights)):
                    x = model.prior[node[-1]] + sum(model.word_weights[f[-1]] for f in rows)
                    assert at[-1] == len(lexicon.kind) - 1
                    total += math.log10(math.exp(x[digit[-1]]) / np.exp(x).sum())
                leaf = 1 + HEAD + (k - 1 - HEAD) * LEAVES + leaf_code(w)
                total += math.log10((1 - d * model.kinds[k] / size) * (c - d) / model.mass[leaf])
        before.append(w)
    return total


def test_score_equals_brute_force(spark):
    rows = _prose(120) + [(500, ""), (501, None), (502, "unheard of wordforms"), (503, "the"), (503, "the")]
    docs, table, model = _fit(spark, rows)
    count = Counter(w for i, t in rows if trains(i) for w in (t or "").encode().lower().split())
    got = sorted((r.doc_id, round(r.score, 4)) for r in score(docs, table, model).collect())
    want = sorted((i, round(_brute_score(model, t or "", count), 4)) for i, t in rows)
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=2e-3) and [i for i, _ in got] == [i for i, _ in want]


def test_word_probabilities_of_a_history_sum_to_one(spark):
    rows = _prose(200)
    docs, table, model = _fit(spark, rows)
    count = Counter(w for i, t in rows if trains(i) for w in t.encode().split())
    for history in ([], [b"the"], [b"nowhere", rows[3][1].split()[0].encode()]):
        words_ = sorted(count)
        kinds = Lexicon.of(words_, model.head).kind
        last = Lexicon.of(history, model.head).kind
        pair = np.array([(last[-2] if len(last) > 1 else CLASSES) * STATES + (last[-1] if len(last) else CLASSES)])
        classes = np.exp(class_logs(model.weights, pair))[0]
        total = classes[0]
        for w, k in zip(words_, kinds):
            lexicon = Lexicon.of([*history, w], model.head)
            inside = leaf_logs(model, lexicon, np.arange(len(lexicon.kind)), np.array([0]), np.ones(len(lexicon.kind), bool))[-1]
            total += classes[k] * 10 ** (inside + word_logs(model, np.array([k]), np.array([count[w]]), lexicon.leaves()[-1:])[0])
        unseen = 10 ** word_logs(model, np.arange(1 + HEAD, CLASSES), np.zeros(TAIL, int))
        total += (classes[1 + HEAD:] * unseen).sum() + classes[1 + len(model.head):1 + HEAD].sum()
        # what is left over is the bias of leaves without a training word
        assert total == pytest.approx(1, abs=0.02) and total <= 1 + 1e-6


def test_a_copy_scores_better_than_its_words_in_another_order(spark):
    rng = random.Random(11)
    rows = _prose(400)
    source = next(t for i, t in rows if trains(i) and len(t.split()) > 50)
    words_ = source.split()
    docs, table, model = _fit(spark, rows)
    same: dict[int, list[int]] = {}  # places whose words share a class, which the class model can't tell apart
    lexicon = Lexicon.of([w.encode() for w in words_], model.head)
    for i, k in enumerate(lexicon.kind):
        same.setdefault(int(k), []).append(i)
    shuffled = list(words_)
    for places in same.values():
        for i, j in zip(places, rng.sample(places, len(places))):
            shuffled[i] = words_[j]
    assert shuffled != words_ and sorted(shuffled) == sorted(words_)
    count = Counter(w for i, t in rows if trains(i) for w in t.encode().split())
    assert _brute_score(model, source, count) > _brute_score(model, " ".join(shuffled), count) + 1


def test_word_weights_equal_dense_updates(spark):
    rows = _prose(60, seed=8)
    texts = [t.encode().split() + [END] for i, t in rows if trains(i)]
    head, table_rows, ridge = [b"the", b"of"], 1 << 14, 2.0
    prior = leaf_prior(np.random.default_rng(1).integers(0, 9, (TAIL, LEAVES)).astype(float))
    weights = np.zeros((table_rows, RADIX))
    for _ in range(2):
        g, n = np.zeros((table_rows, RADIX)), np.zeros(table_rows)
        for t in texts:
            for _, node, digit, features in leaf_choices(Lexicon.of(t, head), np.arange(len(t)), np.array([0]), table_rows):
                for j in range(len(node)):
                    x = np.exp(prior[node[j]] + sum(weights[f[j]] for f in features))
                    for f in features:
                        g[f[j]] -= x / x.sum()
                        g[f[j], digit[j]] += 1
                        n[f[j]] += 1
        used = n > 0
        weights[used] += np.clip((g[used] - ridge * weights[used]) / (0.45 * n[used, None] + ridge), -1, 1)
    docs = _documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text", training_row("doc_id", 10))
    assert np.allclose(fit_word_weights(docs, head, prior, table_rows, 2, ridge), weights, atol=1e-3)
    assert (n > 1).sum() > 100 and NODES == len(prior)


def test_word_table_grows_with_the_corpus_up_to_its_bound():
    assert [word_rows(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 12)] == [1 << 14, 1 << 14, 1 << 17, MAX_WORD_ROWS]


def test_leaf_code_is_the_same_in_both_engines(spark):
    own = [b"a", b"abc", "é".encode(), b"longer-word", b"."]
    df = spark.createDataFrame([(w,) for w in own], "word binary")
    assert [r[0] for r in df.select(leaf_code_column(df.word)).collect()] == [leaf_code(w) for w in own]


def test_texts_are_split_once(spark):
    """All passes over the texts but the size and the numbering read the stored numbers."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    rows = _prose(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", F.udf(look, "string")("text"))
    assert score_documents(docs, training_row("doc_id", 10), rounds=2).count() == len(rows)
    assert seen.value == 2 * len(rows)


def test_numbered_blocks_give_the_words_of_any_bytes_back(spark):
    texts = [b"", b" \t\n", b"The the CAT", b" lead  and trail \x0b\x0c\r", "É é\x1cq\x85 日本語\xa0x".encode(), b"\xff\xfeA \xc3 \x00 b", None, b"the"]
    rows = [(i if i else None, bytearray(t) if t is not None else None, i % 3 != 0, i % 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text binary, training boolean, block long")
    docs = docs.selectExpr("doc_id", "coalesce(text, X'') AS text", "training", "block")
    table = maxent_lm.numbered(docs)
    want = {(None if i == 0 else i): [*(t or b"").lower().split(), END] for i, t in enumerate(texts)}
    got = {}
    for b in table.where("place IS NULL").collect():
        own = [bytes(r.word) for r in table.where(f"block = {b.block} AND place IS NOT NULL").orderBy("place").collect()]
        numbers, lengths = np.frombuffer(b.numbers, np.uint32), np.frombuffer(b.lengths, np.int64)
        assert own[0] == END and len(set(own)) == len(own)
        lexicon, plain = Lexicon.stored(b.hashed, b.tail, b.code, [b"the", b"b"]), Lexicon.of(own, [b"the", b"b"])
        for x, y in ((lexicon.kind, plain.kind), (lexicon.hashed, plain.hashed), (lexicon.leaves(), plain.leaves())):
            assert x.tolist() == y.tolist()
        for i, t, end, n in zip(b.ids, b.training, np.cumsum(lengths), lengths):
            got[i] = [own[k] for k in numbers[end - n:end]]
            assert t == ((i or 0) % 3 != 0)
        count = Counter(w for i, t in zip(b.ids, b.training) if t for w in want[i])
        assert {bytes(r.word): r.n for r in table.where(f"block = {b.block} AND n > 0").collect()} == dict(count)
    assert got == want
