import random

import numpy as np
import pytest

from textloom.llm.crf import BUCKETS, PIECE, Model, emissions, features, marginals, predict, train


def plain(scores, transitions):
    """Forward-backward over one text, word by word."""
    n = len(scores)
    a, b = np.zeros_like(scores), np.zeros_like(scores)
    a[0] = scores[0]
    for t in range(1, n):
        a[t] = scores[t] + np.logaddexp.reduce(a[t - 1][:, None] + transitions, axis=0)
    for t in range(n - 2, -1, -1):
        b[t] = np.logaddexp.reduce(transitions + scores[t + 1] + b[t + 1], axis=1)
    z = np.logaddexp.reduce(a[-1])
    moves = sum((np.exp(a[t - 1][:, None] + transitions + scores[t] + b[t] - z) for t in range(1, n)), np.zeros_like(transitions))
    return np.exp(a + b - z), moves


@pytest.mark.parametrize("labels", [1, 3])
def test_pieces_give_the_plain_recursion(labels):
    rng = np.random.default_rng(labels)
    lengths = np.array([1, PIECE, PIECE + 1, 3 * PIECE + 7, 2, 5 * PIECE])
    scores = rng.normal(0, 4, (lengths.sum(), labels))
    transitions = rng.normal(0, 2, (labels, labels)) + 3 * np.eye(labels)
    got, moves = marginals(scores, lengths, transitions, pairs=True)
    ends = np.cumsum(lengths)
    want = [plain(scores[e - n:e], transitions) for n, e in zip(lengths, ends)]
    assert np.allclose(got, np.concatenate([w[0] for w in want]))
    assert np.allclose(moves, sum(w[1] for w in want))


def test_features_are_the_words_own():
    words = ["abc", "12", "a", "x-y", "été"]
    own, hashed, has = features(words)
    assert has.tolist() == [True, False, True, True, True] and 1 not in own and hashed.max() < BUCKETS
    for i, w in enumerate(words):
        alone = features([w])
        assert sorted(hashed[own == i]) == sorted(alone[1])
    assert sorted(features(["xy"])[1]) == sorted(hashed[own == 3])  # only letters count
    # ^a ab bc c$, ^ab abc bc$, ^abc abc$
    assert (own == 0).sum() == 9 and (own == 2).sum() == 3


def test_lexicon_words_add_their_weight():
    weights = np.zeros((BUCKETS + 1, 2))
    weights[BUCKETS] = 1, 2
    assert emissions(["no", "yes"], weights, {"yes": 0})[0].tolist() == [[0, 0], [1, 2]]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    vocab = {"xx": ["der", "und", "schen", "keit", "zung"], "yy": ["les", "dans", "eux", "ment", "oir"], "zz": ["the", "ing", "tion", "wh", "ble"]}
    word = lambda s: "".join(rng.choices(vocab[s], k=rng.randint(1, 3)))
    rows = []
    for i in range(240):
        s = rng.choice(["xx", "xx", "yy", "zz"])
        rows.append((i, " ".join(word(s) for _ in range(rng.randint(3, 200))), s))
    mixed = " ".join([word("xx") for _ in range(30)] + [word("yy") for _ in range(60)])
    return rows, mixed


def test_held_out_accuracy_and_code_switching(spark, texts):
    rows, mixed = texts
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs.where("doc_id % 3 > 0"), rounds=12)
    test = spark.createDataFrame([(i, t) for i, t, _ in rows if i % 3 == 0] + [(1000, mixed), (1001, None), (1002, ""), (1003, "12 34 !"), (None, "der und"),
                                  (1004, " ".join([rows[0][1]] * 300))], "doc_id long, text string")
    out = {r.doc_id: r for r in predict(test, model, with_words=True).collect()}
    own = [out[i].lang_pred == s for i, _, s in rows if i % 3 == 0]
    assert sum(own) / len(own) > 0.98
    assert out[1000].lang_pred == "yy" and 0.55 < out[1000].score < 0.8
    assert sum(a == b for a, b in zip(out[1000].word_labels, ["xx"] * 30 + ["yy"] * 60)) >= 86
    assert all((out[k].lang_pred, out[k].score) == ("und", 0.0) for k in (1001, 1002, 1003))
    assert out[None].lang_pred == "xx" and out[1004].lang_pred == rows[0][2]
    assert predict(test.limit(0), model).count() == 0


def test_predictions_do_not_read_label_source_or_id(spark, texts):
    rows, _ = texts
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs, rounds=4)
    a = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model).collect()}
    other = docs.selectExpr("doc_id + 7 AS doc_id", "text", "'qq' AS lang", "'s' AS source")
    assert a == {r.doc_id - 7: (r.lang_pred, r.score) for r in predict(other, model).collect()}


def test_edge_tables(spark, edge, edge_docs, no_docs):
    model = train(edge, rounds=2)
    assert predict(edge, model).count() == len(edge_docs)
    none = train(no_docs)
    assert isinstance(none, Model) and none.labels == []
    assert {r.lang_pred for r in predict(edge, none).collect()} == {"und"}


def test_more_labels_than_the_bound_are_an_error(spark):
    docs = spark.createDataFrame([(i, f"word{i} text", f"l{i % 3}") for i in range(12)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 labels"):
        train(docs, max_labels=2, rounds=1)
    assert train(docs, max_labels=3, rounds=1).labels == ["l0", "l1", "l2"]


def test_word_scores_of_a_task_are_bounded():
    """600,000 different words: few of their scores are held at a time, and each is that of the word alone."""
    import textloom.llm.crf as C

    rng = np.random.default_rng(3)
    model = C.Model(["a", "b"], rng.normal(size=(C.BUCKETS, 2)), np.zeros((2, 2)))
    store = C._Scores(model)
    for k in range(10):
        own = [f"w{k}x{i}" for i in range(60_000)]
        rows = store.rows([own, own[:5]])
        assert len(store.scores) <= 400_000 and len(store.place) <= 200_000
        assert np.allclose(store.scores[rows[-5:]], C.emissions(own[:5], model.weights, {})[0])
