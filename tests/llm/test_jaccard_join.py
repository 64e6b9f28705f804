import random

import numpy as np
import pytest
from conftest_llm import ascii_lower, words

from textloom.llm import jaccard_join as jj


def sets_of(text):
    w = words(ascii_lower(text))
    return {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(rows, percent=90):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                i = len(sets[a] & sets[b])
                if 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def joined(df, **kw):
    out = jj.jaccard_components(df, **kw)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_edge_tables(spark, edge, edge_docs, no_docs):
    assert joined(edge) == brute([r[:2] for r in edge_docs])
    assert joined(no_docs) == []


@pytest.fixture(scope="module")
def groups():
    """Near copies around a text, chains of small edits, a shared passage in many texts, and texts of common lines only."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, base = [], [word() for _ in range(120)]
    for _ in range(70):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 1, 2, 3])):
            w[at] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(90)]
    for k in range(30):
        chain[k * 3] = word()
        rows.append(" ".join(chain))
    passage = [word() for _ in range(50)]
    rows += [" ".join([word() for _ in range(60)] + passage + [word() for _ in range(40)]) for _ in range(60)]
    lines = [" ".join(word() for _ in range(12)) for _ in range(6)]
    rows += ["\n".join(rng.sample(lines, 5)) for _ in range(60)]
    rows += [rows[0].upper(), rows[0].replace(" ", "  \t"), "one", "ONE", "one two", "one  two", "", " "]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("kw", [{}, {"hot": 2, "block": 900}, {"rare": 1, "most": 3}, {"hot": 8, "rare": 4, "block": 10**6}])
def test_equals_brute_force(spark, groups, kw):
    df = spark.createDataFrame(groups, "doc_id long, text string").repartition(5)
    assert joined(df, **kw) == brute(groups)


def test_prefixes_share_what_they_promise():
    """For any two sets that link, own choices of m leave enough shared prefix shingles."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(4, 200))
        x = np.unique(rng.integers(0, 10 ** 9, n))
        y = np.unique(np.r_[x[rng.random(len(x)) > rng.choice([0, 0.02, 0.05])], rng.integers(0, 10 ** 9, int(rng.integers(0, 4)))])
        shared = len(np.intersect1d(x, y))
        if not len(y) or 100 * shared < 90 * (len(x) + len(y) - shared):
            continue
        mx, my = int(rng.integers(1, 9)), int(rng.integers(1, 9))
        px, py = x[:jj.prefix_length(len(x), mx, 90)], y[:jj.prefix_length(len(y), my, 90)]
        need = -(-90 * (len(x) + len(y)) // 190)
        assert len(np.intersect1d(px, py)) >= need + min(len(px) - len(x), len(py) - len(y))


def test_longer_prefix_where_candidates_are_many():
    tokens = np.arange(100)
    few = jj.choose_prefix(tokens, np.array([3]), np.array([2]), 100, 8, 20, 90)
    many = jj.choose_prefix(tokens, np.arange(11), np.full(11, 15), 100, 8, 20, 90)
    assert few[0] < many[0] and len(many[1]) == 10 + many[0]


def test_links_of_a_block_join_groups_only():
    base = np.arange(200)
    rows = [(k, 200, 28, np.r_[base[k % 2:200], [10_000 + k] * (k % 2)], 0) for k in range(50)]
    assert len(jj.link_classes(rows, 90, True)) == 49
