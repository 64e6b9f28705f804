import itertools
import random

import pytest
from pyspark.sql import functions as F

from textloom.llm.mixing import mix, mix_documents, mixed_rows, route, targets, word_count

from conftest_llm import words


def test_targets_share_the_excess_of_capped_sources():
    out = targets({"a": 10, "b": 1000, None: 500}, (5, 2, 1), 1510)
    assert out["a"] == 30 and out["b"] == pytest.approx(1480 * 2 / 3) and out[None] == pytest.approx(1480 / 3)
    assert sum(out.values()) == pytest.approx(1510)
    assert targets({}, (5, 2, 1), 0) == {} and targets({"a": 0}, (5,), 0) == {"a": 0}


def cost(sizes, amounts):
    total = 0
    for p, n in amounts.items():
        for r in range(3):
            step = min(sizes[p], n)
            total += r * step
            n -= step
    return total


def test_route_is_a_cheapest_maximum_flow():
    rng = random.Random(5)
    for _ in range(60):
        members = {p: tuple(rng.sample("xyz", rng.randint(1, 3))) for p in "ABC"[:rng.randint(1, 3)]}
        sizes = {p: rng.randint(0, 3) for p in members}
        quota = {s: rng.randint(0, 5) for s in "xyz"}
        got = route(sizes, members, quota)
        best = None
        for amounts in itertools.product(*(range(3 * sizes[p] + 1) for p in members)):
            amounts = dict(zip(members, amounts))
            # Hall's condition: what only a set of sources can take must fit into their quotas
            if all(sum(n for p, n in amounts.items() if set(members[p]) <= set(s)) <= sum(quota[x] for x in s)
                   for k in range(1, 4) for s in itertools.combinations("xyz", k)):
                key = (-sum(amounts.values()), cost(sizes, amounts))
                best = key if best is None else min(best, key)
        assert (-sum(got.values()), cost(sizes, got)) == best


def test_documents_come_near_their_targets(spark, edge, edge_docs, no_docs):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 20)), rng.choice(["a", "b", "c", None, "a", "a"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_documents(docs).collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    size = {i: len(words(t)) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    for s in ("a", "b", "c", None):
        own = [r for r in out if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 20
        assert all(r.taken <= 3 * r.size == 3 * size[r.doc_id] and r.source_size == sum(x.size for x in own) for r in own)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mix_documents(docs.repartition(5)).collect()), key=str)
    assert mix_documents(edge).count() == len(edge_docs)
    assert mix_documents(no_docs).count() == 0


def test_overlapping_sources(spark):
    rows = [(i, "w w", ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b", None, "b"]) for i in range(900)] + [(901, "w", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    out, lists, sizes, quota = mix(docs, F.col("tags"), word_count(), weights=(1, 1, 2))
    assert sizes == {"a": 1200, "b": 1200, None: 600} and sum(quota.values()) == pytest.approx(1801)
    assert abs(sum(r.taken for r in out.collect()) - 1801) <= 8
    assert all(r.taken == 0 for r in out.collect() if r.pattern == "[]")


def test_flow_runs_for_every_source(spark, monkeypatch):
    """The registered query's amounts come through the solver: paths are counted in it."""
    from textloom.llm import mixing
    from textloom.llm.queries import QUERIES

    steps, plain = [], mixing.route
    monkeypatch.setattr(mixing, "route", lambda *a: plain(*a, steps=steps))
    out = QUERIES["op6_source_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert len(steps) == len({r.target for r in out}) or len(steps) > 1
    assert all(steps) and sum(r.taken for r in out) > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sources_reach_their_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    out = mix_documents(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    for s in {r.source for r in out}:
        own = [r for r in out if r.source == s]
        short = round(own[0].target) - sum(r.taken for r in own)
        most = max(r.repeats for r in own)
        unused = [r.size for r in own if r.size and r.repeats < most or most == min(x.repeats for x in own) and r.size]
        assert 0 <= short and (20 * short <= own[0].target or short < min(unused))


def test_other_id_and_clashing_columns(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2], 99, 5, "p") for i in range(300)]
    docs = spark.createDataFrame(rows, "key long, body string, source string, size int, h int, pattern string")
    out = mix_documents(docs, id_col="key", text_col="body")
    assert out.columns[0] == "key" and out.count() == 300
    again = mixed_rows(docs, F.array("source"), id_col="key", text_col="body")
    times = {r.key: r.repeats for r in out.collect()}
    assert again.columns == docs.columns
    got = [tuple(r) for r in again.collect()]
    assert sorted(got) == sorted(r for r in rows for _ in range(times[r[0]]))


def test_joined_sources_have_a_bound(monkeypatch):
    from textloom.llm import mixing

    monkeypatch.setattr(mixing, "MAX_JOINED", 2)
    members = {"A": ("x",), "B": ("x", "y"), "C": ("y",)}
    with pytest.raises(ValueError):
        route({p: 1 for p in members}, members, {"x": 1, "y": 1})
    assert route({"A": 5, "C": 5}, {"A": ("x",), "C": ("y",)}, {"x": 7, "y": 4}) == {"A": 7, "C": 4}
