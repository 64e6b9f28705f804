import itertools
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from textloom.llm.mixing import targets

from conftest_llm import ascii_lower, words
from test_simhash import brute_fingerprint, roots_of

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(r)[:4] for r in rows), key=str)


def test_language_stage_drops_only_texts_without_a_language(spark, edge, edge_docs):
    out = P.language_id(spark, edge, "")
    assert out.columns == edge.columns
    kept = {r.text for r in out.collect()}
    assert not kept & {None, "", " \t\n"}
    assert {d[1] for d in edge_docs if d[2] in ("en", "fr") and len(words(d[1])) > 30} <= kept


def test_exact_stage_keeps_the_largest_id(spark, edge, edge_docs):
    out = P.exact_copies(spark, edge, "")
    best = {}
    for d in edge_docs:
        t = ascii_lower(d[1])
        if t not in best or (d[0] is not None and (best[t][0] is None or d[0] > best[t][0])):
            best[t] = d
    assert out.columns == edge.columns
    assert sorted((str(r.doc_id), ascii_lower(r.text)) for r in out.collect()) == sorted((str(d[0]), t) for t, d in best.items())


def test_near_stage_keeps_one_of_each_component(spark, edge, edge_docs):
    out = P.near_copies(spark, edge, "")
    fps = {brute_fingerprint(d[1]) for d in edge_docs}
    root = roots_of(fps, [p for p in itertools.combinations(fps, 2) if bin(p[0] ^ p[1]).count("1") <= 3])
    least = {}
    for d in edge_docs:
        k, i = root[brute_fingerprint(d[1])], (d[0] is None, d[0] or 0)
        least[k] = min(least.get(k, i), i)
    got = {root[brute_fingerprint(r.text)]: (r.doc_id is None, r.doc_id or 0) for r in out.collect()}
    assert out.columns == edge.columns and got == least and out.count() == len(least)


def test_mixing_stage_repeats_rows(spark, edge, edge_docs):
    out = P.mix_sources(spark, edge, "")
    assert out.columns == edge.columns
    sizes, taken = Counter(), Counter()
    for d in edge_docs:
        sizes[d[3]] += len(words(d[1]))
    for r in out.collect():
        taken[r.source] += len(words(r.text))
    want = targets(sizes, (5, 2, 1), sum(sizes.values()))
    for s in sizes:
        longest = max(len(words(d[1])) for d in edge_docs if d[3] == s)
        assert abs(taken[s] - want[s]) <= longest
    assert max(Counter(map(str, (tuple(r) for r in out.collect()))).values()) <= 9  # three times a row that is there three times


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_stages_take_empty_tables(spark, no_docs, stage):
    out = stage(spark, no_docs, "")
    assert out.count() == 0
    if stage is not P.STAGES[-1][1]:
        assert out.columns == no_docs.columns


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    left = Counter(r.doc_id for r in docs.collect())
    pieces = defaultdict(list)
    for r in P.run(spark, SF).collect():
        pieces[r.doc_id].append(r)
    assert pieces.keys() == left.keys() and len(left) > 50
    for doc_id, own in pieces.items():
        assert sum(r.length for r in own) == left[doc_id] * own[0].doc_tokens


NAMES = ["_n", "_own", "_h", "_pattern", "_l_id", "_row", "c0", "number", "stay", "l_id", "kept"]


@pytest.mark.parametrize("stage", [P.language_id, P.exact_copies, P.near_copies, P.mix_sources])
def test_stages_leave_columns_of_any_name_alone(spark, edge_docs, stage):
    rows = [(*d[:4], d[4], *range(50, 50 + len(NAMES))) for d in edge_docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in NAMES)
    out = stage(spark, spark.createDataFrame(rows, schema), "")
    assert out.columns[5:] == NAMES
    got = out.collect()
    assert got and {tuple(r)[5:] for r in got} == {tuple(range(50, 50 + len(NAMES)))}


def test_stages_send_texts_in_batches_of_bounded_bytes(spark, edge):
    """Ten thousand texts of any length at a time took most of an executor's memory."""
    import pyarrow as pa

    session = spark.newSession()
    docs = session.range(0, 4000, 1, 1).selectExpr("id", "repeat('abcdefgh', 1000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    P.near_copies(session, session.createDataFrame([], edge.schema), "")
    got = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 6 << 20
