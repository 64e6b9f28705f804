from pyspark.sql import functions as F
import re
from collections import Counter, defaultdict

import pytest

from textloom.llm.line_frequency import line_frequency

from conftest_llm import ascii_lower, words


def normal(line):
    return " ".join(words(ascii_lower(line)))


def brute(rows, limit, share, least):
    carriers = defaultdict(set)
    for _, text, _, host, *_ in rows:
        for line in (text or "").split("\n"):
            if words(line):
                carriers[host, normal(line)].add(text)
    out = []
    for doc_id, text, _, host, *_ in rows:
        text = text or ""
        w, lines = words(text), [x for x in text.split("\n") if words(x)]
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {p for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
        common = [x for x in lines if len(carriers[host, normal(x)]) > limit]
        gone = sum(len(words(x)) for x in common)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        kept = not failed and 100 * (len(w) - gone) >= share * len(w) and len(w) - gone >= least
        clean = "\n".join(x for x in text.split("\n") if x not in common)
        out.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                    len(covered), failed, kept, gone, clean))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [0, 1000])
def test_equals_brute_force(spark, bound):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"{body(i)}\nShared  LINE here\n{body(i)[:40]}", None, "hot") for i in range(30)]
    rows += [(100 + i, "all rights Reserved # * |\n" * 9 + f"tail {i} " * 3, None, "hot") for i in range(9)]
    rows += [(200 + i, body(7) + "\nsame copy", None, "b") for i in range(40)]
    rows += [(300 + i, "shared line\there\n" + ("a b c d " * 20), None, None) for i in range(3)]
    rows += [(400 + i, " ".join(f"boiler{k}" for k in range(70)) + f"\nown {i} words", None, "c") for i in range(8)]
    rows += [(1, None, None, None), (None, "", None, "hot"), (None, " \t\x0b\n", None, "b"), (5, "é É\nÉ é\né É", None, "b"), (5, "é É\nÉ é\né É", None, "b"),
             (6, "word " * 20_000, None, "d"), (7, "\n".join(f"l{k} m n" for k in range(3000)), None, "d")]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, lang string, source string, h long, row long, lines string")
    out = line_frequency(docs, max_documents=5, max_share=None, broadcast_lines=bound, with_text=True)
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, 5, 30, 20)


def test_edge_tables(edge, edge_docs, no_docs):
    out = line_frequency(edge, max_documents=2, max_share=None, with_text=True)
    assert sorted(map(tuple, out.collect()), key=str) == brute(edge_docs, 2, 30, 20)
    assert line_frequency(no_docs).count() == 0


@pytest.mark.parametrize("bound", [0, 1000])
def test_share_of_the_host_behaves_alike_at_every_size(spark, bound):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    for size in (40, 400):
        rows = [(i, body(i) + ("\nboiler plate line" if i % 5 == 0 else "") + ("\nrare line" if i % 20 == 0 else ""), None, "a") for i in range(size)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        out = line_frequency(docs, max_documents=1, max_share=10, broadcast_lines=bound).collect()
        assert {r.doc_id: r.n_removed_words for r in out} == {i: 3 if i % 5 == 0 else 0 for i in range(size)}


def test_verdicts_do_not_change_with_the_size_of_the_crawl(spark):
    """Ten times as many documents, each with an id and words of its own: every one gets the verdict of its first."""
    body = lambda i, t: "\n".join([f"own{i}x{t} line {k} of words" for k in range(12 if i % 3 else 3)])
    common = "\n".join(f"menu entry {k} with some more words in it" for k in range(8))  # in a tenth of the documents
    rare = "a line that few documents of the host have"  # in one of a hundred

    def table(times):
        return spark.createDataFrame([(i * times + t, "\n".join([body(i, t), *[common] * (i % 10 == 0), *[rare] * (i % 100 == 1)]), "hot")
                                      for i in range(600) for t in range(times)], "doc_id long, text string, source string")

    one, ten = ({r.doc_id: (r.n_words, r.n_removed_words, r.kept) for r in line_frequency(table(n)).collect()} for n in (1, 10))
    verdicts = {i: v[1:] for i, v in one.items()}
    assert {i: v[1:] for i, v in ten.items()} == {10 * i + t: v for i, v in verdicts.items() for t in range(10)}
    assert all((v[0] > 0) == (i % 10 == 0) for i, v in verdicts.items()) and any(not v[1] for v in verdicts.values())


def test_registered_query_removes_words(spark):
    from textloom.llm.queries import QUERIES

    out = QUERIES["op2_line_frequency"](spark, "/root/testdata/sf0.01")
    assert out.agg(F.sum("n_removed_words")).first()[0] > 0 and out.where("n_removed_words > 0 AND kept").count() > 0
