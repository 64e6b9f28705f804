import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textloom.llm.exact_dedup import drop_copies, exact_groups, sha256

from conftest_llm import ascii_lower


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[ascii_lower(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


# a digest of 256 values makes unequal texts collide: the comparison of whole texts must keep them apart
@pytest.mark.parametrize("digest", [sha256, lambda c: F.substring(F.unhex(F.md5(c)), 1, 1)])
@pytest.mark.parametrize("bound", [0, 1000])
def test_groups_equal_brute_force(edge, edge_docs, digest, bound):
    out = exact_groups(edge, digest=digest, broadcast_digests=bound).collect()
    want = brute(edge_docs)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in out), key=key) == sorted((w[:3] for w in want), key=key)
    if digest is sha256:
        assert {r.digest.hex() for r in out} == {w[3] for w in want}
    kept = [r.keep_id for r in out if r.kept]
    assert len(kept) == len({w[3] for w in want})


def test_drop_copies_keeps_one_row_of_each_text(edge, edge_docs, no_docs):
    rows = drop_copies(edge).collect()
    texts = [ascii_lower(r.text) for r in rows]
    assert len(texts) == len(set(texts)) and set(texts) == {ascii_lower(r[1]) for r in edge_docs}
    assert drop_copies(no_docs).columns == no_docs.columns and drop_copies(no_docs).count() == 0
    assert exact_groups(no_docs).count() == 0
