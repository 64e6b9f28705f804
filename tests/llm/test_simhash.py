import itertools
import random

import numpy as np
import pytest
import xxhash

from textloom.llm.components import components
from textloom.llm.simhash import bucket_links, close_links, covering_masks, fingerprint, hex_fingerprint, near_duplicates

from conftest_llm import ascii_lower, words


def brute_fingerprint(text):
    own = words(ascii_lower(text))
    if not own:
        return 0
    shingles = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] or [" ".join(own)]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_masks_cover_every_set_of_positions():
    masks = covering_masks(3, 1)
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(20_000):
        positions = sum(1 << p for p in rng.sample(range(64), 3))
        assert any(m & positions == 0 for m in masks)
    assert all(28 <= bin(m).count("1") <= 40 for m in masks)


def test_documents_equal_brute_force(edge, edge_docs, no_docs):
    out = near_duplicates(edge)
    got = out.select("doc_id", hex_fingerprint(out.fp).alias("hex"), "component_id").collect()
    rows = [(d[0], brute_fingerprint(d[1])) for d in edge_docs]
    fps = {fp for _, fp in rows}
    root = roots_of(fps, [p for p in itertools.combinations(fps, 2) if bin(p[0] ^ p[1]).count("1") <= 3])
    least = {}
    for i, fp in rows:
        if i is not None:
            least[root[fp]] = min(least.get(root[fp], i), i)
    want = [(i, f"{fp:016x}", least.get(root[fp])) for i, fp in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert near_duplicates(no_docs).count() == 0


def test_long_text_is_hashed_in_steps(monkeypatch):
    import textloom.llm.simhash as S

    text = " ".join(f"w{i * 7919 % 613}" for i in range(5000))
    whole = fingerprint(text.encode(), 3, 42)
    monkeypatch.setattr(S, "STEP", 64)
    assert S.fingerprint(text.encode(), 3, 42) == whole == (brute_fingerprint(text) ^ (1 << 63)) - (1 << 63)


@pytest.mark.parametrize("split", [40, 2000])
def test_links_connect_what_is_close(spark, split):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(300)}
    center = rng.getrandbits(64)  # a large group around one fingerprint, and a chain
    for _ in range(400):
        fps.add(center ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}))
    chain = rng.getrandbits(64)
    for _ in range(60):
        chain ^= sum(1 << p for p in rng.sample(range(64), 3))
        fps.add(chain)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = close_links(df, 3, split)
    rows = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in rows)
    want = roots_of(fps, [p for p in itertools.combinations(fps, 2) if bin(p[0] ^ p[1]).count("1") <= 3])
    got = roots_of(fps, rows)
    assert got == want
    found = {r.node: r.root for r in components(links).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(want[f], []).append(signed(f))
    assert found == {s: min(g) for g in groups.values() for s in g if s != min(g)}


def test_bucket_links_are_a_forest():
    fps = np.array([0, 1, 3, 7, 1 << 40, (1 << 40) + 1, 0xFFFF], np.uint64)
    a, b = bucket_links(fps, 3)
    assert len(a) == 5 and all(bin(int(x) ^ int(y)).count("1") <= 3 for x, y in zip(a, b))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, 2000 + i) for i in range(50)] + [(9, 9), (1, 0)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, 51)}, **{2000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
