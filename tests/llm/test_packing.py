import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from textloom.llm.packing import encoder, pack, pack_documents

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def ids_of():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(FILES[0])
    return lambda text: [*full.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("limits", [(1024, 64, 1024), (64, 3, 40)])
def test_pieces_cover_every_id_once_within_limits(edge, edge_docs, ids_of, limits):
    rows = pack_documents(edge, *FILES, max_tokens=limits[0], max_segments=limits[1], max_loss=limits[2], with_ids=True).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
        ids = np.array(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(ids.tobytes()) == r.ids_crc32
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert sum(r.length for r in pieces) <= limits[0] and len(pieces) <= limits[1]
        assert sum(r.loss_tokens for r in pieces) <= limits[2]
    want = defaultdict(list)
    for d in edge_docs:
        want[d[0]].append(ids_of(d[1]))
    for doc_id, texts in want.items():
        own = sorted(docs[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == sum(map(len, texts))
        assert {r.doc_tokens for r in own} == set(map(len, texts))
        if len(texts) == 1:
            assert [i for r in own for i in r.ids] == texts[0]
            assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]


def test_padding_is_little_when_tokens_are_the_limit():
    rng = np.random.default_rng(1)
    examples = [(k, np.zeros(n, np.uint32), np.ones(n, np.uint8)) for k, n in enumerate(rng.integers(1, 3000, 3000))]
    full = [sum(len(p[2]) for p in s) for s in pack(iter(examples), (1024, 64, 1024), 16, 512)]
    assert sum(full) == sum(len(e[1]) for e in examples)
    assert 1 - sum(full) / (1024 * len(full)) < 0.002


def test_empty_table(no_docs):
    assert pack_documents(no_docs, *FILES).count() == 0


def test_ranks_give_the_ids_of_the_file(ids_of, edge_docs):
    import random

    rng, encode = random.Random(3), encoder(*FILES)
    letters = [chr(i) for i in range(0x260)] + list("  \n\n\t''sdtlv") * 6
    for text in ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)] + [d[1] or "" for d in edge_docs]:
        assert [*encode(text), 0] == ids_of(text)


def test_given_ids_and_masks_are_packed_and_the_loss_limit_binds(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(1, 9, n).tolist(), (rng.random(n) < i % 3 / 2).astype(int).tolist()) for i, n in enumerate(rng.integers(0, 200, 60).tolist())]
    rows += [(100, None, None), (101, [3, 4, 5], None)]
    examples = spark.createDataFrame(rows, "example long, ids array<int>, loss_mask array<int>").coalesce(1)
    packed = lambda limit: pack_documents(examples, *FILES, max_tokens=128, max_loss=limit, with_ids=True,
                                          ids_col="ids", loss_col="loss_mask", id_col="example").collect()
    sequences, docs = defaultdict(int), defaultdict(list)
    for r in packed(48):
        sequences[r.sequence_id] += r.loss_tokens
        docs[r.doc_id].append(r)
    assert max(sequences.values()) <= 48 < max(sum(r.loss_tokens for r in packed(128) if r.sequence_id == k) for k in sequences)
    for i, ids, mask in rows:
        own = sorted(docs[i], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == [*(ids or []), 0]
        assert sum(r.loss_tokens for r in own) == sum(mask if mask is not None else [1] * len(ids or []))


def test_mask_of_another_length_is_an_error(spark):
    examples = spark.createDataFrame([(1, [1, 2], [1])], "doc_id long, ids array<int>, loss array<int>")
    with pytest.raises(Exception, match="loss mask of 1"):
        pack_documents(examples, *FILES, ids_col="ids", loss_col="loss").collect()
