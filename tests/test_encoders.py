"""Encoders as a parameter: edge rows, several batches, errors, decode, tokenizer folder."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions.tokens import byte_encode
from textloom.operators import vocab as V
from textloom.operators.encoders import BYTES, BpeEncoder, ByteEncoder, UserEncoder, WordEncoder, decode_ids

TEXTS = [None, "", "a", "<|", "x<|im_end|>é<|endoftext|>", "日本 <|pad|", "long " * 3000] + [f"row {i}" for i in range(600)]


def _docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_byte_encoder_equals_the_column_expression(spark):
    d = BYTES.with_ids(_docs(spark), ids=F.col("text")).withColumn("want", byte_encode(F.coalesce("text", F.lit(""))))
    d = d.withColumn("n", BYTES.length("text"))
    assert d.where("ids <> want or n <> size(ids)").count() == 0 and d.count() == len(TEXTS)
    assert BYTES.with_ids(_docs(spark).limit(0), ids=F.col("text")).collect() == []


def test_user_encoder_keeps_columns_and_checks_ids(spark):
    enc = UserEncoder(lambda: lambda texts: [[len(t)] * (len(t) % 3) for t in texts], 1, 2, vocab_size=20_000)
    got = {r.doc_id: (r.text, r.ids) for r in enc.with_ids(_docs(spark), ids=F.col("text")).collect()}
    assert got[0] == (None, []) and got[4][1] == [len(TEXTS[4])] * (len(TEXTS[4]) % 3) and len(got) == len(TEXTS)
    low = UserEncoder(lambda: lambda texts: [[-1] for _ in texts], 1, 2)
    with pytest.raises(Exception, match="token id outside"):
        low.with_ids(_docs(spark), ids=F.col("text")).collect()


def test_decode_through_a_vocabulary(spark):
    docs = _docs(spark, ["the cat", "", None, "cat<|endoftext|>the"])
    vocab = V.word_vocab(docs, 2)
    words = WordEncoder(vocab, 2)
    ids = words.with_ids(docs, ids=F.col("text"))
    pieces = vocab.select("id", F.col("word").alias("piece"), F.lit(False).alias("special"))
    special = spark.createDataFrame([(i, t, True) for t, i in words.specials.items()], "id int, piece string, special boolean")
    both = decode_ids(decode_ids(ids, pieces.unionByName(special), "kept", sep=" "), pieces.unionByName(special),
                      "dropped", sep=" ", skip_special=True)
    got = {r.doc_id: (r.kept, r.dropped) for r in both.collect()}
    assert got == {0: ("the cat",) * 2, 1: ("", ""), 2: ("", ""), 3: ("cat <|endoftext|> the", "cat the")}


def test_tokenizer_folder(spark, tmp_dir):
    with open(f"{tmp_dir}/added_tokens.json", "w") as f:
        json.dump({"<|endoftext|>": 7, "<|pad|>": 8, "<|x|>": 9}, f, indent=2)
    with open(f"{tmp_dir}/special_tokens_map.json", "w") as f:
        json.dump({"additional_special_tokens": [{"content": "<|x|>"}], "bos_token": {"content": "<|endoftext|>"},
                   "eos_token": {"content": "<|endoftext|>"}, "pad_token": "<|pad|>"}, f, indent=2)
    got = {r.token: (r.id, r.roles) for r in V.read_tokenizer_folder(spark, tmp_dir).collect()}
    assert got == {"<|endoftext|>": (7, ["bos", "eos"]), "<|pad|>": (8, ["pad"]), "<|x|>": (9, ["additional"])}


# Prefixes of each other, overlapping ones, marks of regular expressions, and the signs used while cutting.
SPECIALS = {"<a>": 300, "<a>b": 301, "b<a": 302, ">>": 303, "[x].*": 304, "\x01": 305, "\x01\x03": 306, "<|endoftext|>": 307, "日本": 308}


def _cut(text, specials=SPECIALS):
    """Leftmost special token, the longest at its place."""
    out, plain, at = [], "", 0
    while at < len(text):
        hit = max((t for t in specials if text.startswith(t, at)), key=len, default=None)
        if hit:
            out += [plain] * bool(plain) + [hit]
            plain, at = "", at + len(hit)
        else:
            plain, at = plain + text[at], at + 1
    return out + [plain] * bool(plain)


def _special_texts():
    import random

    rng = random.Random(4)
    parts = [*SPECIALS, "<", "a", "b", " ", "\x02", "\x03", "日", "x", "$1", "\\"]
    return [None, ""] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(300)]


def test_any_special_tokens_longest_first(spark):
    texts = _special_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = ByteEncoder(SPECIALS)
    got = {r.doc_id: (r.ids, r.n) for r in enc.with_ids(docs, ids=F.col("text")).withColumn("n", enc.length("text")).collect()}
    want = [[i for p in _cut(t or "") for i in ([SPECIALS[p]] if p in SPECIALS else p.encode())] for t in texts]
    assert all(got[k] == (w, len(w)) for k, w in enumerate(want)) and enc.eot == 307
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "word string, id int")
    words = WordEncoder(vocab, 2, SPECIALS)
    merges = spark.createDataFrame([(0, 97, 98, 400)], "rank int, left int, right int, id int")
    bpe = BpeEncoder(merges, SPECIALS)
    got = {r.doc_id: (r.w, r.b) for r in bpe.with_ids(words.with_ids(docs, w=F.col("text")), b=F.col("text")).collect()}
    import regex
    for k, t in enumerate(texts):
        w, b = [], []
        for p in _cut(t or ""):
            if p in SPECIALS:
                w.append(SPECIALS[p])
                b.append(SPECIALS[p])
                continue
            w += [{"a": 0, "b": 1}.get(x, 2) for x in regex.findall(V.WORD_PATTERN, p)]
            for pre in regex.findall(V.BPE_PRETOKEN, p):
                b += V._apply_merges(list(pre.encode()), {(97, 98): (0, 400)})
        assert got[k] == (w, b)


def test_trie_pattern_is_longest_first():
    import re

    pattern = re.compile(V.trie_pattern(["a", "ab", "abcd", "b", "."]))
    assert pattern.findall("abcabcd.x") == ["ab", "abcd", "."]
    assert re.findall(V.trie_pattern([]), "abc") == []
    with pytest.raises(ValueError):
        V.trie_pattern([""])


def test_ids_beyond_shards_are_an_error_in_packing(spark):
    from textloom.plans.corpus import corpus_chunks

    docs = spark.createDataFrame([("train", 1, "far near")], "split string, doc_id long, text string")
    vocab = spark.createDataFrame([("far", 70_000), ("near", 1)], "word string, id int")
    with pytest.raises(Exception, match="token id outside"):
        corpus_chunks(docs, 64, 16, WordEncoder(vocab, 2)).collect()


def _slow_merges(ids, ranks):
    while True:
        pairs = [(ranks[p], p) for p in zip(ids, ids[1:]) if p in ranks]
        if not pairs:
            return ids
        (_, new), best = min(pairs)
        out, i = [], 0
        while i < len(ids):
            hit = tuple(ids[i:i + 2]) == best
            out.append(new if hit else ids[i])
            i += 2 if hit else 1
        ids = out


def test_merges_over_a_linked_list():
    import random

    import numpy as np

    rng = random.Random(6)
    for trial in range(200):
        rules, known = {}, [97, 98, 99]
        for k in range(rng.randint(0, 12)):
            pair = (rng.choice(known), rng.choice(known))
            if pair not in rules:
                rules[pair] = (k, 300 + k)
                known.append(300 + k)
        ranks = list(range(len(rules)))
        if trial % 3 == 0:  # ranks in any order: a later rule may come first
            rng.shuffle(ranks)
        rules = {p: (r, i) for r, (p, (_, i)) in zip(ranks, rules.items())}
        ids = rng.choices([97, 98, 99] if trial % 2 else [97], k=rng.randint(0, 90))
        want = _slow_merges(list(ids), rules)
        assert V.merge_long(np.array(ids, np.int64), rules).tolist() == want == V._apply_merges(list(ids), rules)


def test_a_megabyte_without_a_space_under_32000_merges():
    import random
    import time

    import numpy as np

    rng = random.Random(1)
    known, rows, seen = list(range(97, 123)), [], set()
    while len(rows) < 32_000:  # grown as a tokenizer's: pairs of what there is, short ones first
        pair = (known[int(len(known) * rng.random() ** 3)], known[int(len(known) * rng.random() ** 3)])
        if pair not in seen:
            seen.add(pair)
            rows.append((len(rows), *pair, 300 + len(rows)))
            known.append(300 + len(rows) - 1)
    table = V.MergeTable(rows)
    text = np.frombuffer(bytes(rng.choices(range(97, 123), k=1_000_000)), np.uint8).astype(np.int64)
    start = time.process_time()
    out = V.merge_long(text, table)
    took = time.process_time() - start
    spell = {i: bytes([i]) for i in range(256)}
    for _, a, b, i in rows:
        spell[i] = spell[a] + spell[b]
    assert b"".join(spell[i] for i in out.tolist()) == bytes(text.astype(np.uint8)) and (table.find(out[:-1], out[1:]) < 0).all()
    print("seconds", took)
    assert took < 10  # about one on an idle machine


def test_encoding_leaves_columns_of_any_name_alone(spark):
    docs = spark.createDataFrame([(1, "ab", "x", "y", "z")], "doc_id long, text string, _text_ids string, c0 string, text0 string")
    got = BYTES.with_ids(docs, ids=F.col("text")).collect()[0]
    assert tuple(got) == (1, "ab", "x", "y", "z", [97, 98])
