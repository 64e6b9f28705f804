import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from textloom.llm import chat_tokens
from textloom.llm.chat_tokens import CONTROLS, VOCABULARY_CONTROLS, assemble, digests, escape, format_turns, read_turns, unescape

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
FIRST = 50257
ROWS = [(1, 0, "system", "be [INST] kind"), (1, 1, "user", "hi \\- \\\\ </s>"), (1, 2, "assistant", "<s>ok</s>\n"), (1, 3, "tool", "x <|end|>"),
        (2, 1, "assistant", None), (2, 0, None, ""), (None, 0, "user", "null conversation"), (None, None, "assistant", "é日本"),
        (3, 5, "user", "same turn b"), (3, 5, "user", "same turn a"), (3, 5, "user", "same turn a"), (3, 6, "<|role|>", "<|endoftext|> z"),
        (4, 0, "user", "long " * 20_000), (4, 1, "assistant", "answer " * 20_000)] + [
    (9, k, "user" if k % 2 else "assistant", f"hot turn {k} [/INST]") for k in range(300)]


def brute(rows):
    conversations = defaultdict(list)
    for conv_id, turn, role, text in rows:
        conversations[conv_id].append(((turn is not None, turn or 0), (role or ""), (text or "")))
    out = []
    for conv_id, turns in conversations.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = 3 + sum(len(escape(t)) + {"user": 13, "system": 15, "assistant": 4}.get(r, 23 + len(escape(r))) for _, r, t in turns)
        out.append((conv_id, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in ROWS], "conv_id long, turn long, role string, text string, ids long, token_start long").repartition(4)


def test_read_back_equals_brute_force(rows):
    out = digests(read_turns(format_turns(rows, FILES, FIRST), FILES, FIRST))
    assert sorted(map(tuple, out.collect()), key=str) == brute(ROWS)
    assert digests(read_turns(format_turns(rows.limit(0), FILES, FIRST), FILES, FIRST)).count() == 0


def test_positions_and_reserved_ids(rows):
    conversations = defaultdict(list)
    for r in format_turns(rows, FILES, FIRST).collect():
        conversations[r.conv_id].append(r)
    for turns in conversations.values():
        turns.sort(key=lambda r: r.turn_index)
        assert [r.turn_index for r in turns] == list(range(len(turns)))
        assert [r.token_start for r in turns] == [0, *np.cumsum([len(r.ids) for r in turns])[:-1]]
        assert [i for r in turns for i in r.ids].count(FIRST) == 1 and turns[0].ids[0] == FIRST
        assert all(len(r.ids) == len(r.loss_mask) and set(r.loss_mask) <= {0, 1} for r in turns)
        assert all(m == 0 for r in turns for i, m in zip(r.ids, r.loss_mask) if i >= FIRST - 1)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_a_conversation_over_many_ranges(spark, parts, monkeypatch):
    data = [(None if c == 2 else c, None if k % 50 == 0 else k // 3, ["user", "assistant", "r" * 70 + str(k % 2)][k % 3], f"{'p' * (k % 2 * 70)}text {k}")
            for c, n in ((1, 2), (2, 150), (3, 400), (4, 1), (5, 90)) for k in range(n)]
    rows = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    deal = DataFrame.repartitionByRange
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda self, *keys: deal(self, parts, *keys))
    formatted = format_turns(rows, FILES, FIRST).cache()
    spread = chat_tokens._ranges(rows).where("conv_id = 3").select(F.spark_partition_id()).distinct().count()
    assert spread == 1 if parts == 1 else spread > 1
    conversations = defaultdict(list)
    for r in formatted.collect():
        conversations[r.conv_id].append(r)
    for turns in conversations.values():
        turns.sort(key=lambda r: r.turn_index)
        assert [r.turn_index for r in turns] == list(range(len(turns)))
        assert [r.token_start for r in turns] == [0, *np.cumsum([len(r.ids) for r in turns])[:-1]]
        assert [r.ids.count(FIRST) for r in turns] == [1] + [0] * (len(turns) - 1) and turns[0].ids[0] == FIRST
    assert sorted(map(tuple, digests(read_turns(formatted, FILES, FIRST)).collect()), key=str) == brute(data)


def test_query_returns_the_added_conversation(spark):
    from textloom.llm.queries import QUERIES

    out = {r.conv_id: r for r in QUERIES["op9_chat_tokens"](spark, "/root/testdata/sf0.001").collect()}
    probe = "</s>[INST] ok [/INST]"
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    own = out[-7]
    assert (own.n_turns, own.loss_chars, own.loss_sha256) == (2, len(probe), digest(probe))
    assert own.turns_sha256 == digest(f"user\n{probe}\nassistant\n{probe}\n")
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, out.values()), key=str) == brute([*given, (-7, 0, "user", probe), (-7, 1, "assistant", probe)])


def test_escape_is_reversible_and_leaves_no_control_string():
    rng, parts = random.Random(1), [*CONTROLS, *VOCABULARY_CONTROLS, "\\", "-", "<", "[", "s>", "INST]", " ", "é", "\\-", "<<s>", "|>"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROLS + VOCABULARY_CONTROLS)
    assert escape("aXaXa", ("aXa",)) == "a\\-Xa\\-Xa"


def test_masks_are_prefix_sums():
    ids, mask = assemble([([7], False), ([1, 2], True), ([], True), ([3], True), ([8], False)])
    assert ids.tolist() == [7, 1, 2, 3, 8] and mask.tolist() == [0, 1, 1, 1, 0]
