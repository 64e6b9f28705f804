from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import STRIP_CHARS, chat_full, chat_prompt, coerce_text, normalize_text
from textloom.functions.tokens import (EOT, PAD, byte_decode, byte_encode, byte_encode_length, byte_special_ids,
                                       checked_ids, keep_last, prepend, truncate)


def test_strip_set_matches_python():
    assert len(STRIP_CHARS) == 29
    assert all(c.isspace() for c in STRIP_CHARS)
    assert sum(chr(i).isspace() for i in range(0x110000)) == 29


def test_coerce_and_normalize(spark):
    rows = [(None,), ("  a b 　 ",), (" x\t",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    got = [tuple(r) for r in df.select(coerce_text("t"), normalize_text("t")).collect()]
    assert got == [("", ""), ("  a b 　 ", "a b"), (" x\t", "x"), ("", "")]
    n = spark.createDataFrame([(1.5,), (None,)], "v double").select(coerce_text("v")).collect()
    assert [r[0] for r in n] == ["1.5", ""]


def test_chat_format(spark):
    df = spark.createDataFrame([("", "q", "r"), ("s", "q2", "r2")], "s string, q string, r string")
    p = chat_prompt(F.col("s"), F.col("q"))
    got = df.select(p.alias("p"), chat_full(p, F.col("r")).alias("f")).collect()
    assert got[0].p == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    assert got[0].f == got[0].p + "r<|im_end|>"
    assert got[1].p == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq2<|im_end|>\n<|im_start|>assistant\n"


def test_byte_encode_specials_and_roundtrip(spark):
    sid = byte_special_ids()
    assert EOT == 256 and PAD == 257 and sid["<|im_end|>"] == 265
    texts = ["", "héllo", "a<|endoftext|>b", "<|im_start|>user\n<x<|pad|>", "€ 😀 <", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", byte_encode("t").alias("ids"), byte_encode_length("t").alias("n")).collect()
    for r in out:
        t = r.t or ""
        # reference rule: special tokens split off first, the rest as UTF-8 bytes
        import re
        pieces = re.findall(r"(<\|endoftext\|>|<\|pad\|>|<\|system\|>|<\|user\|>|<\|assistant\|>|<\|memory\|>"
                            r"|<\|dialog\|>|<\|task\|>|<\|im_start\|>|<\|im_end\|>|[^<]+|<)", t)
        want = []
        for p in pieces:
            want += [sid[p]] if p in sid else list(p.encode("utf-8"))
        assert r.ids == want
        assert r.n == len(want)
    back = df.select("t", byte_decode(byte_encode("t")).alias("d"), byte_decode(byte_encode("t"), True).alias("s")).collect()
    for r in back:
        assert r.d == (r.t or "")
    assert back[2].s == "ab"


def test_prepend_check_truncate_keep_last(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "ids array<int>")
    got = df.select(prepend("ids", EOT).alias("a"), truncate("ids", 2).alias("b"), keep_last("ids", 2).alias("c"),
                    keep_last("ids", 5).alias("d")).collect()
    assert got[0].a == [EOT, 1, 2, 3] and got[1].a == [EOT]
    assert got[0].b == [1, 2] and got[0].c == [2, 3] and got[0].d == [1, 2, 3] and got[1].c == []
    import pytest
    bad = spark.createDataFrame([([1, 70000],)], "ids array<int>")
    with pytest.raises(Exception, match="outside"):
        bad.select(checked_ids("ids")).collect()
