import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.operators.order import prefix_sum, row_index, running_totals, shard_rows, take_rows
from textloom.operators.pack import pack_chunks, shard_manifest, split_totals, token_offsets
from textloom.operators.windows import (assign_windows, cut_windows, plan_steps, step_schedule, validation_windows,
                                        window_counts)


def _docs(spark, lengths, split="train"):
    rows = []
    tok = 0
    for i, n in enumerate(lengths):
        rows.append((split, i, list(range(tok, tok + n))))
        tok += n
    return spark.createDataFrame(rows, "split string, doc_id long, ids array<int>")


def test_prefix_sum_equals_plain_running_sum(spark):
    random.seed(3)
    keys = sorted(random.sample(range(10_000_000), 3000))
    rows = [("a" if i % 3 else "b", k, random.randint(0, 50)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    got = prefix_sum(df, "v", ["k"], ["g"], out="c").collect()
    want = {}
    acc = {}
    for g, k, v in rows:
        want[(g, k)] = acc.get(g, 0)
        acc[g] = acc.get(g, 0) + v
    assert {(r.g, r.k): r.c for r in got} == want
    idx = row_index(df, ["k"], out="i").collect()
    assert sorted(r.i for r in idx) == list(range(3000))
    rt = running_totals(df, {"n": F.lit(1), "s": F.col("v")}, ["k"]).orderBy("k").collect()
    assert rt[-1].n == 3000 and rt[-1].s == sum(r[2] for r in rows)


def test_pack_worked_example(spark):
    # FIXTURES: shard size 8, document lengths 3, 5, 4, 2
    d = _docs(spark, [3, 5, 4, 2]).withColumn("n_tokens", F.size("ids"))
    offs = token_offsets(d, F.col("n_tokens"))
    assert [(r.doc_id, r.start) for r in offs.orderBy("doc_id").collect()] == [(0, 0), (1, 3), (2, 8), (3, 12)]
    ch = pack_chunks(offs, 8, 4).orderBy("chunk").collect()
    assert [r.tokens for r in ch] == [list(range(0, 4)), list(range(4, 8)), list(range(8, 12)), list(range(12, 14))]
    assert [r.shard for r in ch] == [0, 0, 1, 1]
    tot = split_totals(offs, 8).first()
    assert (tot.shards, tot.last_shard_tokens, tot.tokens) == (2, 6, 14)
    m = shard_manifest(split_totals(offs, 8), 8, "wiki").orderBy("shard").collect()
    assert [(r.name, r.n_tokens) for r in m] == [("wiki_train_000000", 8), ("wiki_train_000001", 6)]
    exact = token_offsets(_docs(spark, [3, 5]).withColumn("n_tokens", F.size("ids")), F.col("n_tokens"))
    t = split_totals(exact, 8).first()
    assert (t.shards, t.last_shard_tokens) == (1, 0)


def test_pack_long_document_and_property(spark):
    random.seed(7)
    lengths = [random.randint(1, 40) for _ in range(60)] + [100]  # last one longer than a shard
    d = _docs(spark, lengths).withColumn("n_tokens", F.size("ids"))
    ch = pack_chunks(token_offsets(d, F.col("n_tokens")), 16, 4).orderBy("chunk").collect()
    flat = [t for r in ch for t in r.tokens]
    assert flat == list(range(sum(lengths)))  # pack then concatenate = input stream
    assert all(len(r.tokens) == 4 for r in ch[:-1])


def test_window_counts_worked_example(spark):
    # FIXTURES: B*T = 4, N = 2; L = 17 -> 2/1, 21 -> 2/2, 25 -> 3/2; planning 2, 2, 3
    m = spark.createDataFrame([("train", 0, "s0", 17), ("train", 1, "s1", 21), ("train", 2, "s2", 25)],
                              "split string, shard long, name string, n_tokens long")
    c = window_counts(m, 2, 2, 2).orderBy("shard", "rank").collect()
    assert [r.windows for r in c] == [2, 1, 2, 2, 3, 2]
    p = plan_steps(m, 8, 2, 2, 2).first()
    assert p.micro_batches == 7 and p.grad_accum == 1 and p.max_steps == 7
    with pytest.raises(ValueError):
        plan_steps(m, 10, 2, 2, 2)
    short = spark.createDataFrame([("train", 0, "tiny", 6)], "split string, shard long, name string, n_tokens long")
    with pytest.raises(Exception, match="tiny"):
        window_counts(short, 2, 2, 2).collect()


def _sequential_reader(lengths, B, T, rank, N, reads):
    """The reader of the reference, written out: position, shard, wrap."""
    shard, pos, out = 0, B * T * rank, []
    for _ in range(reads):
        out.append((shard, pos))
        pos += B * T * N
        if pos + (B * T * N + 1) > lengths[shard]:
            shard = (shard + 1) % len(lengths)
            pos = B * T * rank
    return out


def test_assign_windows_matches_sequential_reader(spark):
    lengths = [50, 37, 81]
    m = spark.createDataFrame([("train", i, f"s{i}", n) for i, n in enumerate(lengths)],
                              "split string, shard long, name string, n_tokens long")
    B, T, N = 2, 3, 2
    counts = window_counts(m, B, T, N)
    reads = spark.range(40).select(F.lit("train").alias("split"), F.col("id").alias("read"),
                                   F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("rank"))
    a = assign_windows(counts, reads, B, T, N).collect()
    for r in range(N):
        got = [(x.shard, x.start) for x in sorted((x for x in a if x.rank == r), key=lambda x: x.read)]
        assert got == _sequential_reader(lengths, B, T, r, N, 40)


def test_cut_windows_and_schedule(spark):
    lengths = [30, 30]
    d = _docs(spark, lengths).withColumn("n_tokens", F.size("ids"))
    chunks = pack_chunks(token_offsets(d, F.col("n_tokens")), 24, 4)
    m = shard_manifest(split_totals(token_offsets(d, F.col("n_tokens")), 24), 24)
    counts = window_counts(m, 2, 4, 1)
    v = validation_windows(spark, counts, 2, 4, 1, n=3, split="train")
    xy = cut_windows(chunks, v, 2, 4, 24, 4).orderBy("read").collect()
    assert xy[0].x == list(range(0, 8)) and xy[0].y == list(range(1, 9))
    assert xy[1].x == list(range(8, 16))
    s = step_schedule(spark, 501, eval_every=250, checkpoint_every=5000).collect()
    ev = [r.step for r in s if r.evaluate]
    assert ev == [0, 250, 500] and [r.step for r in s if r.generate] == [250, 500]
    assert [r.step for r in s if r.checkpoint] == [500]


def test_take_and_shard_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r.k for r in take_rows(df, ["k"], 3).collect()] == [0, 1, 2]
    assert take_rows(df, ["k"], None).count() == 10
    assert sorted(r.k for r in shard_rows(df, "k", 3, 1).collect()) == [1, 4, 7]
    w = shard_rows(df, "k", 3, None, mode="contiguous", total=10).orderBy("k").collect()
    assert [r.worker for r in w] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_window_buffers_equal_cut_windows(spark):
    from textloom.operators.windows import read_windows, window_buffers
    random.seed(11)
    lengths = [random.randint(1, 60) for _ in range(40)]
    d = _docs(spark, lengths).withColumn("n_tokens", F.size("ids"))
    offs = token_offsets(d, F.col("n_tokens"))
    shard, chunk, B, T, N = 300, 60, 2, 7, 3  # chunk not a multiple of B*T
    chunks = pack_chunks(offs, shard, chunk)
    counts = window_counts(shard_manifest(split_totals(offs, shard), shard), B, T, N)
    reads = spark.range(25).select(F.lit("train").alias("split"), F.col("id").alias("read"),
                                   F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("rank"))
    w = assign_windows(counts, reads, B, T, N)
    a = {(r.rank, r.read): (r.x, r.y) for r in cut_windows(chunks, w, B, T, shard, chunk).collect()}
    b = {(r.rank, r.read): (r.x, r.y) for r in read_windows(window_buffers(chunks, counts, B, T, N, shard, chunk), w).collect()}
    assert a == b and len(a) == 75


def test_prefix_sum_with_clustered_keys(spark):
    # two thirds of the rows in a narrow key range
    keys = list(range(0, 3000_000_000, 6_000_000)) + list(range(10_000, 11_000))
    df = spark.createDataFrame([(k, 1) for k in keys], "k long, v long")
    got = {r.k: r.c for r in prefix_sum(df, "v", ["k"], out="c").collect()}
    assert [got[k] for k in sorted(keys)] == list(range(len(keys)))
