"""Stored shards: written once, other splits left alone, and only the files of wanted windows opened."""

import glob
import os

from pyspark.sql import functions as F

from textloom.operators import windows as W
from textloom.plans.corpus import corpus_chunks, corpus_manifest
from textloom.plans.store import input_mark, shard_store

B, T, N, SHARD, CHUNK = 2, 16, 2, 1024, 64


def _docs(spark):
    rows = [("val" if i % 4 == 0 else "train", i, f"text {i} " * (1 + i % 40)) for i in range(400)]
    return spark.createDataFrame(rows, "split string, doc_id long, text string")


def files_opened(df):
    """Files that the scans of partitioned tables opened when ``df`` ran."""
    rows = df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), 0

    def walk(p):
        nonlocal out
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if "QueryStageExec" in name:
            return walk(p.plan())
        if name == "FileSourceScanExec" and p.metrics().contains("numPartitions"):
            out += p.metrics().apply("numFiles").value()
        children = p.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return rows, out


def test_windows_open_the_files_of_their_shards(spark):
    docs = _docs(spark)
    counts = W.window_counts(corpus_manifest(docs, SHARD), B, T, N)
    store = shard_store(spark, docs, ("a",), "val", SHARD, CHUNK)
    path = spark.__dict__["_textloom_stores"][next(k for k in spark.__dict__["_textloom_stores"] if k[1] == ("a",))].removeprefix("file:")
    shards = glob.glob(os.path.join(path, "split=val", "shard=*"))
    assert len(shards) > 5 and not glob.glob(os.path.join(path, "split=train"))
    wins = W.validation_windows(spark, counts, B, T, N, n=20)
    want = {(r.shard) for r in wins.collect()}
    assert 1 < len(want) < len(shards)
    need = W.needed_chunks(wins, B, T, SHARD, CHUNK)
    rows, opened = files_opened(W.only_chunks(store, need).select("shard", "chunk", "tokens"))
    files = [f for s in want for f in glob.glob(os.path.join(path, "split=val", f"shard={s}", "*.parquet"))]
    assert opened == len(files) < len(glob.glob(os.path.join(path, "split=val", "*", "*.parquet")))
    end = store.agg(F.max("chunk")).first()[0]
    assert {(r.shard, r.chunk) for r in rows} == {(r.shard, r.chunk) for r in need.collect() if r.chunk <= end}

    cut = lambda chunks: W.read_windows(W.window_buffers(chunks, counts, B, T, N, SHARD, CHUNK, wins), wins)
    key = ["split", "rank", "read"]
    assert cut(W.only_chunks(store, need)).orderBy(key).collect() == cut(corpus_chunks(docs, SHARD, CHUNK)).orderBy(key).collect()


def test_more_chunks_than_can_be_named_are_read_plainly(spark, monkeypatch):
    docs = _docs(spark)
    counts = W.window_counts(corpus_manifest(docs, SHARD), B, T, N)
    store = shard_store(spark, docs, ("a",), "val", SHARD, CHUNK)
    wins = W.validation_windows(spark, counts, B, T, N, n=5)
    need = W.needed_chunks(wins, B, T, SHARD, CHUNK)
    monkeypatch.setattr(W, "MAX_NAMED_CHUNKS", 1)
    assert W.only_chunks(store, need).count() == store.count()


def test_a_store_is_written_once_for_an_input(spark, tmp_dir):
    path = os.path.join(tmp_dir, "documents.parquet")
    _docs(spark).write.parquet(path)
    docs = spark.read.parquet(path)
    one = input_mark(docs)
    a = shard_store(spark, docs, one, "val", SHARD, CHUNK)
    before = len(spark.__dict__["_textloom_stores"])
    b = shard_store(spark, docs, input_mark(spark.read.parquet(path)), "val", SHARD, CHUNK)
    assert a.inputFiles() == b.inputFiles() and len(spark.__dict__["_textloom_stores"]) == before
    _docs(spark).limit(50).write.mode("overwrite").parquet(path)
    again = spark.read.parquet(path)
    assert input_mark(again) != one
    assert shard_store(spark, again, input_mark(again), "val", SHARD, CHUNK).count() < a.count()


def test_loss_table_has_gaps_as_nulls(spark):
    from textloom.operators.metrics import with_loss_table

    losses = spark.createDataFrame([(2, 0.5), (0, 1.5), (5, 2.5), (-3, 9.0)], "token int, loss double")
    row = with_loss_table(spark.range(1), losses).first()
    assert row["_table"] == [1.5, None, 0.5, None, None, 2.5]
    assert with_loss_table(spark.range(1), losses.limit(0)).first()["_table"] in (None, [])


def test_many_shards_share_folders(spark, tmp_dir, monkeypatch):
    """A split with more shards than folders: same chunks, and windows still open only the folders they lie in."""
    from textloom.plans import corpus as C
    from textloom.sources import io as IO

    monkeypatch.setattr(C, "MAX_FOLDERS", 6)
    docs = _docs(spark)
    counts = W.window_counts(corpus_manifest(docs, SHARD), B, T, N)
    store = shard_store(spark, docs, ("folded",), "val", SHARD, CHUNK)
    path = spark.__dict__["_textloom_stores"][next(k for k in spark.__dict__["_textloom_stores"] if k[1] == ("folded",))].removeprefix("file:")
    files = glob.glob(os.path.join(path, "split=val", "shard=*", "*.parquet"))
    assert 3 < len(glob.glob(os.path.join(path, "split=val", "shard=*"))) == len(files) <= 6
    plain = corpus_chunks(docs, SHARD, CHUNK)
    cols = ["split", "shard", "chunk", "chunk_in_shard", "n_tokens", "tokens"]
    assert store.select(cols).orderBy("chunk").collect() == plain.where("split = 'val'").select(cols).orderBy("chunk").collect()
    wins = W.validation_windows(spark, counts, B, T, N, n=2)
    need = W.needed_chunks(wins, B, T, SHARD, CHUNK)
    rows, opened = files_opened(W.only_chunks(store, need).select("shard", "chunk", "tokens"))
    assert {(r.shard, r.chunk) for r in rows} == {(r.shard, r.chunk) for r in need.collect()} and opened < len(files)
    fold = C.shards_per_folder(docs, SHARD)
    assert fold > 1
    IO.write_shards(corpus_chunks(docs, SHARD, CHUNK, group_shards=fold), tmp_dir, per_folder=fold)
    for split in IO.SPLITS:
        back = IO.read_shards(spark, tmp_dir, split).select(cols).orderBy("chunk").collect()
        assert [tuple(r) for r in back] == [tuple(r) for r in plain.where(f"split = '{split}'").select(cols).orderBy("chunk").collect()]
