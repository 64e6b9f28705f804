import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.session import ship_package
from textloom.sources import io as IO
from textloom.sources import npy

ROWS = "split string, shard long, chunk long, tokens array<int>, shard_tokens long"


@pytest.fixture()
def rows(spark):
    ship_package(spark)
    npy.register(spark)
    return lambda data: spark.createDataFrame(data, ROWS).repartition("split", "shard").sortWithinPartitions("split", "shard", "chunk")


def save(df, folder, mode="append"):
    df.write.format(npy.FORMAT).option("name", "c").mode(mode).save("file:" + folder)


def left_in(folder):
    return sorted(os.listdir(folder))


def test_headers_are_numpy_headers(tmp_dir):
    for n in (0, 1, 99_999, 100_000_000):
        path = os.path.join(tmp_dir, "x_train_000000.npy")
        with open(path, "wb") as fh:
            fh.write(npy.header(n))
        with open(path, "rb") as fh:
            first, got = npy.read_header(fh, path)
        assert got == n and first == os.path.getsize(path) and first % 64 == 0


def test_ranges_cover_every_file_once(spark, rows, tmp_dir):
    rng = np.random.default_rng(1)
    want = {("train", 0): rng.integers(0, 65536, 1000), ("train", 1): rng.integers(0, 65536, 1001), ("val", 0): rng.integers(0, 65536, 7)}
    for (split, shard), ids in want.items():
        np.save(os.path.join(tmp_dir, f"a_b_{split}_{shard:06d}.npy"), ids.astype(np.uint16))
    np.save(os.path.join(tmp_dir, "a_b_val_000009.npy"), np.zeros(0, np.uint16))
    for chunk, size in ((10, 64), (333, 1), (1, 512), (5000, 1024)):
        df = spark.read.format(npy.FORMAT).option("chunk_size", chunk).option("partition_bytes", size).load("file:" + tmp_dir)
        got = {}
        for r in df.orderBy("split", "shard", "chunk_in_shard").collect():
            part = got.setdefault((r.split, r.shard), [])
            assert r.chunk_in_shard == len(part) and 0 < len(r.tokens) <= chunk
            part.append(r.tokens)
        assert {k: [t for p in v for t in p] for k, v in got.items()} == {k: v.tolist() for k, v in want.items()}
    assert df.rdd.getNumPartitions() == 4  # a file and what opening it counts as are over half of a partition here
    assert spark.read.format(npy.FORMAT).load("file:" + tmp_dir).rdd.getNumPartitions() == 1
    assert df.select("split", F.size("tokens").alias("n")).groupBy("split").agg(F.sum("n")).orderBy("split").collect()[0][1] == 2001


def test_write_and_overwrite(spark, rows, tmp_dir):
    save(rows([("train", s, c, [s, c, 65535], 6) for s in range(3) for c in range(2)]), tmp_dir)
    assert left_in(tmp_dir) == [f"c_train_{s:06d}.npy" for s in range(3)]
    assert np.load(glob.glob(tmp_dir + "/*_000002.npy")[0]).tolist() == [2, 0, 65535, 2, 1, 65535]
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as fh:
        fh.write("stays")
    save(rows([("train", 1, 0, [4], 1)]), tmp_dir, "overwrite")
    assert left_in(tmp_dir) == ["c_train_000001.npy", "notes.txt"]
    assert np.load(os.path.join(tmp_dir, "c_train_000001.npy")).tolist() == [4]


@pytest.mark.parametrize("bad", [
    ("train", 7, 1, [70_000], 1), ("train", 7, 1, [-1], 1), ("train", 7, 1, [1, 2], 3), ("train", 7, 1, [1, 2], 1),
    ("train", 7, 1, None, 1), ("train", 7, 1, [1, None], 2), ("train", 7, 1, [1], None)])
def test_aborted_write_leaves_no_file(rows, tmp_dir, bad):
    good = [("train", s, 0, [s], 1) for s in range(6)]
    with pytest.raises(Exception):
        save(rows([*good, bad]), tmp_dir)
    assert left_in(tmp_dir) == []


def test_a_shard_in_two_tasks_or_out_of_order_is_an_error(spark, rows, tmp_dir):
    two = spark.createDataFrame([("train", 0, 0, [1], 1), ("train", 0, 0, [1], 1)], ROWS)
    assert two.rdd.getNumPartitions() > 1
    with pytest.raises(Exception, match="several tasks"):
        save(two, tmp_dir)
    with pytest.raises(Exception, match="out of order"):
        save(spark.createDataFrame([("train", 0, 1, [1], 2), ("train", 0, 0, [1], 2)], ROWS).coalesce(1), tmp_dir)
    assert left_in(tmp_dir) == []


def test_other_files_are_refused(spark, rows, tmp_dir):
    np.save(os.path.join(tmp_dir, "c_train_000000.npy"), np.zeros(3, np.int64))
    with pytest.raises(Exception, match="does not hold"):
        IO.import_npy(spark, tmp_dir).collect()


def test_a_cut_file_is_an_error(spark, rows, tmp_dir):
    path = os.path.join(tmp_dir, "c_train_000000.npy")
    np.save(path, np.arange(100, dtype=np.uint16))
    with open(path, "r+b") as fh:
        fh.truncate(os.path.getsize(path) - 20)
    with pytest.raises(Exception, match="ends before"):
        IO.import_npy(spark, tmp_dir, 50).collect()


def test_documents_without_text_or_key(spark, tmp_dir):
    spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, other string").write.mode("overwrite").json(tmp_dir)
    back = IO.read_documents(spark, tmp_dir, "json")
    assert sorted(map(tuple, back.collect())) == [(1, ""), (2, "")]
    assert IO.read_documents(spark, tmp_dir, "json", text_col="other", key="none").columns == ["text"]
