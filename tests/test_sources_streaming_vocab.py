import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import vocab as V
from textloom.operators.pack import pack_chunks, shard_manifest, split_totals, token_offsets
from textloom.sources import io as IO
from textloom.streaming import streams as ST


def _chunks(spark, lengths, shard, chunk):
    rows, tok = [], 0
    for i, n in enumerate(lengths):
        rows.append(("train", i, [(tok + j) % 65536 for j in range(n)]))
        tok += n
    d = spark.createDataFrame(rows, "split string, doc_id long, ids array<int>").withColumn("n_tokens", F.size("ids"))
    offs = token_offsets(d, F.col("n_tokens"))
    return pack_chunks(offs, shard, chunk), shard_manifest(split_totals(offs, shard), shard, "wiki"), tok


def test_npy_export_is_numpy_readable_and_imports_back(spark, tmp_dir):
    ch, man, total = _chunks(spark, [70, 3, 200, 10], 64, 16)
    IO.export_npy(ch, man, tmp_dir, "wiki")
    files = sorted(glob.glob(os.path.join(tmp_dir, "*.npy")))
    assert [os.path.basename(f) for f in files] == [f"wiki_train_{i:06d}.npy" for i in range(5)]
    flat = np.concatenate([np.load(f) for f in files])
    assert flat.dtype == np.uint16 and flat.tolist() == list(range(total))
    back = IO.import_npy(spark, tmp_dir, 16).orderBy("shard", "chunk_in_shard").collect()
    assert [t for r in back for t in r.tokens] == list(range(total))


def test_shards_write_read_and_split_check(spark, tmp_dir):
    ch, _, total = _chunks(spark, [40, 50], 32, 8)
    IO.write_shards(ch, tmp_dir)
    back = IO.read_shards(spark, tmp_dir, "train").orderBy("chunk").collect()
    assert [t for r in back for t in r.tokens] == list(range(total))
    with pytest.raises(ValueError):
        IO.read_shards(spark, tmp_dir, "test")
    with pytest.raises(ValueError, match="no shards"):
        IO.read_shards(spark, tmp_dir, "val")


def test_metric_log_roundtrip(spark, tmp_dir):
    m = spark.createDataFrame([(0, "val", 3.14159), (0, "hella", 0.25), (0, "train", 2.0000004), (1, "train", 1.5)],
                              "step int, kind string, value double")
    IO.write_metric_log(m, tmp_dir)
    lines = [r.value for r in spark.read.text(tmp_dir).collect()]
    assert lines == ["0 val 3.1416", "0 hella 0.2500", "0 train 2.000000", "1 train 1.500000"]
    back = IO.read_metric_log(spark, tmp_dir).collect()
    assert back[0].step == 0 and back[0].kind == "val" and back[0].value == 3.1416


def _documents(spark):
    rows = [("train" if i % 5 else "val", i, "x y " * (i * 37 % 90)) for i in range(120)] + [("rare", 30, "once " * 40)]
    return spark.createDataFrame(rows, "split string, doc_id long, text string")


def _crash_once(monkeypatch, name_part, after):
    """The write of a batch to a folder fails once, ``after`` writes to it have been made."""
    plain, left = ST.put_batch, [after]

    def put(df, path, batch_id, *within):
        if name_part in path:
            left[0] -= 1
            if left[0] == -1:
                raise RuntimeError("killed")
        plain(df, path, batch_id, *within)
    monkeypatch.setattr(ST, "put_batch", put)


@pytest.mark.parametrize("encoder", ["bytes", "words"])
def test_stream_pack_equals_batch(spark, tmp_dir, monkeypatch, encoder):
    """Chunks leave once, a run that is killed between its writes goes on where it was, and tails stay under a chunk."""
    from textloom.operators.encoders import BYTES, WordEncoder
    from textloom.plans.corpus import corpus_chunks
    docs = _documents(spark)
    enc = BYTES if encoder == "bytes" else WordEncoder(V.word_vocab(docs, 2), 2)
    src, shards, state, ck = (os.path.join(tmp_dir, n) for n in ("in", "shards", "state", "ck"))
    ST.stage_files(docs, src, "doc_id", rows_per_file=20)
    _crash_once(monkeypatch, state, 2)
    with pytest.raises(Exception, match="killed"):
        ST.stream_pack(spark, ST.file_stream(spark, src, docs.schema), shards, state, ck, 256, 64, enc)
    closed = lambda: {(r.split, r.chunk): (r.batch_id, r.tokens)
                      for r in spark.read.parquet(shards).where("closed = 'true'").collect()}
    before = closed()
    ST.stream_pack(spark, ST.file_stream(spark, src, docs.schema), shards, state, ck, 256, 64, enc)
    after = closed()
    assert before and before.items() <= after.items()  # the batch that ran again made the same chunks
    got = ST.streamed_chunks(spark, shards, state, 256, 64).orderBy("split", "chunk").collect()
    want = corpus_chunks(docs, 256, 64, enc).select(got[0].__fields__).orderBy("split", "chunk").collect()
    assert got == want
    tails = spark.read.parquet(state)
    assert tails.select("batch_id").distinct().count() >= 4 and tails.where("size(ids) >= 64").count() == 0
    assert spark.read.parquet(shards).where("closed = 'true'").groupBy("split", "chunk").count().where("count > 1").count() == 0


def test_stream_valid_rows_equals_batch(spark, tmp_dir, monkeypatch):
    """Streamed JSON in several batches, killed once between the rows and the state: each worker has its first n valid rows."""
    from pyspark.sql import types as T

    from textloom.operators.order import row_index, shard_rows
    from textloom.plans.chat import sft_examples, take_valid_rows
    rows = [(i // 3, i % 3, "be brief" if i % 2 else None, f"q {i}" if i % 7 else "", f"answer {i}" if i % 4 else None) for i in range(90)]
    schema = "conv_id long, turn long, system_prompt string, question string, response string"
    instr = spark.createDataFrame(rows, schema)
    shares = shard_rows(row_index(instr, ["conv_id", "turn"], out="_i"), "_i", 4)
    for n in (6, 1000):
        src, sink, state, ck = (os.path.join(tmp_dir, f"{n}{x}") for x in ("in", "out", "state", "ck"))
        ST.stage_files(instr, src, ["conv_id", "turn"], rows_per_file=15, fmt="json")
        stream = lambda: IO.read_instructions(spark, src, streaming=True, schema=T.StructType(instr.schema.fields),
                                              maxFilesPerTrigger=1)
        with monkeypatch.context() as m:
            _crash_once(m, state, 1)
            with pytest.raises(Exception, match="killed"):
                ST.stream_valid_rows(spark, stream(), sink, state, ck, n, 4)
        ST.stream_valid_rows(spark, stream(), sink, state, ck, n, 4)
        want = take_valid_rows(sft_examples(shares), ["conv_id", "turn"], n, "worker")
        got = spark.read.parquet(sink)
        key = ["worker", "conv_id", "turn"]
        assert got.select(*key, "ids").orderBy(key).collect() == want.select(*key, "ids").orderBy(key).collect()
        assert got.count() > 0 and got.groupBy("worker").count().where(f"count > {n}").count() == 0
    assert spark.read.parquet(state).select("batch_id").distinct().count() >= 5


def test_stream_sft_equals_batch(spark, tmp_dir):
    from textloom.plans.chat import sft_examples
    rows = [(i, 0, "sys" if i % 2 else None, f" question {i}　", None if i % 7 == 0 else f"answer {i}")
            for i in range(40)]
    instr = spark.createDataFrame(rows, "conv_id long, turn long, system_prompt string, question string, response string")
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    ST.stage_files(instr, src, "conv_id", rows_per_file=10)
    ST.stream_sft(spark, ST.file_stream(spark, src, instr.schema), sink, ck, 64)
    got = sorted((r.conv_id, r.ids, r.prompt_len) for r in spark.read.parquet(sink).collect())
    want = sorted((r.conv_id, r.ids, r.prompt_len) for r in sft_examples(instr, 64).collect())
    assert got == want and len(got) == 34


def test_special_tokens_and_roles(spark):
    st = V.special_tokens(spark)
    assert st.count() == 10
    assert V.resolve_token_id(st, "eos").first()[0] == 32256
    assert V.resolve_token_id(st, "pad").first()[0] == 32257
    assert V.vocab_size(32256, st).first()[0] == 32266
    no_pad = st.where("token != '<|pad|>'")
    assert V.resolve_token_id(no_pad, "pad").first()[0] == 32256  # pad falls back to eos
    with pytest.raises(Exception, match="eos token not found"):
        V.resolve_token_id(st.where("token != '<|endoftext|>'"), "eos").collect()


def test_word_encoder_with_specials(spark):
    docs = spark.createDataFrame([(0, "the cat, the dog!"), (1, "cat<|endoftext|>dog 42"), (2, "")],
                                 "doc_id long, text string")
    vocab = V.word_vocab(docs, 3)
    assert [(r.word, r.id) for r in vocab.orderBy("id").collect()] == [("cat", 0), ("dog", 1), ("the", 2)]
    e = {r.doc_id: r.ids for r in V.word_encode(docs, vocab, 3).collect()}
    assert e[0] == [2, 0, 3, 2, 1, 3]
    assert e[1] == [0, 4, 1, 3] and e[2] == []  # specials follow the unknown id


def test_bpe_encode_matches_brute_force(spark):
    import re
    import regex
    from textloom.functions.tokens import byte_special_ids
    # merges over byte ids: "t"+"h" -> 300, 300+"e" -> 301, " "+301 -> 302, "a"+"t" -> 303
    merges = [(0, 116, 104, 300), (1, 300, 101, 301), (2, 32, 301, 302), (3, 97, 116, 303)]
    mdf = spark.createDataFrame(merges, "rank int, left int, right int, id int")
    texts = ["the cat at the hat", "that<|endoftext|>the", "", "  théta 42!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in V.bpe_encode(docs, mdf).collect()}
    ranks = {(a, b): (r, i) for r, a, b, i in merges}
    vocab = {i: bytes([i]) for i in range(256)}
    for _, a, b, i in merges:
        vocab[i] = vocab[a] + vocab[b]
    sid = byte_special_ids()
    for k, text in enumerate(texts):
        want = []
        for seg in re.split("(" + "|".join(re.escape(t) for t in sid) + ")", text):
            if seg in sid:
                want.append(sid[seg])
                continue
            for pre in regex.findall(V.BPE_PRETOKEN, seg):
                want += V._apply_merges(list(pre.encode("utf-8")), ranks)
        assert got[k] == want
        # lossless: the tokens spell the text again
        spelled = b"".join(vocab[i] if i in vocab else [t for t, j in sid.items() if j == i][0].encode() for i in got[k])
        assert spelled.decode("utf-8") == text
    assert got[0][:2] == [301, 32]  # "the" then " " before "cat"


def test_staged_files_keep_null_keys_and_split_a_hot_key(spark, tmp_dir):
    rows = [(None, f"n{i}") for i in range(7)] + [(5, f"h{i}") for i in range(60)] + [(i, f"r{i}") for i in range(6, 30)]
    df = spark.createDataFrame(rows, "k long, v string")
    src = os.path.join(tmp_dir, "in")
    ST.stage_files(df, src, "k", rows_per_file=20)
    files = sorted(glob.glob(os.path.join(src, "*.parquet")), key=os.path.getmtime)
    parts = [[(r.k, r.v) for r in spark.read.schema(df.schema).parquet(f).collect()] for f in files]
    assert sorted((r for p in parts for r in p), key=str) == sorted(rows, key=str)
    assert max(map(len, parts)) <= 20 and len(files) >= 5
    keys = [[-1 if k is None else k for k, _ in p] for p in parts if p]
    assert all(max(a) <= min(b) for a, b in zip(keys, keys[1:]))
    none = spark.createDataFrame([(None, "a"), (None, "b")], "k long, v string")
    ST.stage_files(none, os.path.join(tmp_dir, "none"), "k")
    assert spark.read.parquet(os.path.join(tmp_dir, "none")).count() == 2


def test_stream_accuracy_scores_items_as_they_arrive(spark, tmp_dir, monkeypatch):
    """A run that is killed before a batch's counters are written counts every item once; no batch scoring before."""
    from textloom.operators import choice as CE
    rows = [(i, f"ctx {i}", i % 4, [f"end {(i * 7 + e) % 5} {'x' * e}" for e in range(4)]) for i in range(60)]
    items = spark.createDataFrame(rows, "item long, ctx string, label int, endings array<string>")
    losses = spark.createDataFrame([(t, 0.5 + (t * 37 % 11) / 7) for t in range(266)], "token int, loss double")
    seen = []

    def score(batch):
        seen.append(batch.count())
        return CE.with_correct(CE.pick_choice(CE.ending_losses(CE.token_losses(CE.render_choices(batch), losses))))

    src, counters, ck = (os.path.join(tmp_dir, n) for n in ("in", "counters", "ck"))
    ST.stage_files(items, src, "item", rows_per_file=12)
    with monkeypatch.context() as m:
        _crash_once(m, counters, 2)
        with pytest.raises(Exception, match="killed"):
            ST.stream_accuracy(spark, ST.file_stream(spark, src, items.schema), score, counters, ck)
    ST.stream_accuracy(spark, ST.file_stream(spark, src, items.schema), score, counters, ck)
    want = CE.choice_accuracy(score(items)).first()
    got = ST.accuracy_result(spark, counters).first()
    assert got.asDict() == want.asDict() and 0 < got.correct < 60
    assert seen[:-1] == [12] * 6  # the third batch twice, the last call is the whole table


def test_a_packing_batch_reads_the_folders_of_its_own_and_the_last_batch(spark, tmp_dir, monkeypatch):
    """What a batch reads does not grow with the batches before it; batches that wrote nothing are passed over."""
    docs = _documents(spark)
    src, shards, state, ck = (os.path.join(tmp_dir, n) for n in ("in", "shards", "state", "ck"))
    ST.stage_files(docs, src, "doc_id", rows_per_file=20)
    plain, scans = ST.before_batch, []
    monkeypatch.setattr(ST, "before_batch", lambda *a: scans.append(a) or plain(*a))
    ST.stream_pack(spark, ST.file_stream(spark, src, docs.schema), shards, state, ck, 256, 64)
    ids = [r[0] for r in spark.read.parquet(state).select("batch_id").distinct().collect()]
    assert len(ids) >= 4 and not scans
    end = max(ids)
    rows = lambda df: sorted((r.split, r.total, tuple(r.ids)) for r in df.collect())
    own = rows(ST.of_batch(spark, state, end, ST.TAIL_ROW))
    assert own and {r.batch_id for r in ST.of_batch(spark, state, end, ST.TAIL_ROW).collect()} == {end}
    assert all(f"batch_id={end}/" in f for f in ST.of_batch(spark, state, end, ST.TAIL_ROW).inputFiles())
    assert rows(ST.last_before(spark, state, end + 1, ST.TAIL_ROW)) == own == rows(ST.last_before(spark, state, end + 5, ST.TAIL_ROW))
    assert scans and not ST.of_batch(spark, state, end + 9, ST.TAIL_ROW).collect() and not ST.last_before(spark, state, 0, ST.TAIL_ROW).collect()


def test_a_batch_of_one_row_group_is_encoded_by_many_tasks(spark, tmp_dir):
    """Two files with one row group each, out of order, with equal and null keys and a null split: all tasks encode, results as in batch."""
    from textloom.operators.encoders import UserEncoder
    from textloom.plans.corpus import corpus_chunks
    rows = [((None if i % 11 == 0 else "train" if i % 5 else "val"), (None if i % 50 == 0 else i * 7919 % 300 // 2), f"{i} " * (i % 13)) for i in range(400)]
    docs = spark.createDataFrame(rows, "split string, doc_id long, text string").coalesce(1)
    src, shards, state, ck, marks = (os.path.join(tmp_dir, n) for n in ("in", "shards", "state", "ck", "marks"))
    docs.where("doc_id < 75 OR doc_id IS NULL").write.parquet(src)
    docs.where("doc_id >= 75").write.mode("append").parquet(src)
    os.mkdir(marks)

    def factory():
        from pyspark import TaskContext

        def ids(texts):
            with open(os.path.join(marks, str(TaskContext.get().partitionId())), "a") as f:
                f.write("x" * len(texts))
            return [list(t.encode("utf-8")) for t in texts]
        return ids

    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # so few bytes would be put together into one task
    try:
        ST.stream_pack(spark, ST.file_stream(spark, src, docs.schema), shards, state, ck, 256, 64, UserEncoder(factory, 256, 257))
    finally:
        spark.conf.unset(coalesce)
    counts = [os.path.getsize(f) for f in glob.glob(os.path.join(marks, "*"))]
    assert sum(counts) == 400 and len(counts) >= 4 and max(counts) <= 200
    got = ST.streamed_chunks(spark, shards, state, 256, 64).orderBy("split", "chunk").collect()
    plain = UserEncoder(lambda: lambda texts: [list(t.encode("utf-8")) for t in texts], 256, 257)
    assert got == corpus_chunks(docs, 256, 64, plain).select(got[0].__fields__).orderBy("split", "chunk").collect()


def test_staged_files_are_read_by_many_tasks_and_come_after_those_there(spark, tmp_dir):
    """Arrivals have row groups of a few megabytes, and each is later than all that were staged before it."""
    import pyarrow.parquet as pq
    df = spark.range(3000).select(F.col("id").alias("k"), F.concat(*[F.sha2(F.concat("id", F.lit(f"-{j}")), 512) for j in range(32)]).alias("v"))
    src = os.path.join(tmp_dir, "in")
    for part in (df.where("k < 1500"), df.where("k >= 1500")):
        ST.stage_files(part, src, "k", rows_per_file=10_000, min_files=1)
    files = sorted(glob.glob(os.path.join(src, "*.parquet")), key=os.path.getmtime)
    assert len({os.path.getmtime(f) for f in files}) == len(files) == 2
    keys = [spark.read.parquet(f).agg(F.min("k"), F.max("k"), F.count("v")).first() for f in files]
    assert [tuple(k) for k in keys] == [(0, 1499, 1500), (1500, 2999, 1500)]
    assert all(pq.ParquetFile(f).num_row_groups >= 2 for f in files)
