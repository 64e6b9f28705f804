"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints one JSON line. Every query is run to completion with the ``noop`` sink
(full computation, no collect to the driver). Queries:

- encode_pack: documents -> byte ids -> offsets -> 65,536-token shards in chunk rows
- manifest: shard manifest and split totals (lengths only)
- cut_windows: all training windows of the step plan as (B, T) rows
- chat_collate: instruction rows -> chat text -> SFT examples -> padded, masked batches
- choice_scoring: items -> rendered rows -> token losses -> picks -> accuracy
- metric_log: window losses -> train / val / hella log lines
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "encode_pack": "packed_chunks",
    "manifest": "shard_manifest",
    "cut_windows": "train_batches",
    "chat_collate": "chat_batches",
    "choice_scoring": "choice_accuracy",
    "metric_log": "metric_log",
}


def operator_frames(spark, sf_dir):
    """The headline operators with array outputs (the registered queries add a
    string rendering of every array for the oracle; that is not timed here)."""
    from textloom.operators.windows import assign_steps, read_windows, window_buffers, window_rows
    from textloom.plans import chat as CH
    from textloom.plans import corpus as C
    from textloom.plans import fixtures as X
    from textloom import registry as R
    from pyspark.sql import functions as F

    from textloom.session import scratch_path
    from textloom.sources import io as IO

    shards = scratch_path(spark, "bench-shards")

    def encode_pack():
        """Documents -> shards written as parquet (the sink is part of the work)."""
        IO.write_shards(C.corpus_chunks(X.corpus(spark, sf_dir), R.SHARD, R.CHUNK), shards)
        return spark.read.parquet(shards).limit(0)

    def cut():
        """Training windows read from the stored shards, as a data loader does."""
        chunks = IO.read_shards(spark, shards, "train").unionByName(IO.read_shards(spark, shards, "val"))
        chunks = chunks.withColumn("tokens", F.col("tokens").cast("array<int>"))
        m = R._manifest(spark, sf_dir)
        counts = R._counts(m)
        a = assign_steps(spark, counts, R._max_steps(m), R.ACCUM, R.B, R.T, R.N)
        buffers = window_buffers(chunks, counts, R.B, R.T, R.N, R.SHARD, R.CHUNK)
        return window_rows(read_windows(buffers, a), R.B, R.T)

    def chat():
        return CH.chat_batches(X.instructions(spark, sf_dir))

    return {"encode_pack": encode_pack, "cut_windows": cut, "chat_collate": chat}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from textloom.registry import QUERIES
    from textloom.session import get_session

    spark = get_session()
    # warm-up: JVM start and first-plan costs are not a query's
    QUERIES["split_totals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    frames = operator_frames(spark, sf_dir)
    for label, name in HEADLINE.items():
        t0 = time.time()
        df = frames[label]() if label in frames else QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - t0, 3)
    tokens = QUERIES["split_totals"](spark, sf_dir).agg({"tokens": "sum"}).first()[0]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "tokens": int(tokens),
        "encode_pack_tokens_per_sec": round(tokens / times["encode_pack"], 1) if times["encode_pack"] else None,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
