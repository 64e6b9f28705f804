"""Registered queries against their DuckDB oracles on the smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"
SUBSET = ["doc_token_ids", "packed_chunks", "shard_manifest", "window_counts", "train_steps", "validation_batches",
          "sft_examples", "chat_batches", "warmup_batches", "rendered_choices", "choice_predictions",
          "running_accuracy", "logit_scores", "sampled_tokens", "generation_tail", "chat_epoch_metrics",
          "validation_loss", "decoded_documents", "word_token_ids", "row_positions", "custom_collate",
          "stream_valid_rows", "folder_special_ids", "bpe_large_totals", "generation_draw", "long_logit_losses", "long_topk_tokens",
          "loss_curve", "choice_losses"]


def _queries():
    import __spark_entry__ as E
    names = list(E.oracle_sql()) if os.environ.get("TEXTLOOM_ORACLE_ALL") else SUBSET
    return names


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", _queries())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from tools.check_oracle import digest
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["split", "shard", "name", "n_tokens"]
    assert df.count() > 0
