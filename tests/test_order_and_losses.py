"""Numbering and loss lookups on rows the given tables don't hold."""

import pytest
from pyspark.sql import functions as F

from textloom.operators import choice
from textloom.operators.order import prefix_sum, row_index, running_totals


def test_null_keys_and_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", None, 2), (None, 1, 4), (None, 0, 8), ("b", 5, 16)], "g string, k long, v long")
    out = {(r.g, r.k): r.s for r in prefix_sum(df, "v", ["k"], ["g"], out="s").collect()}
    assert out == {("a", None): 0, ("a", 3): 2, (None, 0): 0, (None, 1): 8, ("b", 5): 0}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert row_index(df, ["k"]).collect() == []
    assert running_totals(df, {"n": F.lit(1)}, ["k"]).columns == ["k", "v", "n"]


def test_a_key_with_most_rows_is_split(spark):
    df = spark.range(40_000).select(F.when(F.col("id") < 30_000, 7).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = row_index(df, ["k", "id"], out="i")
        assert out.where("i <> id").count() == 0 and out.count() == 40_000
        # rows of one key alone, in the order they are read
        alone = row_index(df.select("k"), ["k"], out="i")
        assert alone.select(F.countDistinct("i"), F.min("i"), F.max("i")).first() == (40_000, 0, 39_999)
        sizes = [r["count"] for r in df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange("k", "_row")
                 .groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 40_000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_with_equal_keys_are_all_numbered(spark):
    df = spark.createDataFrame([(1, "x")] * 5 + [(0, "y")], "k long, v string")
    assert sorted((r.k, r.idx) for r in row_index(df, ["k"]).collect()) == [(0, 0)] + [(1, i) for i in range(1, 6)]


def test_unknown_token_or_position_is_an_error(spark):
    rendered = spark.createDataFrame([(0, 0, [1, 2, 3], [0, 1, 1])], "item long, ending int, tokens array<int>, mask array<int>")
    table = spark.createDataFrame([(1, 0.5), (2, 0.5)], "token int, loss double")
    with pytest.raises(Exception, match="no loss for token 3"):
        choice.token_losses(rendered, table).collect()
    losses = spark.createDataFrame([(0, 0, 0, 0.5)], "item long, ending int, pos int, loss double")
    with pytest.raises(Exception, match="no loss for pos 1"):
        choice.shift_and_mask(losses, rendered).collect()


def test_nan_sum_is_the_lowest(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, 0, 1.0, 1.0), (0, 1, nan, nan), (0, 2, 0.5, 0.5)], "item long, ending int, sum_loss double, mean_loss double")
    assert tuple(choice.pick_choice(df).first()) == (0, 1, 1)


def test_next_turn_with_gaps_and_repeated_turns(spark, tmp_dir):
    from textloom.plans.fixtures import instructions

    rows = [(1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 2, "user", "q2"), (1, 4, "assistant", "a2"), (2, 0, "system", "s"), (2, 3, "user", "q3"), (2, 9, "assistant", "a3")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_dir}/conversations.parquet")
    out = sorted((r.conv_id, r.question, r.response, r.system_prompt) for r in instructions(spark, tmp_dir).collect())
    assert out == [(1, "q1", "a1", None), (1, "q2", "a2", None), (2, "q3", "a3", "s")]


def test_missing_text_column_is_empty_text(spark, tmp_dir):
    from textloom.sources.io import read_documents

    spark.createDataFrame([(1, "x")], "doc_id long, title string").write.parquet(f"{tmp_dir}/d")
    assert [tuple(r) for r in read_documents(spark, f"{tmp_dir}/d").collect()] == [(1, "")]


def test_numbering_leaves_columns_of_any_name_alone(spark):
    from textloom.operators.order import row_index

    df = spark.createDataFrame([(3, 7, "a", 1, 5), (1, 8, "b", 2, 6)], "k long, _row long, _range string, _v0 int, c0 int")
    got = row_index(df, ["k"], out="n").orderBy("n").collect()
    assert [tuple(r) for r in got] == [(1, 8, "b", 2, 6, 0), (3, 7, "a", 1, 5, 1)]


def test_draw_takes_the_token_at_the_running_sum(spark):
    import numpy as np

    from textloom.operators.scores import sample_pick, uniform

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 2, 50)]) for i in range(40)] + [(90, [0.0] * 20), (91, [1.0])]
    df = spark.createDataFrame(rows, "row_id long, z array<double>")
    for k in (None, 1, 7):
        got = sample_pick(df, "z", "row_id", k).withColumn("u", uniform(F.lit(42), F.col("row_id"))).collect()
        for r in got:
            p = np.exp(np.array(r.z) - max(r.z))
            p /= p.sum()
            order = np.lexsort((np.arange(len(p)), -p))[:k]
            cum = np.cumsum(p[order])
            at = int(np.searchsorted(cum, r.u * cum[-1], side="right"))
            assert r.token in order[max(0, at - 1):at + 2] and abs(cum[list(order).index(r.token)] - cum[min(at, len(cum) - 1)]) < 1e-9


def test_rows_stay_where_they_are_stored(spark):
    import re

    from textloom.operators.order import row_index

    df = spark.range(5000, numPartitions=7).select((F.col("id") * 37 % 1001).alias("k"), F.col("id").cast("string").alias("text"))
    got = row_index(df, ["k", "text"], out="n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    scan = re.search(r"\n( *):- Sort.*?FileScan parquet \S*order_rows", plan, re.S).group(0)  # the rows' side of the join
    assert "Exchange" not in scan
    assert [r.n for r in got.orderBy("n").collect()] == list(range(5000))
    assert [(r.k, r.text) for r in got.orderBy("n").collect()] == sorted((i * 37 % 1001, str(i)) for i in range(5000))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("order_rows")]
    assert 0 < len([f for f in got.inputFiles() if "order-rows" in f]) <= 7 * 4  # four per writing task, however many buckets
