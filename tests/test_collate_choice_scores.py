import math

from pyspark.sql import functions as F

from textloom.operators.collate import (batch_token_counts, collate_chat, collate_warmup, cycle_batches,
                                        mask_targets_by_attention)
from textloom.operators.choice import completion_loss, pick_choice, render_choices, shift_and_mask
from textloom.operators.metrics import epoch_loss, perplexity, step_loss
from textloom.operators.scores import (greedy_pick, pad_after_eos, sample_pick, softmax, token_cross_entropy,
                                       topk_threshold)


def test_warmup_batch_table_widths(spark):
    # the FIXTURES table pads all four rows to one width (5 inputs)
    rows = [[5, 6, 7], [8], [1, 2, 3, 4, 5, 6], [5, 9, 6]]
    df = spark.createDataFrame([(0, i, ids) for i, ids in enumerate(rows)], "batch_id long, k long, ids array<int>")
    got = {r.k: r for r in collate_warmup(df, 6, 9).collect()}
    assert got[0].inputs == [5, 6, 7, 9, 9] and got[0].targets == [6, 7, 9, -100, -100]
    assert got[0].attention == [1, 1, 1, 1, 0]
    assert got[1].targets == [9, -100, -100, -100, -100] and got[1].attention == [1, 1, 0, 0, 0]
    assert got[3].targets == [9, 6, -100, -100, -100]
    c = batch_token_counts(collate_warmup(df, 6, 9)).first()
    assert c.dataset_tokens == 13


def test_chat_batch_worked_example(spark):
    rows = [(0, [5, 6, 7], 2), (1, [8, 9, 10, 11, 12, 13], 3)]
    df = spark.createDataFrame([(0, k, ids, p) for k, ids, p in rows],
                               "batch_id long, k long, ids array<int>, prompt_len int")
    got = {r.k: r for r in collate_chat(df, 6, 9, 1).collect()}
    assert got[0].inputs == [5, 6, 7, 9, 1] and got[0].targets == [-100, 7, 9, -100, -100]
    assert got[0].attention == [1, 1, 1, 1, 0]
    assert got[1].inputs == [8, 9, 10, 11, 12] and got[1].targets == [-100, -100, 11, 12, 13]
    m = collate_chat(df, 6, 9, 1).select(mask_targets_by_attention("targets", "attention").alias("t")).collect()
    assert m[0].t == [-100, 7, 9, -100, -100]


def test_choice_rules(spark):
    items = spark.createDataFrame([(0, "ab", 1, ["c", "de", "f", "g"])],
                                  "item long, ctx string, label int, endings array<string>")
    r = render_choices(items).orderBy("ending").collect()
    assert r[1].tokens == [97, 98, 32, 100, 101] and r[1].mask == [0, 0, 1, 1, 1]
    assert r[0].tokens == [97, 98, 32, 99, 0] and r[0].mask == [0, 0, 1, 1, 0]
    rr = render_choices(items)
    # loss at p = 1.0 for every position except ending 1, which is cheaper
    pos = rr.select("item", "ending", F.posexplode("tokens").alias("p", "t")).where("p >= 1")
    losses = pos.select("item", "ending", (F.col("p") - 1).alias("pos"),
                        F.when(F.col("ending") == 1, 0.5).otherwise(1.0).alias("loss"))
    cl = completion_loss(shift_and_mask(losses, rr)).orderBy("ending").collect()
    assert [r.n_mask for r in cl] == [2, 3, 2, 2]
    assert cl[1].sum_loss == 1.5 and cl[0].mean_loss == 1.0
    p = pick_choice(completion_loss(shift_and_mask(losses, rr))).first()
    assert p.pred == 1 and p.pred_norm == 1
    nan = spark.createDataFrame([(0, 0, 1.0, 1, 1.0), (0, 1, 0.0, 0, float("nan")), (0, 2, 0.1, 1, 0.1)],
                                "item long, ending int, sum_loss double, n_mask long, mean_loss double")
    q = pick_choice(nan).first()
    assert q.pred == 1 and q.pred_norm == 1  # NaN mean counts as the smallest


def test_scores(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0, 3.0, 0.0], 2), (1, [0.0, 0.0, 0.0, 0.0], -100)],
                               "row_id long, logits array<double>, target int")
    got = df.select(softmax("logits").alias("p"), token_cross_entropy("logits", "target").alias("l"),
                    greedy_pick("logits").alias("g"), topk_threshold("logits", 2).alias("t")).collect()
    z = [1.0, 3.0, 3.0, 0.0]
    lse = math.log(sum(math.exp(x) for x in z))
    assert abs(got[0].l - (lse - 3.0)) < 1e-12 and got[1].l is None
    assert abs(sum(got[0].p) - 1.0) < 1e-12 and got[0].g == 1
    assert got[0].t == [float("-inf"), 3.0, 3.0, float("-inf")]
    assert got[1].t == [0.0, 0.0, 0.0, 0.0]  # ties kept
    s = sample_pick(df, "logits", "row_id", k=2).collect()
    assert all(r.token in (1, 2) for r in s[:1])
    seq = spark.createDataFrame([(0, [4, 2, 7, 7]), (0, [5, 5, 2, 6]), (1, [1, 1, 1, 1])],
                                "batch_id long, ids array<int>")
    e = pad_after_eos(seq, "ids", eos=2, pad=0).collect()
    assert e[0].new_ids == [4, 2, 0] and e[0].new_mask == [1, 0, 0] and e[0].gen_len == 3
    assert e[1].new_ids == [5, 5, 2] and e[1].new_mask == [1, 1, 0]
    assert e[2].gen_len == 4 and e[2].new_mask == [1, 1, 1, 1]


def test_metrics(spark):
    b = spark.createDataFrame([(0, 0, 2.0, 10, 12), (0, 1, 4.0, 30, 31), (1, 0, float("nan"), 0, 5)],
                              "epoch int, batch_index long, loss double, targets long, dataset_tokens long")
    e = {r.epoch: r for r in epoch_loss(b).collect()}
    assert e[0].epoch_loss == 3.5 and abs(e[0].ppl - math.exp(3.5)) < 1e-9
    assert math.isnan(e[1].epoch_loss) and e[1].ppl == float("inf")
    w = spark.createDataFrame([(float("nan"),), (60.0,), (1.0,)], "l double").select(
        perplexity("l", "warmup").alias("w"), perplexity("l", "chat").alias("c")).collect()
    assert math.isnan(w[0].w) and w[0].c == float("inf") and w[1].w == float("inf")
    s = step_loss(b.where("epoch = 0"), 3, rule="warmup").first()
    assert s.step_loss == 3.0  # accum clamped to the 2 batches, short window divided by it
    c = cycle_batches(spark, spark.createDataFrame([(0, "a"), (1, "b")], "batch_id long, v string"), 3, 1, 1)
    assert [r.v for r in c.orderBy("read").collect()] == ["a", "b", "a"]


def test_instructions_dense_and_gapped_turns(spark, tmp_dir):
    import os

    from textloom.plans.fixtures import instructions
    rows = [(0, 0, "system", "be brief"), (0, 1, "user", "q1"), (0, 2, "assistant", "a1"), (0, 3, "user", "q2"),
            (1, 0, "user", "q3"), (1, 1, "user", "q4"), (1, 2, "assistant", "a4")]
    want = {(0, 1): ("be brief", "q1", "a1"), (0, 3): ("be brief", "q2", None),
            (1, 0): (None, "q3", None), (1, 1): (None, "q4", "a4")}
    for name, rs in (("dense", rows), ("gapped", [(c, t * 10, r, x) for c, t, r, x in rows])):
        d = os.path.join(tmp_dir, name)
        spark.createDataFrame(rs, "conv_id long, turn long, role string, text string") \
            .write.parquet(os.path.join(d, "conversations.parquet"))
        got = {(r.conv_id, r.turn // (10 if name == "gapped" else 1)): (r.system_prompt, r.question, r.response)
               for r in instructions(spark, d).collect()}
        assert got == want


def test_take_valid_rows_counts_after_drops(spark):
    from textloom.plans.chat import sft_examples, take_valid_rows
    rows = [(i, 0, None, f"q{i}", None if i % 3 == 0 else f"a{i}") for i in range(12)]
    instr = spark.createDataFrame(rows, "conv_id long, turn long, system_prompt string, question string, response string")
    ex = sft_examples(instr, 64)
    got = sorted(r.conv_id for r in take_valid_rows(ex, ["conv_id", "turn"], 5).collect())
    assert got == [1, 2, 4, 5, 7]  # the first five rows left after dropping empty responses
    assert take_valid_rows(ex, ["conv_id", "turn"], None).count() == 8


def test_example_report_first_items(spark):
    from textloom.operators.choice import example_report
    items = spark.createDataFrame([(i, f"c{i}", i % 4, ["a", "b", "c", "d"]) for i in range(12)],
                                  "item long, ctx string, label int, endings array<string>")
    losses = spark.createDataFrame([(i, e, float(e)) for i in range(12) for e in range(4)],
                                   "item long, ending int, mean_loss double")
    preds = spark.createDataFrame([(i, 0) for i in range(12)], "item long, pred_norm int")
    r = example_report(items, losses, preds).collect()
    assert sorted({x.item for x in r}) == list(range(9)) and len(r) == 36
    assert all(x.mean_loss == float(x.ending) for x in r)


def test_throughput(spark):
    from textloom.operators.metrics import throughput
    steps = spark.createDataFrame([(0, 0.5), (1, 2.0)], "step int, dt double")
    r = throughput(steps, 16, 1024, 1, 33).orderBy("step").collect()
    assert r[0].tokens == 540_672 and r[0].tokens_per_sec == 1_081_344.0 and r[1].ms_per_step == 2000.0
