"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the driver's tables at ``sf_dir`` and runs over all rows.
Arrays are returned as space-separated strings so that both engines hash the
same values; doubles are rounded to 6 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import oracle as O
from textloom.functions.tokens import ids_text
from textloom.plans import corpus as C
from textloom.plans import fixtures as X

SHARD = C.TEST_SHARD_SIZE
CHUNK = C.TEST_CHUNK_SIZE
NAME = "corpus"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- tokens / packing

@register("doc_token_ids", _with(O.CORPUS, O.DOC_IDS) + f"""
SELECT split, doc_id, len(ids)::BIGINT AS n_tokens, {O.ids_text('ids')} AS ids FROM doc_ids""")
def q_doc_token_ids(spark, sf_dir):
    return C.document_ids(X.corpus(spark, sf_dir)).select("split", "doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       ids_text("ids").alias("ids"))


@register("doc_offsets", _with(O.CORPUS, O.DOC_IDS, O.OFFSETS) + """
SELECT split, doc_id, start, n_tokens FROM offsets""")
def q_doc_offsets(spark, sf_dir):
    return C.document_offsets(X.corpus(spark, sf_dir)).select("split", "doc_id", "start", "n_tokens")


@register("packed_chunks", _with(O.CORPUS, O.DOC_IDS, O.OFFSETS, O.tokens_long(SHARD, CHUNK)) + f"""
SELECT split, (chunk // {SHARD // CHUNK})::BIGINT AS shard, chunk,
       (chunk % {SHARD // CHUNK})::BIGINT AS chunk_in_shard, n_tokens, tokens FROM chunks""")
def q_packed_chunks(spark, sf_dir):
    ch = C.corpus_chunks(X.corpus(spark, sf_dir), SHARD, CHUNK)
    return ch.select("split", "shard", "chunk", "chunk_in_shard", "n_tokens", ids_text("tokens").alias("tokens"))


@register("split_totals", _with(O.CORPUS, O.DOC_IDS, O.OFFSETS, O.totals(SHARD)) + """
SELECT split, documents, tokens, shards, last_shard_tokens FROM totals""")
def q_split_totals(spark, sf_dir):
    return C.corpus_totals(X.corpus(spark, sf_dir), SHARD)


@register("shard_manifest", _with(O.CORPUS, O.DOC_IDS, O.OFFSETS, O.totals(SHARD), O.manifest(SHARD, NAME)) + """
SELECT split, shard, name, n_tokens FROM manifest""")
def q_shard_manifest(spark, sf_dir):
    return C.corpus_manifest(X.corpus(spark, sf_dir), SHARD, NAME)


# ---------------------------------------------------------------- windows / steps

B, T, N = 4, 256, 2
ACCUM = 2
TOTAL_BATCH = B * T * N * ACCUM
VAL_N = 20

_MANIFEST_CTES = (O.CORPUS, O.DOC_IDS, O.OFFSETS, O.totals(SHARD), O.manifest(SHARD, NAME))


def _manifest(spark, sf_dir):
    """The manifest as a written table: the corpus is measured once for all that reads it."""
    from textloom.session import written_once
    return written_once(C.corpus_manifest(X.corpus(spark, sf_dir), SHARD, NAME), "manifest")


def _counts(manifest):
    from textloom.operators.windows import window_counts
    return window_counts(manifest, B, T, N)


def _max_steps(manifest) -> int:
    from textloom.operators.windows import plan_steps
    return int(plan_steps(manifest, TOTAL_BATCH, B, T, N).where(F.col("split") == "train").first()["max_steps"])


def _train_windows(spark, manifest):
    from textloom.operators.windows import assign_steps
    return assign_steps(spark, _counts(manifest), _max_steps(manifest), ACCUM, B, T, N)


def _val_windows(spark, manifest):
    from textloom.operators.windows import validation_windows
    return validation_windows(spark, _counts(manifest), B, T, N, VAL_N)


@register("window_counts", _with(*_MANIFEST_CTES, O.window_counts(B, T, N)) + """
SELECT split, shard, name, rank, n_tokens, windows FROM wcounts""")
def q_window_counts(spark, sf_dir):
    return _counts(_manifest(spark, sf_dir)).withColumn("rank", F.col("rank").cast("int"))


@register("step_plan", _with(*_MANIFEST_CTES, O.step_plan(TOTAL_BATCH, B, T, N)) + """
SELECT split, shards, grad_accum, micro_batches, max_steps FROM plan""")
def q_step_plan(spark, sf_dir):
    from textloom.operators.windows import plan_steps
    return plan_steps(_manifest(spark, sf_dir), TOTAL_BATCH, B, T, N)


_STEPS_SQL = "SELECT max_steps FROM plan WHERE split = 'train'"


@register("step_schedule", _with(*_MANIFEST_CTES, O.step_plan(TOTAL_BATCH, B, T, N)) + f"""
SELECT s.step::BIGINT AS step, s.step = m - 1 AS last_step,
       (s.step % 250 = 0 OR s.step = m - 1) AS evaluate,
       ((s.step > 0 AND s.step % 250 = 0) OR s.step = m - 1) AS generate,
       ((s.step % 250 = 0 OR s.step = m - 1) AND s.step > 0 AND (s.step % 5000 = 0 OR s.step = m - 1)) AS checkpoint
FROM (SELECT max_steps AS m FROM plan WHERE split = 'train') p, range(p.m) s(step)""")
def q_step_schedule(spark, sf_dir):
    from textloom.operators.windows import step_schedule
    return step_schedule(spark, _max_steps(_manifest(spark, sf_dir)))


@register("train_steps", _with(*_MANIFEST_CTES, O.window_counts(B, T, N), O.step_plan(TOTAL_BATCH, B, T, N),
                                O.reads("train", f"SELECT max_steps * {ACCUM} FROM plan WHERE split = 'train'", B, T, N)) + f"""
SELECT split, (read // {ACCUM})::BIGINT AS step, (read % {ACCUM})::BIGINT AS micro_step, rank, read, shard, k, start
FROM assigned""")
def q_train_steps(spark, sf_dir):
    a = _train_windows(spark, _manifest(spark, sf_dir))
    return a.withColumn("rank", F.col("rank").cast("int"))


@register("validation_windows", _with(*_MANIFEST_CTES, O.window_counts(B, T, N),
                                      O.reads("val", str(VAL_N), B, T, N)) + """
SELECT split, rank, read, shard, k, start FROM assigned""")
def q_validation_windows(spark, sf_dir):
    v = _val_windows(spark, _manifest(spark, sf_dir))
    return v.withColumn("rank", F.col("rank").cast("int"))


def _stored(spark, sf_dir, split):
    """The stored shards of one split, packed once for a session."""
    from textloom.plans.store import input_mark, shard_store
    from textloom.sources.io import read_table
    return shard_store(spark, X.corpus(spark, sf_dir), input_mark(read_table(spark, sf_dir, "documents")), split, SHARD, CHUNK)


def _window_xy(spark, sf_dir, manifest, windows, splits=("train", "val")):
    """x, y of the windows that ``windows`` (split, rank, read, shard, k, start) read, cut from stored shards: training
    reads almost all chunks, validation the few that its windows lie in."""
    from textloom.operators.windows import needed_chunks, only_chunks, read_windows, window_buffers
    parts = []
    for split in splits:
        chunks = _stored(spark, sf_dir, split)
        if split == "val":
            chunks = only_chunks(chunks, needed_chunks(windows.where(F.col("split") == split), B, T, SHARD, CHUNK))
        parts.append(chunks.select("split", "shard", "chunk", "tokens"))
    chunks = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return read_windows(window_buffers(chunks, _counts(manifest), B, T, N, SHARD, CHUNK, windows), windows)


def _window_batches(spark, sf_dir, manifest, windows, split):
    from textloom.operators.windows import window_rows
    r = window_rows(_window_xy(spark, sf_dir, manifest, windows, (split,)), B, T)
    return r.select("split", F.col("rank").cast("int").alias("rank"), "read", F.col("row").cast("int").alias("row"),
                    ids_text("x").alias("x"), ids_text("y").alias("y"))


@register("validation_batches", _with(*_MANIFEST_CTES, O.window_counts(B, T, N), O.reads("val", str(VAL_N), B, T, N),
                                      O.tokens_long(SHARD, CHUNK), O.window_tokens(B, T, SHARD)) + """
SELECT split, rank, read, row, x, y FROM wrows""")
def q_validation_batches(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return _window_batches(spark, sf_dir, m, _val_windows(spark, m), "val")


@register("train_batches", _with(*_MANIFEST_CTES, O.window_counts(B, T, N), O.step_plan(TOTAL_BATCH, B, T, N),
                                 O.reads("train", f"SELECT max_steps * {ACCUM} FROM plan WHERE split = 'train'", B, T, N),
                                 O.tokens_long(SHARD, CHUNK), O.window_tokens(B, T, SHARD)) + """
SELECT split, rank, read, row, x, y FROM wrows""")
def q_train_batches(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return _window_batches(spark, sf_dir, m, _train_windows(spark, m), "train")


# ---------------------------------------------------------------- chat and warm-up batches

from textloom.functions.tokens import EOT, PAD  # noqa: E402
from textloom.plans import chat as CH  # noqa: E402


@register("chat_text", _with(O.INSTRUCTIONS, O.CHAT_TEXT) + """
SELECT conv_id, turn, prompt_text, full_text FROM chat2""")
def q_chat_text(spark, sf_dir):
    return CH.chat_text(X.instructions(spark, sf_dir)).select("conv_id", "turn", "prompt_text", "full_text")


@register("sft_examples", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN)) + f"""
SELECT conv_id, turn, len(ids)::BIGINT AS n_ids, prompt_len, {O.ids_text('ids')} AS ids FROM sft""")
def q_sft_examples(spark, sf_dir):
    s = CH.sft_examples(X.instructions(spark, sf_dir))
    return s.select("conv_id", "turn", F.size("ids").cast("long").alias("n_ids"),
                    F.col("prompt_len").cast("long").alias("prompt_len"), ids_text("ids").alias("ids"))


def _batch_out(df, extra=()):
    return df.select(*extra, "batch_id", "batch_row", F.size("ids").cast("long").alias("n_ids"),
                     ids_text("inputs").alias("inputs"), ids_text("targets").alias("targets"),
                     ids_text("attention").alias("attention"))


_CHAT_COLLATE = O.collate("sft", "conv_id, turn", CH.CHAT_BATCH, CH.CHAT_MAX_LEN, EOT, PAD, warm=False)


@register("chat_batches", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN), _CHAT_COLLATE) + f"""
SELECT conv_id, turn, batch_id, batch_row, len(ids)::BIGINT AS n_ids, {O.ids_text('inputs')} AS inputs,
       {O.ids_text('targets')} AS targets, {O.ids_text('attention')} AS attention FROM collated""")
def q_chat_batches(spark, sf_dir):
    return _batch_out(CH.chat_batches(X.instructions(spark, sf_dir)), ("conv_id", "turn"))


_WARM_COLLATE = O.collate("warm", "doc_id", CH.WARMUP_BATCH, CH.WARMUP_MAX_LEN, EOT, EOT, warm=True)
_WARM_SRC = f"""warm AS (
  SELECT doc_id::BIGINT AS doc_id, list_slice({O.byte_ids("coalesce(text, '')")}, 1, {CH.WARMUP_MAX_LEN}) AS ids
  FROM documents)"""


@register("warmup_batches", _with(_WARM_SRC, _WARM_COLLATE) + f"""
SELECT doc_id, batch_id, batch_row, len(ids)::BIGINT AS n_ids, {O.ids_text('inputs')} AS inputs,
       {O.ids_text('targets')} AS targets, {O.ids_text('attention')} AS attention FROM collated""")
def q_warmup_batches(spark, sf_dir):
    docs = X.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _batch_out(CH.warmup_batches(docs), ("doc_id",))


@register("chat_batch_tokens", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN), _CHAT_COLLATE) + """
SELECT batch_id, count(*)::BIGINT AS rows, sum(len(ids))::BIGINT AS dataset_tokens,
       sum(len(list_filter(targets, lambda v: v <> -100)))::BIGINT AS target_tokens
FROM collated GROUP BY batch_id""")
def q_chat_batch_tokens(spark, sf_dir):
    from textloom.operators.collate import batch_token_counts
    return batch_token_counts(CH.chat_batches(X.instructions(spark, sf_dir)))


@register("warmup_batch_tokens", _with(_WARM_SRC, _WARM_COLLATE) + """
SELECT batch_id, count(*)::BIGINT AS rows, sum(len(ids))::BIGINT AS dataset_tokens,
       sum(len(list_filter(targets, lambda v: v <> -100)))::BIGINT AS target_tokens
FROM collated GROUP BY batch_id""")
def q_warmup_batch_tokens(spark, sf_dir):
    from textloom.operators.collate import batch_token_counts
    docs = X.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return batch_token_counts(CH.warmup_batches(docs))


# ---------------------------------------------------------------- multiple choice

from textloom.operators import choice as CE  # noqa: E402

_CHOICE = (O.choice_items(), O.BYTE_LOSSES, O.RENDERED)


def _rendered(spark, sf_dir):
    items = X.choice_items(spark, sf_dir)
    return items, CE.render_choices(items)


def _choice_losses(spark, sf_dir):
    items, r = _rendered(spark, sf_dir)
    return items, CE.ending_losses(CE.token_losses(r, X.byte_losses(spark, sf_dir)))


def _labelled(spark, sf_dir):
    items, cl = _choice_losses(spark, sf_dir)
    return items, cl, _picked(cl)


def _picked(losses):
    return CE.with_correct(CE.pick_choice(losses))


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


@register("choice_items", _with(O.choice_items()) + """
SELECT item, ctx, label, array_to_string(endings, ' || ') AS endings FROM items""")
def q_choice_items(spark, sf_dir):
    i = X.choice_items(spark, sf_dir)
    return i.select("item", "ctx", "label", F.array_join("endings", " || ").alias("endings"))


@register("byte_losses", _with(O.BYTE_LOSSES) + """
SELECT token, round(loss, 6) AS loss FROM byte_losses""")
def q_byte_losses(spark, sf_dir):
    return X.byte_losses(spark, sf_dir).select("token", _r6("loss"))


@register("rendered_choices", _with(*_CHOICE) + f"""
SELECT item, ending, n_ctx::BIGINT AS n_ctx, width::BIGINT AS width, {O.ids_text('tokens')} AS tokens,
       {O.ids_text('mask')} AS mask FROM rendered""")
def q_rendered_choices(spark, sf_dir):
    _, r = _rendered(spark, sf_dir)
    return r.select("item", "ending", F.col("n_ctx").cast("long").alias("n_ctx"),
                    F.col("width").cast("long").alias("width"), ids_text("tokens").alias("tokens"),
                    ids_text("mask").alias("mask"))


@register("choice_losses", _with(*_CHOICE) + """
SELECT item, ending, round(sum_loss, 6) AS sum_loss, n_mask, round(mean_loss, 6) AS mean_loss FROM closs""")
def q_choice_losses(spark, sf_dir):
    _, cl = _choice_losses(spark, sf_dir)
    return cl.select("item", "ending", _r6("sum_loss"), "n_mask", _r6("mean_loss"))


@register("choice_predictions", _with(*_CHOICE) + """
SELECT item, label, pred, pred_norm, correct, correct_norm FROM labelled""")
def q_choice_predictions(spark, sf_dir):
    _, _, lab = _labelled(spark, sf_dir)
    return lab.select("item", "label", "pred", "pred_norm", "correct", "correct_norm")


@register("choice_accuracy", _with(*_CHOICE) + """
SELECT count(*)::BIGINT AS total, sum(correct)::BIGINT AS correct, sum(correct_norm)::BIGINT AS correct_norm,
       round(sum(correct) / count(*), 6) AS acc, round(sum(correct_norm) / count(*), 6) AS acc_norm FROM labelled""")
def q_choice_accuracy(spark, sf_dir):
    _, _, lab = _labelled(spark, sf_dir)
    return CE.choice_accuracy(lab, ranks=N).select("total", "correct", "correct_norm", _r6("acc"), _r6("acc_norm"))


@register("running_accuracy", _with(*_CHOICE) + """
SELECT item, count(*) OVER w AS seen, (sum(correct_norm) OVER w)::BIGINT AS correct_norm_so_far,
       round(sum(correct_norm) OVER w / count(*) OVER w, 6) AS acc_norm
FROM labelled WINDOW w AS (ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_accuracy(spark, sf_dir):
    _, _, lab = _labelled(spark, sf_dir)
    return CE.running_accuracy(lab).select("item", "seen", "correct_norm_so_far", _r6("acc_norm"))


@register("choice_report", _with(*_CHOICE) + """
SELECT i.item, i.ctx, i.label, e.ending::INTEGER AS ending, i.endings[e.ending + 1] AS ending_text,
       round(c.mean_loss, 6) AS mean_loss, p.pred_norm
FROM (SELECT * FROM items ORDER BY item LIMIT 9) i, range(4) e(ending)
JOIN closs c ON c.item = i.item AND c.ending = e.ending JOIN preds p ON p.item = i.item""")
def q_choice_report(spark, sf_dir):
    items, cl, lab = _labelled(spark, sf_dir)
    r = CE.example_report(items, cl, lab)
    return r.select("item", "ctx", "label", "ending", "ending_text", _r6("mean_loss"), "pred_norm")


# ---------------------------------------------------------------- logits

from textloom.operators import scores as S  # noqa: E402

TOPK = 50
THRESH_K = 10
SEQ_LEN = 16
GEN_BATCH = 4
GEN_EOS = 0


@register("logit_scores", _with(O.LOGITS) + """
SELECT row_id, target, round(loss, 6) AS loss, greedy, round(1.0 / se, 6) AS max_prob FROM scored""")
def q_logit_scores(spark, sf_dir):
    lg = X.logits_table(spark, sf_dir)
    return lg.select("row_id", "target", F.round(S.token_cross_entropy("logits", "target"), 6).alias("loss"),
                     S.greedy_pick("logits").alias("greedy"),
                     F.round(F.array_max(S.softmax("logits")), 6).alias("max_prob"))


@register("mean_cross_entropy", _with(O.LOGITS) + """
SELECT target, count(loss)::BIGINT AS n_targets, round(avg(loss), 6) AS mean_loss FROM scored GROUP BY target""")
def q_mean_cross_entropy(spark, sf_dir):
    lg = X.logits_table(spark, sf_dir).withColumn("loss", S.token_cross_entropy("logits", "target"))
    return S.mean_cross_entropy(lg, "loss", ["target"]).select("target", "n_targets", _r6("mean_loss"))


@register("topk_tokens", _with(O.LOGITS) + f"""
SELECT row_id, rank, token, round(prob, 6) AS prob FROM (
  SELECT row_id, (t.i - 1)::INTEGER AS token, t.p AS prob,
         row_number() OVER (PARTITION BY row_id ORDER BY t.p DESC, t.i) AS rank
  FROM (SELECT row_id, unnest(probs) AS p, unnest(range(1, len(probs) + 1)) AS i FROM scored) t)
WHERE rank <= {TOPK}""")
def q_topk_tokens(spark, sf_dir):
    t = S.topk_exact(X.logits_table(spark, sf_dir), TOPK)
    return t.select("row_id", F.col("rank").cast("long").alias("rank"), F.col("token").cast("int").alias("token"),
                    _r6("prob"))


def _long_logits(spark, sf_dir):
    """The logits one row per token, dealt over all tasks, as a model on many machines writes them."""
    lg = X.logits_table(spark, sf_dir)
    return lg, lg.select("row_id", F.posexplode("logits").alias("token", "logit"))


@register("long_logit_losses", _with(O.LOGITS) + """
SELECT row_id, target, round(loss, 6) AS loss, round(m + ln(se), 6) AS lse, greedy FROM scored""")
def q_long_logit_losses(spark, sf_dir):
    """L1, L2, L4 on a long logits table."""
    from textloom.operators.long_scores import long_cross_entropy, long_topk
    lg, long = _long_logits(spark, sf_dir)
    loss = long_cross_entropy(long, lg.select("row_id", "target"))
    first = long_topk(long, 1).select("row_id", F.col("token").cast("int").alias("greedy"))
    return loss.join(first, "row_id").select("row_id", "target", _r6("loss"), _r6("lse"), "greedy")


@register("long_topk_tokens", ORACLE["topk_tokens"])
def q_long_topk_tokens(spark, sf_dir):
    """L6 on a long logits table."""
    from textloom.operators.long_scores import long_topk
    t = long_topk(_long_logits(spark, sf_dir)[1], TOPK)
    return t.select("row_id", "rank", F.col("token").cast("int").alias("token"), _r6("prob"))


@register("topk_threshold", _with(O.LOGITS) + f"""
SELECT row_id, len(list_filter(z, lambda x: x >= list_sort(z, 'DESC')[greatest(1, least({THRESH_K}, len(z)))]))::BIGINT AS kept,
       round(list_sort(z, 'DESC')[greatest(1, least({THRESH_K}, len(z)))], 6) AS kth FROM scored""")
def q_topk_threshold(spark, sf_dir):
    lg = X.logits_table(spark, sf_dir).withColumn("t", S.topk_threshold("logits", THRESH_K))
    return lg.select("row_id",
                     F.size(F.filter("t", lambda x: ~F.isnan(x) & (x > float("-inf")))).cast("long").alias("kept"),
                     F.round(F.array_min(F.filter("t", lambda x: x > float("-inf"))), 6).alias("kth"))


@register("sampled_tokens", _with(O.LOGITS) + f"""
, top AS (
  SELECT row_id, list_slice(list_sort(list_transform(probs, lambda p, i: {{'neg': -p, 'token': i - 1}})), 1, {TOPK}) AS top,
         ('0x' || substr(md5('42:' || row_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u
  FROM scored),
cum AS (
  SELECT row_id, top, u, list_transform(top, lambda s, i: list_sum(list_transform(list_slice(top, 1, i), lambda t: -t.neg))) AS cum
  FROM top)
SELECT row_id, (top[coalesce(nullif(list_position(list_transform(cum, lambda c: c > u * cum[-1]), true), 0), len(cum))]).token::INTEGER AS token
FROM cum""")
def q_sampled_tokens(spark, sf_dir):
    lg = X.logits_table(spark, sf_dir)
    return S.sample_pick(lg, "logits", "row_id", TOPK, 42).select("row_id", F.col("token").cast("int").alias("token"))


@register("generation_tail", _with(O.LOGITS) + f"""
, seqs AS (
  SELECT row_id // {SEQ_LEN} AS seq_id, list(greedy ORDER BY row_id) AS ids FROM scored GROUP BY row_id // {SEQ_LEN}),
firsts AS (
  SELECT seq_id, seq_id // {GEN_BATCH} AS batch_id, ids, coalesce(list_position(ids, {GEN_EOS}), 0) AS f FROM seqs),
lens AS (
  SELECT *, least(len(ids), max(CASE WHEN f > 0 THEN f ELSE len(ids) END) OVER (PARTITION BY batch_id))::INTEGER AS gen_len
  FROM firsts)
SELECT seq_id, batch_id, gen_len,
  {O.ids_text(f"list_slice(list_transform(ids, lambda x, i: CASE WHEN f > 0 AND i > f THEN {GEN_EOS} ELSE x END), 1, gen_len)")} AS new_ids,
  {O.ids_text("list_slice(list_transform(ids, lambda x, i: CASE WHEN f > 0 AND i >= f THEN 0 ELSE 1 END), 1, gen_len)")} AS new_mask
FROM lens""")
def q_generation_tail(spark, sf_dir):
    lg = X.logits_table(spark, sf_dir).select("row_id", S.greedy_pick("logits").alias("tok"))
    seq = lg.groupBy((F.col("row_id") / SEQ_LEN).cast("long").alias("seq_id")).agg(
        F.sort_array(F.collect_list(F.struct("row_id", "tok"))).alias("s"))
    seq = seq.select("seq_id", (F.col("seq_id") / GEN_BATCH).cast("long").alias("batch_id"),
                     F.transform("s", lambda x: x["tok"]).alias("ids"))
    g = S.pad_after_eos(seq, "ids", GEN_EOS)
    return g.select("seq_id", "batch_id", "gen_len", ids_text("new_ids").alias("new_ids"),
                    ids_text("new_mask").alias("new_mask"))


# ---------------------------------------------------------------- training metrics

from textloom.operators import metrics as M  # noqa: E402
from textloom.operators.collate import batch_token_counts, cycle_batches, mask_targets_by_attention  # noqa: E402
from textloom.plans import training as TR  # noqa: E402

CHAT_ACCUM, CHAT_EPOCHS = 4, 2
WARM_ACCUM = 3


def _batch_losses(spark, sf_dir, batches):
    sl = M.sequence_loss(batches, ["batch_id"], "targets", X.byte_losses(spark, sf_dir))
    return sl.join(batch_token_counts(batches).select("batch_id", "dataset_tokens"), "batch_id")


def _chat_losses(spark, sf_dir):
    b = CH.chat_batches(X.instructions(spark, sf_dir))
    b = b.withColumn("targets", mask_targets_by_attention("targets", "attention"))  # B9, as the model does
    return _batch_losses(spark, sf_dir, b)


def _chat_epochs(spark, sf_dir):
    """B2 with as many steps an epoch as read every batch; the loss table (a row per batch)
    is written, since its count sets the steps."""
    from textloom.session import written_once
    b = written_once(_chat_losses(spark, sf_dir), "batch-losses")
    steps = max(1, -(-b.count() // CHAT_ACCUM))
    return cycle_batches(spark, b, steps, CHAT_ACCUM, CHAT_EPOCHS), steps * CHAT_ACCUM


def _warm_losses(spark, sf_dir):
    docs = X.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _batch_losses(spark, sf_dir, CH.warmup_batches(docs))


_CHAT_LOSS_CTES = (O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN), _CHAT_COLLATE, O.BYTE_LOSSES,
                   O.batch_losses("collated"))


@register("chat_batch_losses", _with(*_CHAT_LOSS_CTES) + """
SELECT batch_id, round(loss, 6) AS loss, targets, dataset_tokens FROM blosses""")
def q_chat_batch_losses(spark, sf_dir):
    return _chat_losses(spark, sf_dir).select("batch_id", _r6("loss"), "targets", "dataset_tokens")


@register("chat_epoch_metrics", _with(*_CHAT_LOSS_CTES, O.cycled(CHAT_ACCUM, CHAT_EPOCHS)) + """
SELECT epoch, round(sum(loss * targets) / sum(targets), 6) AS epoch_loss, sum(targets)::BIGINT AS targets,
       sum(dataset_tokens)::BIGINT AS dataset_tokens,
       round(CASE WHEN sum(loss * targets) / sum(targets) < 50 THEN exp(sum(loss * targets) / sum(targets))
                  ELSE 'Infinity'::DOUBLE END, 6) AS ppl
FROM cyc GROUP BY epoch""")
def q_chat_epoch_metrics(spark, sf_dir):
    c, _ = _chat_epochs(spark, sf_dir)
    e = M.epoch_loss(c)
    return e.select("epoch", _r6("epoch_loss"), "targets", "dataset_tokens", _r6("ppl"))


@register("chat_step_losses", _with(*_CHAT_LOSS_CTES, O.cycled(CHAT_ACCUM, CHAT_EPOCHS)) + f"""
SELECT epoch, step, round(sum(loss) / {CHAT_ACCUM}, 6) AS step_loss FROM cyc GROUP BY epoch, step""")
def q_chat_step_losses(spark, sf_dir):
    c, per_epoch = _chat_epochs(spark, sf_dir)
    c = c.withColumn("batch_index", F.col("read") - F.col("epoch") * per_epoch)
    return M.step_loss(c, CHAT_ACCUM).select("epoch", "step", _r6("step_loss"))


_WARM_LOSS_CTES = (_WARM_SRC, _WARM_COLLATE, O.BYTE_LOSSES, O.batch_losses("collated"))


@register("warmup_step_losses", _with(*_WARM_LOSS_CTES) + f"""
SELECT 0 AS epoch, (batch_id // least({WARM_ACCUM}, greatest(1, (SELECT count(*) FROM blosses))))::BIGINT AS step,
       round(sum(loss) / least({WARM_ACCUM}, greatest(1, (SELECT count(*) FROM blosses))), 6) AS step_loss
FROM blosses GROUP BY 2""")
def q_warmup_step_losses(spark, sf_dir):
    b = _warm_losses(spark, sf_dir).withColumn("epoch", F.lit(0)).withColumn("batch_index", F.col("batch_id"))
    return M.step_loss(b, WARM_ACCUM, rule="warmup").select("epoch", "step", _r6("step_loss"))


@register("warmup_epoch_metrics", _with(*_WARM_LOSS_CTES) + """
SELECT 0 AS epoch, round(sum(loss * targets) / sum(targets), 6) AS epoch_loss, sum(targets)::BIGINT AS targets,
       sum(dataset_tokens)::BIGINT AS dataset_tokens,
       round(CASE WHEN isnan(sum(loss * targets) / sum(targets)) THEN 'NaN'::DOUBLE
                  WHEN sum(loss * targets) / sum(targets) < 50 THEN exp(sum(loss * targets) / sum(targets))
                  ELSE 'Infinity'::DOUBLE END, 6) AS ppl
FROM blosses""")
def q_warmup_epoch_metrics(spark, sf_dir):
    e = M.epoch_loss(_warm_losses(spark, sf_dir).withColumn("epoch", F.lit(0)))
    e = e.withColumn("ppl", M.perplexity("epoch_loss", rule="warmup"))
    return e.select("epoch", _r6("epoch_loss"), "targets", "dataset_tokens", _r6("ppl"))


def _window_losses(spark, sf_dir, manifest, windows, splits=("train", "val")):
    return TR.window_losses(_window_xy(spark, sf_dir, manifest, windows, splits), X.byte_losses(spark, sf_dir))


def _val_loss(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return M.validation_loss(_window_losses(spark, sf_dir, m, _val_windows(spark, m), ("val",)), VAL_N)


def _train_loss(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    a = _train_windows(spark, m)
    return TR.train_step_losses(a, _window_losses(spark, sf_dir, m, a, ("train",)), ACCUM)


_VAL_LOSS_CTES = (*_MANIFEST_CTES, O.window_counts(B, T, N), O.reads("val", str(VAL_N), B, T, N),
                  O.tokens_long(SHARD, CHUNK), O.BYTE_LOSSES, O.window_loss_sums(SHARD, B * T))
_TRAIN_LOSS_CTES = (*_MANIFEST_CTES, O.window_counts(B, T, N), O.step_plan(TOTAL_BATCH, B, T, N),
                    O.reads("train", f"SELECT max_steps * {ACCUM} FROM plan WHERE split = 'train'", B, T, N),
                    O.tokens_long(SHARD, CHUNK), O.BYTE_LOSSES, O.window_loss_sums(SHARD, B * T))


@register("validation_loss", _with(*_VAL_LOSS_CTES) + f"""
SELECT round(avg(l), 6) AS val_loss, count(*)::BIGINT AS ranks
FROM (SELECT rank, sum(loss) / {VAL_N} AS l FROM wl GROUP BY rank)""")
def q_validation_loss(spark, sf_dir):
    return _val_loss(spark, sf_dir).select(_r6("val_loss"), "ranks")


@register("train_step_losses", _with(*_TRAIN_LOSS_CTES) + f"""
SELECT step, round(avg(l), 6) AS loss FROM (
  SELECT read // {ACCUM} AS step, rank, sum(loss / {ACCUM}) AS l FROM wl GROUP BY read // {ACCUM}, rank)
GROUP BY step""")
def q_train_step_losses(spark, sf_dir):
    return _train_loss(spark, sf_dir).select(F.col("step").cast("long").alias("step"), _r6("loss"))


def _metric_rows(spark, sf_dir):
    """Train and validation windows are cut in one plan (one pass over the chunks); their
    losses, one row per window, are written for the two aggregates. Validation loss and
    accuracy enter as scalar subqueries."""
    from textloom.operators.windows import step_schedule
    from textloom.session import written_once
    m = _manifest(spark, sf_dir)
    a, v = _train_windows(spark, m), _val_windows(spark, m)
    cols = ["split", "rank", "read", "shard", "k", "start"]
    wl = written_once(_window_losses(spark, sf_dir, m, a.select(*cols).unionByName(v.select(*cols))), "window-losses")
    val = M.validation_loss(wl.where(F.col("split") == "val"), VAL_N).select("val_loss").scalar()
    _, _, lab = _labelled(spark, sf_dir)
    hella = CE.choice_accuracy(lab, ranks=N).select("acc_norm").scalar()
    train = TR.train_step_losses(a, wl.where(F.col("split") == "train"), ACCUM)
    return TR.metric_log(step_schedule(spark, _max_steps(m)), train, val, hella)


_LOG_CTES = (*_TRAIN_LOSS_CTES, O.reads("val", str(VAL_N), B, T, N, "v"), O.window_losses(SHARD, B * T, "v"),
             *[c for c in _CHOICE if c != O.BYTE_LOSSES])


def _log_sql(select: str) -> str:
    return _with(*_LOG_CTES, f"""vl AS (SELECT avg(l) FROM (SELECT rank, sum(loss) / {VAL_N} AS l FROM vwl GROUP BY rank)),
trl AS (SELECT step, avg(l) AS v FROM (
  SELECT read // {ACCUM} AS step, rank, sum(loss / {ACCUM}) AS l FROM wl GROUP BY read // {ACCUM}, rank) GROUP BY step),
hel AS (SELECT sum(correct_norm) / count(*) AS v FROM labelled),
ev AS (SELECT step FROM trl WHERE step % 250 = 0 OR step = (SELECT max(step) FROM trl)),
rows_ AS (
  SELECT step::BIGINT AS step, 'val' AS kind, (SELECT * FROM vl) AS value FROM ev
  UNION ALL SELECT step::BIGINT, 'hella', (SELECT v FROM hel) FROM ev
  UNION ALL SELECT step::BIGINT, 'train', v FROM trl)""") + select


@register("metric_log", _log_sql("""SELECT step, kind, CASE WHEN kind = 'train' THEN step::VARCHAR || ' train ' || printf('%.6f', value)
       ELSE step::VARCHAR || ' ' || kind || ' ' || printf('%.4f', value) END AS line FROM rows_"""))
def q_metric_log(spark, sf_dir):
    from textloom.sources.io import metric_lines
    return metric_lines(_metric_rows(spark, sf_dir)).select(F.col("step").cast("long").alias("step"), "kind", "line")


@register("loss_curve", _log_sql("""SELECT (row_number() OVER (ORDER BY step) - 1)::BIGINT AS x, step,
       round(value, 6) AS loss FROM rows_ WHERE kind = 'train'"""))
def q_loss_curve(spark, sf_dir):
    c = M.loss_curve(TR.train_rows(_train_loss(spark, sf_dir)), "train")
    return c.select("x", F.col("step").cast("long").alias("step"), _r6("loss"))


# ---------------------------------------------------------------- streaming (same oracles as batch)

from textloom.session import scratch_path  # noqa: E402
from textloom.streaming import streams as ST  # noqa: E402


@register("stream_sft_examples", ORACLE["sft_examples"])
def q_stream_sft_examples(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("sft-in", "sft-out", "sft-ck"))
    instr = X.instructions(spark, sf_dir)
    ST.stage_files(instr, src, "conv_id")
    ST.stream_sft(spark, ST.file_stream(spark, src, instr.schema), sink, ck, CH.CHAT_MAX_LEN)
    s = spark.read.parquet(sink)
    return s.select("conv_id", "turn", F.size("ids").cast("long").alias("n_ids"), "prompt_len",
                    ids_text("ids").alias("ids"))


@register("stream_choice_accuracy", ORACLE["choice_accuracy"])
def q_stream_choice_accuracy(spark, sf_dir):
    """The items stream, each batch is rendered, scored and counted; the loss table is static and computed once."""
    from textloom.session import written_once
    src, counters, ck = (scratch_path(spark, n) for n in ("acc-in", "acc-counters", "acc-ck"))
    items = X.choice_items(spark, sf_dir)
    ST.stage_files(items, src, "item", rows_per_file=10_000)
    losses = written_once(X.byte_losses(spark, sf_dir), "byte-losses")

    def score(batch):
        return _picked(CE.ending_losses(CE.token_losses(CE.render_choices(batch), losses)))

    ST.stream_accuracy(spark, ST.file_stream(spark, src, items.schema), score, counters, ck)
    return ST.accuracy_result(spark, counters).select("total", "correct", "correct_norm", _r6("acc"), _r6("acc_norm"))


def _streamed_chunks(spark, docs, encoder):
    src, shards, state, ck = (scratch_path(spark, n) for n in ("pack-in", "pack-shards", "pack-state", "pack-ck"))
    ST.stage_files(docs, src, "doc_id", rows_per_file=20_000)
    ST.stream_pack(spark, ST.file_stream(spark, src, docs.schema), shards, state, ck, SHARD, CHUNK, encoder)
    return ST.streamed_chunks(spark, shards, state, SHARD, CHUNK)


@register("stream_packed_chunks", ORACLE["packed_chunks"])
def q_stream_packed_chunks(spark, sf_dir):
    """X3 with the byte encoder."""
    ch = _streamed_chunks(spark, X.corpus(spark, sf_dir), BYTES)
    return ch.select("split", "shard", "chunk", "chunk_in_shard", "n_tokens", ids_text("tokens").alias("tokens"))


@register("stream_metric_latest", _log_sql("""SELECT kind, max(step)::INTEGER AS step,
       arg_max(CASE WHEN kind = 'train' THEN printf('%.6f', value) ELSE printf('%.4f', value) END, step)::DOUBLE AS value,
       count(*)::BIGINT AS lines FROM rows_ GROUP BY kind"""))
def q_stream_metric_latest(spark, sf_dir):
    from textloom.sources.io import metric_lines
    folder, sink, ck = (scratch_path(spark, n) for n in ("log-in", "log-out", "log-ck"))
    from textloom.session import written_once
    lines = written_once(metric_lines(_metric_rows(spark, sf_dir)), "log-lines")
    row = lines.agg(F.max("step").alias("hi")).first()
    parts = 4
    width = max(1, -(-(int(row["hi"]) + 1) // parts))
    for i in range(parts):  # log files arrive one after another
        lines.where((F.col("step") >= i * width) & (F.col("step") < (i + 1) * width)).select("line") \
            .coalesce(1).write.mode("append").text(folder)
    ST.stream_metric_log(spark, folder, sink, ck)
    return spark.read.parquet(sink).select("kind", F.col("step").cast("int").alias("step"), "value", "lines")


# ---------------------------------------------------------------- sources and sinks

from textloom.sources import io as IO  # noqa: E402


@register("stored_shards", ORACLE["packed_chunks"])
def q_stored_shards(spark, sf_dir):
    """S4 write, S5 read of each split (partition pruning), union."""
    path = scratch_path(spark, "shards")
    docs = X.corpus(spark, sf_dir)
    fold = C.shards_per_folder(docs, SHARD)
    IO.write_shards(C.corpus_chunks(docs, SHARD, CHUNK, group_shards=fold), path, per_folder=fold)
    parts = [IO.read_shards(spark, path, s) for s in IO.SPLITS]
    ch = parts[0].unionByName(parts[1])
    return ch.select("split", F.col("shard").cast("long").alias("shard"), "chunk", "chunk_in_shard", "n_tokens",
                     ids_text("tokens").alias("tokens"))


_NPY_CTES = (O.CORPUS, O.DOC_IDS, O.OFFSETS, O.tokens_long(SHARD, CHUNK))


@register("npy_shards", _with(*_NPY_CTES) + f"""
SELECT split, (gpos // {SHARD})::BIGINT AS shard, count(*)::BIGINT AS n_tokens, sum(tok)::BIGINT AS token_sum,
       sum(tok * ((gpos % {SHARD}) % 997))::BIGINT AS weighted_sum
FROM toks GROUP BY split, gpos // {SHARD}""")
def q_npy_shards(spark, sf_dir):
    """S6 export to .npy files and import back; per-shard count and checksums."""
    folder = scratch_path(spark, "npy")
    docs = X.corpus(spark, sf_dir)
    IO.export_npy(C.corpus_chunks(docs, SHARD, CHUNK), C.corpus_manifest(docs, SHARD, NAME), folder, NAME)
    back = IO.import_npy(spark, folder, CHUNK)
    t = back.select("split", "shard", "chunk_in_shard", F.posexplode("tokens").alias("i", "tok"))
    p = F.col("chunk_in_shard") * CHUNK + F.col("i")
    return t.groupBy("split", "shard").agg(
        F.count(F.lit(1)).cast("long").alias("n_tokens"), F.sum("tok").cast("long").alias("token_sum"),
        F.sum(F.col("tok") * F.pmod(p, F.lit(997))).cast("long").alias("weighted_sum"))


@register("shard_list", _with(*_MANIFEST_CTES) + """
SELECT name, split, (row_number() OVER (ORDER BY name) - 1)::BIGINT AS position FROM manifest WHERE contains(name, 'train')""")
def q_shard_list(spark, sf_dir):
    """Shard names holding the split name, sorted as strings (position by row index)."""
    from textloom.operators.order import row_index
    names = IO.list_shards(_manifest(spark, sf_dir), "train").select("name", "split", "shard")
    return row_index(names, ["shard"], out="position").select("name", "split", "position")


@register("metric_log_file", _log_sql("""SELECT step::INTEGER AS step, kind,
       (CASE WHEN kind = 'train' THEN printf('%.6f', value) ELSE printf('%.4f', value) END)::DOUBLE AS value FROM rows_"""))
def q_metric_log_file(spark, sf_dir):
    """The metric log written as text lines and parsed back."""
    path = scratch_path(spark, "log")
    IO.write_metric_log(_metric_rows(spark, sf_dir), path)
    return IO.read_metric_log(spark, path)


# ---------------------------------------------------------------- tokens: decode, special tokens, encoders

@register("decoded_documents", _with(O.CORPUS) + """
SELECT doc_id, split, text AS decoded, strlen(text)::BIGINT AS n_bytes FROM corpus""")
def q_decoded_documents(spark, sf_dir):
    """T10 round trip over whole texts: decode(encode(text)) with the delimiter dropped."""
    from textloom.functions.tokens import byte_decode
    ids = C.document_ids(X.corpus(spark, sf_dir))
    return ids.select("doc_id", "split", byte_decode("ids", skip_special=True).alias("decoded"),
                      (F.size("ids") - 1).cast("long").alias("n_bytes"))


from textloom.operators import vocab as V  # noqa: E402
from textloom.operators import extend as U  # noqa: E402
from textloom.functions.tokens import BYTE_VOCAB, byte_encode_length  # noqa: E402

WORD_V = 32256  # the reference's base vocabulary size

_SPECIAL_VALUES = ", ".join(f"('{t}', {BYTE_VOCAB + i - 32256}, '{' '.join(['bos', 'eos'] if t == '<|endoftext|>' else ['pad'] if t == '<|pad|>' else ['additional'])}')"
                            for t, i in __import__("textloom.functions.tokens", fromlist=["SPECIAL_TOKENS"]).SPECIAL_TOKENS)


@register("special_token_counts", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN)) + f"""
, st AS (SELECT * FROM (VALUES {_SPECIAL_VALUES}) v(token, id, roles)),
occ AS (SELECT t AS id, count(*) AS n FROM (SELECT unnest(ids) AS t FROM sft) WHERE t >= {BYTE_VOCAB} GROUP BY t)
SELECT st.token, st.id::INTEGER AS id, st.roles, coalesce(occ.n, 0)::BIGINT AS occurrences,
       ({BYTE_VOCAB} + 10)::BIGINT AS vocab_size, {EOT}::INTEGER AS eos_id, {PAD}::INTEGER AS pad_id
FROM st LEFT JOIN occ ON occ.id = st.id""")
def q_special_token_counts(spark, sf_dir):
    """T1-T3 + T5: the special-token table (byte ids) read from a tokenizer folder, its use in SFT examples, the
    vocabulary size and the resolved eos / pad ids."""
    folder = scratch_path(spark, "tokenizer")
    V.write_tokenizer_folder(V.special_tokens(spark, base=BYTE_VOCAB), folder)
    st = V.read_tokenizer_folder(spark, folder)
    ids = CH.sft_examples(X.instructions(spark, sf_dir)).select(F.explode("ids").alias("id")).where(F.col("id") >= BYTE_VOCAB)
    occ = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    size = V.vocab_size(BYTE_VOCAB, st).first()["vocab_size"]
    eos = V.resolve_token_id(st, "eos").first()["eos_id"]
    pad = V.resolve_token_id(st, "pad").first()["pad_id"]
    return F.broadcast(st).join(occ, "id", "left").select(  # 10 rows
        "token", "id", F.array_join("roles", " ").alias("roles"), F.coalesce("n", F.lit(0)).cast("long").alias("occurrences"),
        F.lit(size).cast("long").alias("vocab_size"), F.lit(eos).cast("int").alias("eos_id"),
        F.lit(pad).cast("int").alias("pad_id"))


@register("word_vocab", _with(O.CORPUS, O.word_vocab(WORD_V)) + """
SELECT word, count, id FROM wvocab""")
def q_word_vocab(spark, sf_dir):
    return V.word_vocab(X.corpus(spark, sf_dir), WORD_V).select("word", "count", "id")


@register("word_token_ids", _with(O.CORPUS, O.word_vocab(WORD_V), O.word_ids(WORD_V)) + f"""
SELECT doc_id, split, len(ids)::BIGINT AS n_ids, {O.ids_text('ids')} AS ids FROM wids""")
def q_word_token_ids(spark, sf_dir):
    docs = X.corpus(spark, sf_dir)
    e = V.word_encode(docs, V.word_vocab(docs, WORD_V), WORD_V)
    return e.select("doc_id", "split", F.size("ids").cast("long").alias("n_ids"), ids_text("ids").alias("ids"))


@register("encoder_totals", _with(O.CORPUS) + f"""
SELECT split, count(*)::BIGINT AS documents, sum(strlen(text))::BIGINT AS bytes_tokens,
       sum(len(regexp_extract_all(text, {O.q(O.WORD_PATTERN)}, 1)))::BIGINT AS words_tokens,
       round(sum(strlen(text)) / sum(len(regexp_extract_all(text, {O.q(O.WORD_PATTERN)}, 1))), 6) AS bytes_per_word
FROM corpus GROUP BY split""")
def q_encoder_totals(spark, sf_dir):
    """T11 + T12: token totals per split under the byte and word encoders, one pass."""
    t = V.compare_encoders(X.corpus(spark, sf_dir), {"bytes": byte_encode_length("text"),
                                                      "words": F.size(V.word_pieces("text"))})
    return t.withColumn("bytes_per_word", F.round(F.col("bytes_tokens") / F.col("words_tokens"), 6))


@register("row_positions", _with(O.CORPUS) + """
SELECT split, doc_id, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1)::BIGINT AS idx FROM corpus""")
def q_row_positions(spark, sf_dir):
    """Dense position per split in key order (two-level numbering)."""
    from textloom.operators.order import row_index
    return row_index(X.corpus(spark, sf_dir).select("split", "doc_id"), ["doc_id"], ["split"], out="idx")


@register("rank_shares", _with(O.CORPUS) + """
, n AS (SELECT count(*) AS total FROM corpus),
pos AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM corpus)
SELECT doc_id, (i % 2)::INTEGER AS rank_modulo,
       (CASE WHEN i < (total % 3) * (total // 3 + 1) THEN i // (total // 3 + 1)
             ELSE (total % 3) + (i - (total % 3) * (total // 3 + 1)) // (total // 3) END)::INTEGER AS worker_contiguous
FROM pos, n""")
def q_rank_shares(spark, sf_dir):
    """A row's rank under the modulo rule (2 ranks) and its worker under the
    contiguous rule (3 workers), over the dense row index."""
    from textloom.operators.order import row_index, shard_rows
    d = row_index(X.corpus(spark, sf_dir).select("doc_id"), ["doc_id"], out="i")
    m = shard_rows(d, "i", 2, None, mode="modulo").withColumnRenamed("worker", "rank_modulo")
    c = shard_rows(m, "i", 3, None, mode="contiguous").withColumnRenamed("worker", "worker_contiguous")
    return c.select("doc_id", "rank_modulo", "worker_contiguous")


def _py_bytes_encoder():
    def enc(texts):
        return [list(t.encode("utf-8")) for t in texts]
    return enc


@register("custom_encoder_ids", _with(O.CORPUS) + f"""
SELECT doc_id, len({O.plain_bytes('text')})::BIGINT AS n_ids, {O.ids_text(O.plain_bytes('text'))} AS ids FROM corpus""")
def q_custom_encoder_ids(spark, sf_dir):
    """A user encoder (here plain UTF-8 bytes in Python) through mapInPandas."""
    e = U.with_encoder(X.corpus(spark, sf_dir), _py_bytes_encoder)
    return e.select("doc_id", F.size("ids").cast("long").alias("n_ids"), ids_text("ids").alias("ids"))


@register("mapped_documents", _with(O.CORPUS) + """
SELECT doc_id, strlen(text)::BIGINT AS n_bytes, length(text)::BIGINT AS n_chars FROM corpus""")
def q_mapped_documents(spark, sf_dir):
    """A user function over document batches (byte and character counts in pandas)."""
    def fn(pdf):
        import pandas as pd
        return pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["text"].map(lambda t: len(t.encode("utf-8"))),
                             "n_chars": pdf["text"].str.len()})
    return U.map_documents(X.corpus(spark, sf_dir).select("doc_id", "text"), fn, "doc_id long, n_bytes long, n_chars long")


def _length_report(pdf):
    """A user's batch function: how long a batch's sequences are and what padding to the longest adds."""
    import pandas as pd
    n = pdf["ids"].map(len)
    return pd.DataFrame({"batch_id": [pdf["batch_id"].iloc[0]], "n_rows": [len(n)], "longest": [n.max()],
                         "total": [n.sum()], "padding": [(n.max() - n).sum()]})


@register("custom_collate", f"""
SELECT batch_id, count(*)::BIGINT AS n_rows, max(n_ids)::BIGINT AS longest, sum(n_ids)::BIGINT AS total,
       (count(*) * max(n_ids) - sum(n_ids))::BIGINT AS padding
FROM ({ORACLE["chat_batches"]}) GROUP BY batch_id""")
def q_custom_collate(spark, sf_dir):
    """The user's batch function through groupBy(batch).applyInPandas."""
    from textloom.operators.collate import assign_batches
    ex = CH.sft_examples(X.instructions(spark, sf_dir))
    b = assign_batches(ex, ["conv_id", "turn"], CH.CHAT_BATCH).select("batch_id", "ids")
    return U.collate(b, _length_report, "batch_id long, n_rows long, longest long, total long, padding long")


@register("split_corpora", """
SELECT 'train' AS split, doc_id, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents
UNION ALL SELECT 'val', item_id, length(coalesce(text, ''))::BIGINT FROM benchmark""")
def q_split_corpora(spark, sf_dir):
    """``documents`` as the training corpus, ``benchmark`` as the validation corpus."""
    from textloom.functions.text import coerce_text
    train = X.read_table(spark, sf_dir, "documents").select("doc_id", coerce_text("text").alias("text"))
    val = X.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), coerce_text("text").alias("text"))
    return C.assign_split(train, val).select("split", "doc_id", F.length("text").cast("long").alias("n_chars"))


@register("choice_items_json", ORACLE["choice_items"])
def q_choice_items_json(spark, sf_dir):
    """Items written as JSON lines and read back with the explicit item schema."""
    path = scratch_path(spark, "items-json")
    X.choice_items(spark, sf_dir).select(F.col("item").alias("ind"), "ctx", "label", "endings") \
        .write.mode("overwrite").json(path)
    i = IO.read_choice_items(spark, path)
    return i.select(F.col("ind").alias("item"), "ctx", "label", F.array_join("endings", " || ").alias("endings"))


@register("documents_files", _with(O.CORPUS) + """
SELECT fmt, doc_id, text FROM corpus, (VALUES ('json'), ('parquet')) f(fmt)""")
def q_documents_files(spark, sf_dir):
    """Documents as JSON lines and as parquet, with columns a reader must leave out; null texts come back empty."""
    rows = IO.read_table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("body"))
    out = []
    for fmt in ("json", "parquet"):
        path = scratch_path(spark, f"documents-{fmt}")
        rows.write.format(fmt).save(path)
        back = IO.read_documents(spark, path, fmt, text_col="body")
        out.append(back.select(F.lit(fmt).alias("fmt"), F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return out[0].unionByName(out[1])


@register("instructions_json", _with(O.INSTRUCTIONS) + """
SELECT conv_id, turn, system_prompt, question, response FROM instructions""")
def q_instructions_json(spark, sf_dir):
    """S3: instruction rows as JSON lines, read back with the instruction schema plus keys;
    null fields stay null."""
    from pyspark.sql import types as Ty
    path = scratch_path(spark, "instr-json")
    X.instructions(spark, sf_dir).write.mode("overwrite").json(path)
    schema = Ty.StructType([Ty.StructField("conv_id", Ty.LongType()), Ty.StructField("turn", Ty.LongType())]
                           + list(IO.INSTRUCTION_SCHEMA.fields))
    return IO.read_instructions(spark, path, schema=schema)


@register("context_crop", _with(O.CORPUS, O.DOC_IDS) + f"""
SELECT doc_id, split, least(len(ids), {CH.CHAT_MAX_LEN})::BIGINT AS n_ids,
       {O.ids_text(f"CASE WHEN len(ids) > {CH.CHAT_MAX_LEN} THEN ids[len(ids) - {CH.CHAT_MAX_LEN} + 1:] ELSE ids END")} AS ids
FROM doc_ids""")
def q_context_crop(spark, sf_dir):
    """The last 1,024 ids of each document (delimiter first), as a context crop."""
    from textloom.functions.tokens import keep_last
    ids = C.document_ids(X.corpus(spark, sf_dir))
    k = ids.select("doc_id", "split", keep_last("ids", CH.CHAT_MAX_LEN).alias("ids"))
    return k.select("doc_id", "split", F.size("ids").cast("long").alias("n_ids"), ids_text("ids").alias("ids"))


# ---------------------------------------------------------------- encoders as a parameter, caps, draws, reductions

from textloom.operators.encoders import BYTES, BpeEncoder, ByteEncoder, UserEncoder, WordEncoder, decode_ids  # noqa: E402

WORD_EOT = WORD_V + 1
# Merges (rank, left, right, id) over byte ids: th, the, " the", in, ing, er, an, and, de
MERGES = [(0, 116, 104, 300), (1, 300, 101, 301), (2, 32, 301, 302), (3, 105, 110, 303), (4, 303, 103, 304),
          (5, 101, 114, 305), (6, 97, 110, 306), (7, 306, 100, 307), (8, 100, 101, 308)]


def _word_encoder(spark, sf_dir):
    docs = X.corpus(spark, sf_dir)
    return docs, WordEncoder(V.word_vocab(docs, WORD_V), WORD_V)


@register("packed_word_chunks", _with(O.CORPUS, O.word_vocab(WORD_V), O.word_ids(WORD_V),
                                      f"doc_ids AS (SELECT split, doc_id, [{WORD_EOT}] || ids AS ids FROM wids)",
                                      O.OFFSETS, O.tokens_long(SHARD, CHUNK)) + f"""
SELECT split, (chunk // {SHARD // CHUNK})::BIGINT AS shard, chunk, n_tokens, tokens FROM chunks""")
def q_packed_word_chunks(spark, sf_dir):
    """K2 with the word encoder."""
    docs, words = _word_encoder(spark, sf_dir)
    ch = C.corpus_chunks(docs, SHARD, CHUNK, words)
    return ch.select("split", "shard", "chunk", "n_tokens", ids_text("tokens").alias("tokens"))


@register("stream_packed_words", ORACLE["packed_word_chunks"])
def q_stream_packed_words(spark, sf_dir):
    """X3 with the word encoder."""
    ch = _streamed_chunks(spark, *_word_encoder(spark, sf_dir))
    return ch.select("split", "shard", "chunk", "n_tokens", ids_text("tokens").alias("tokens"))


def _plain_bytes():
    return lambda texts: [list(t.encode("utf-8")) for t in texts]


@register("sft_examples_user_encoder", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN, O.plain_bytes)) + f"""
SELECT conv_id, turn, len(ids)::BIGINT AS n_ids, prompt_len, {O.ids_text('ids')} AS ids FROM sft""")
def q_sft_examples_user_encoder(spark, sf_dir):
    """B8 with a user's encoder (U1): UTF-8 bytes, control strings not special."""
    s = CH.sft_examples(X.instructions(spark, sf_dir), encoder=UserEncoder(_plain_bytes, EOT, PAD))
    return s.select("conv_id", "turn", F.size("ids").cast("long").alias("n_ids"),
                    F.col("prompt_len").cast("long").alias("prompt_len"), ids_text("ids").alias("ids"))


@register("bpe_token_ids", _with(O.CORPUS) + f"""
SELECT doc_id, split, {O.bpe_ids('text', MERGES)} AS ids FROM corpus""")
def q_bpe_token_ids(spark, sf_dir):
    """T4 ``bpe`` with a small fixed merges table."""
    bpe = BpeEncoder(spark.createDataFrame(MERGES, "rank int, left int, right int, id int"))
    return bpe.with_ids(X.corpus(spark, sf_dir), ids=F.col("text")).select("doc_id", "split", ids_text("ids").alias("ids"))


# A merges table of thousands of rules: each joins two ASCII letters, digits or a space, or such a pair and one more.
BPE_ALPHABET = " abcdefghijklmnopqrstuvwxyz0123456789"


def large_merges(spark):
    """Two-byte rules for all pairs of ``BPE_ALPHABET`` after a space rule order by id, then three-byte rules by pair and letter."""
    k = len(BPE_ALPHABET)
    byte = F.array(*[F.lit(ord(c)) for c in BPE_ALPHABET])
    two = spark.range(k * k).select(F.col("id").cast("int").alias("rank"), F.get(byte, F.expr(f"cast(id div {k} as int)")).alias("left"),
                                    F.get(byte, (F.col("id") % k).cast("int")).alias("right"))
    n = k * k
    three = spark.range(n * 8).select((F.col("id") + n).cast("int").alias("rank"), F.expr("cast(id div 8 as int) + 300").alias("left"),
                                      F.get(byte, (F.col("id") % 8 + 1).cast("int")).alias("right"))
    return two.unionByName(three).withColumn("id", F.col("rank") + 300)


@register("bpe_large_totals", _with(O.CORPUS) + """
SELECT split, count(*)::BIGINT AS documents, sum(octet_length(encode(text)))::BIGINT AS bytes FROM corpus GROUP BY split""")
def q_bpe_large_totals(spark, sf_dir):
    """T4 ``bpe`` with a merges table of 12,321 rules over all documents: each id stands for one, two or three bytes, and
    these must add up to the bytes of the texts."""
    ids = BpeEncoder(large_merges(spark)).with_ids(X.corpus(spark, sf_dir), ids=F.col("text"))
    two = len(BPE_ALPHABET) ** 2
    size = F.aggregate("ids", F.lit(0).cast("long"), lambda s, i: s + F.when(i < 300, 1).when(i < 300 + two, 2).otherwise(3))
    return ids.groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum(size).alias("bytes"))


@register("folder_special_ids", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN)) + f"""
SELECT conv_id, turn, len(ids)::BIGINT AS n_ids,
       {O.ids_text("list_transform(ids, lambda x: CASE WHEN x >= 256 THEN x - 256 + 32256 ELSE x END)")} AS ids FROM sft""")
def q_folder_special_ids(spark, sf_dir):
    """T1 + T5: control strings and their ids as a tokenizer's folder has them, used to encode the chat texts."""
    folder = scratch_path(spark, "tokenizer")
    V.write_tokenizer_folder(V.special_tokens(spark), folder)
    enc = ByteEncoder(V.read_tokenizer_folder(spark, folder))
    ex = CH.sft_examples(X.instructions(spark, sf_dir), CH.CHAT_MAX_LEN, enc)
    return ex.select("conv_id", "turn", F.size("ids").cast("long").alias("n_ids"), ids_text("ids").alias("ids"))


@register("decoded_words", _with(O.CORPUS, O.word_vocab(WORD_V)) + f"""
, pieces AS (SELECT doc_id, split, unnest(ws) AS w, unnest(range(len(ws))) AS p
  FROM (SELECT doc_id, split, regexp_extract_all(text, {O.q(O.WORD_PATTERN)}, 1) AS ws FROM corpus))
SELECT c.doc_id, c.split, '<|endoftext|>' || coalesce(string_agg(' ' || w.word, '' ORDER BY w.p), '') AS kept,
       coalesce(string_agg(w.word, ' ' ORDER BY w.p), '') AS dropped
FROM corpus c LEFT JOIN (SELECT p.doc_id, p.p, coalesce(v.word, '<unk>') AS word FROM pieces p LEFT JOIN wvocab v ON v.word = p.w) w
  ON w.doc_id = c.doc_id GROUP BY c.doc_id, c.split""")
def q_decoded_words(spark, sf_dir):
    """T10 through a vocabulary table, special tokens kept and dropped."""
    docs, words = _word_encoder(spark, sf_dir)
    vocab = V.word_vocab(docs, WORD_V).select("id", F.col("word").alias("piece"), F.lit(False).alias("special"))
    extra = [(WORD_V, "<unk>", False)] + [(i, t, True) for t, i in words.specials.items()]
    vocab = vocab.unionByName(spark.createDataFrame(extra, "id int, piece string, special boolean"))
    d = C.document_ids(docs, words).select("doc_id", "split", "ids")
    d = decode_ids(decode_ids(d, vocab, "kept", sep=" "), vocab, "dropped", sep=" ", skip_special=True)
    return d.select("doc_id", "split", "kept", "dropped")


@register("first_rows", _with(O.CORPUS) + """
SELECT doc_id, split FROM corpus ORDER BY doc_id LIMIT 100""")
def q_first_rows(spark, sf_dir):
    """P5: the first 100 raw rows (the cap is the operator)."""
    from textloom.operators.order import take_rows
    return take_rows(X.corpus(spark, sf_dir).select("doc_id", "split"), ["doc_id"], 100)


@register("valid_rows_per_worker", _with(O.INSTRUCTIONS, O.CHAT_TEXT, O.sft(CH.CHAT_MAX_LEN)) + """
, shares AS (SELECT conv_id, turn, ((row_number() OVER (ORDER BY conv_id, turn) - 1) % 3)::INTEGER AS worker FROM instructions)
SELECT worker, conv_id, turn FROM (
  SELECT s.worker, s.conv_id, s.turn, row_number() OVER (PARTITION BY s.worker ORDER BY s.conv_id, s.turn) AS n
  FROM sft JOIN shares s USING (conv_id, turn)) WHERE n <= 8""")
def q_valid_rows_per_worker(spark, sf_dir):
    """3 workers take their share of the rows and stop at 8 valid examples each."""
    from textloom.operators.order import row_index, shard_rows
    shares = shard_rows(row_index(X.instructions(spark, sf_dir), ["conv_id", "turn"], out="_i"), "_i", 3)
    return CH.take_valid_rows(CH.sft_examples(shares), ["conv_id", "turn"], 8, "worker").select("worker", "conv_id", "turn")


@register("stream_valid_rows", ORACLE["valid_rows_per_worker"])
def q_stream_valid_rows(spark, sf_dir):
    """X1 + S3 + P6: JSON lines streamed in several batches, 3 workers that stop at 8 valid examples each."""
    src, sink, state, ck = (scratch_path(spark, n) for n in ("valid-in", "valid-out", "valid-state", "valid-ck"))
    instr = X.instructions(spark, sf_dir)
    ST.stage_files(instr, src, ["conv_id", "turn"], fmt="json")
    rows = IO.read_instructions(spark, src, streaming=True, schema=instr.schema, maxFilesPerTrigger=1)
    ST.stream_valid_rows(spark, rows, sink, state, ck, 8, 3)
    return spark.read.parquet(sink).select("worker", "conv_id", "turn")


TEMPERATURE = 0.8


@register("generation_draw", _with(O.LOGITS) + f"""
, warm AS (SELECT row_id, list_transform(z, lambda x: x / {TEMPERATURE}) AS zs, list_max(z) / {TEMPERATURE} AS m FROM lg),
cut AS (SELECT row_id, list_transform(zs, lambda x: CASE WHEN x < list_sort(zs, 'DESC')[least({THRESH_K}, len(zs))] THEN 0 ELSE exp(x - m) END) AS e FROM warm),
ps AS (SELECT row_id, list_sort(list_transform(e, lambda x, i: {{'neg': -x / list_sum(e), 'token': i - 1}})) AS top,
       ('0x' || substr(md5('42:' || row_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM cut),
cums AS (SELECT row_id, top, u, list_transform(top, lambda s, i: list_sum(list_transform(list_slice(top, 1, i), lambda t: -t.neg))) AS cum FROM ps)
SELECT row_id, (top[list_position(list_transform(cum, lambda c: c > u * cum[-1]), true)]).token::INTEGER AS token FROM cums""")
def q_generation_draw(spark, sf_dir):
    """L5, L7, L1 and the draw as one flow: temperature, threshold, softmax, one token."""
    lg = X.logits_table(spark, sf_dir).withColumn("z", S.topk_threshold(S.scale_temperature("logits", TEMPERATURE), THRESH_K))
    return S.sample_pick(lg, "z", "row_id", None, 42).select("row_id", F.col("token").cast("int").alias("token"))


@register("step_throughput", _with(*_MANIFEST_CTES, O.step_plan(TOTAL_BATCH, B, T, N)) + f"""
SELECT s.step::BIGINT AS step, {B * T * ACCUM * N}::BIGINT AS tokens, round({B * T * ACCUM * N} / dt, 6) AS tokens_per_sec,
       round(dt * 1000, 6) AS ms_per_step
FROM (SELECT s.step, 0.1::DOUBLE + (s.step % 7) * 0.01::DOUBLE AS dt
      FROM (SELECT max_steps AS m FROM plan WHERE split = 'train') p, range(p.m) s(step)) s""")
def q_step_throughput(spark, sf_dir):
    """M5 over the steps of the plan, with step times by a fixed rule."""
    from textloom.operators.windows import step_schedule
    steps = step_schedule(spark, _max_steps(_manifest(spark, sf_dir)))
    dt = F.lit(0.1) + F.pmod("step", F.lit(7)) * F.lit(0.01)
    return M.throughput(steps.select("step", dt.alias("dt")), B, T, ACCUM, N).select(
        "step", "tokens", _r6("tokens_per_sec"), _r6("ms_per_step"))


@register("rank_windows", _with(*_MANIFEST_CTES, O.window_counts(B, T, N)) + """
SELECT split, shard, sum(windows)::BIGINT AS total, avg(windows) AS mean FROM wcounts GROUP BY split, shard""")
def q_rank_windows(spark, sf_dir):
    """M6: the ranks' windows of a shard as SUM and AVG."""
    c = _counts(_manifest(spark, sf_dir))
    total = M.rank_reduce(c, ["split", "shard"], "windows", "sum").withColumnRenamed("windows", "total")
    mean = M.rank_reduce(c, ["split", "shard"], "windows").withColumnRenamed("windows", "mean")
    return total.join(mean, ["split", "shard"]).select("split", "shard", "total", "mean")
