"""DuckDB SQL fragments for the oracle queries (same rules, written in SQL)."""

from __future__ import annotations

import re

from textloom.functions.tokens import BYTE_VOCAB, byte_special_ids

SID = byte_special_ids()
_ALT = "|".join(re.escape(t) for t in SID)
PATTERN = f"({_ALT}|[^<]+|<)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def plain_bytes(expr: str) -> str:
    """UTF-8 byte ids of a string expression."""
    return f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), lambda h: ('0x' || h)::INTEGER)"


def byte_ids(expr: str) -> str:
    """Byte encoder with literal special tokens split off first."""
    cases = " ".join(f"WHEN {q(t)} THEN [{i}]" for t, i in SID.items())
    return (f"flatten(list_transform(regexp_extract_all({expr}, {q(PATTERN)}, 1), "
            f"lambda p: CASE p {cases} ELSE {plain_bytes('p')} END))")


def ids_text(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: x::VARCHAR), ' ')"


STRIP = "".join(chr(c) for c in (
    list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def normalize(expr: str) -> str:
    return f"trim(coalesce({expr}::VARCHAR, ''), {q(STRIP)})"


CORPUS = """corpus AS (
  SELECT CASE WHEN doc_id % 20 = 0 THEN 'val' ELSE 'train' END AS split,
         doc_id::BIGINT AS doc_id, coalesce(text, '') AS text
  FROM documents)"""

DOC_IDS = f"""doc_ids AS (
  SELECT split, doc_id, [{SID['<|endoftext|>']}] || {byte_ids('text')} AS ids FROM corpus)"""

OFFSETS = """offsets AS (
  SELECT split, doc_id, ids, len(ids)::BIGINT AS n_tokens,
         coalesce(sum(len(ids)) OVER (PARTITION BY split ORDER BY doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM doc_ids)"""


def tokens_long(shard_size: int, chunk_size: int) -> str:
    return f"""toks AS (
  SELECT split, start + i - 1 AS gpos, tok FROM (
    SELECT split, start, unnest(ids) AS tok, unnest(range(1, len(ids) + 1)) AS i FROM offsets)),
chunks AS (
  SELECT split, (gpos // {chunk_size})::BIGINT AS chunk,
         string_agg(tok::VARCHAR, ' ' ORDER BY gpos) AS tokens, count(*)::BIGINT AS n_tokens,
         list(tok ORDER BY gpos) AS tok_list
  FROM toks GROUP BY split, gpos // {chunk_size})"""


def totals(shard_size: int) -> str:
    return f"""totals AS (
  SELECT split, count(*)::BIGINT AS documents, sum(n_tokens)::BIGINT AS tokens,
         ceil(sum(n_tokens) / {shard_size})::BIGINT AS shards,
         (sum(n_tokens) % {shard_size})::BIGINT AS last_shard_tokens
  FROM offsets GROUP BY split)"""


def manifest(shard_size: int, name: str) -> str:
    return f"""manifest AS (
  SELECT split, shard::BIGINT AS shard,
         '{name}_' || split || '_' || lpad(shard::VARCHAR, 6, '0') AS name,
         least({shard_size}, tokens - shard * {shard_size})::BIGINT AS n_tokens
  FROM (SELECT split, tokens, unnest(range(shards)) AS shard FROM totals))"""


def window_counts(B: int, T: int, N: int) -> str:
    bt = B * T
    return f"""wcounts AS (
  SELECT split, shard, name, rank::INTEGER AS rank, n_tokens,
         greatest(1, (n_tokens - 1 - {bt} * rank) // {bt * N})::BIGINT AS windows
  FROM (SELECT *, unnest(range({N})) AS rank FROM manifest)),
wfirst AS (
  SELECT *, coalesce(sum(windows) OVER (PARTITION BY split, rank ORDER BY shard
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
  FROM wcounts),
wlist AS (
  SELECT split, rank, shard, first + k AS ordinal, k::BIGINT AS k
  FROM (SELECT split, rank, shard, first, unnest(range(windows)) AS k FROM wfirst)),
wtotal AS (SELECT split, rank, sum(windows)::BIGINT AS total FROM wcounts GROUP BY split, rank)"""


def step_plan(total_batch: int, B: int, T: int, N: int) -> str:
    btn = B * T * N
    accum = total_batch // btn
    return f"""plan AS (
  SELECT split, count(*)::BIGINT AS shards, {accum}::BIGINT AS grad_accum,
         sum((n_tokens - 1) // {btn})::BIGINT AS micro_batches,
         (sum((n_tokens - 1) // {btn}) // {accum})::BIGINT AS max_steps
  FROM manifest GROUP BY split)"""


def reads(split: str, count_sql: str, B: int, T: int, N: int, p: str = "") -> str:
    bt = B * T
    return f"""{p}reads AS (
  SELECT '{split}' AS split, r.read::BIGINT AS read, k.rank::INTEGER AS rank
  FROM range(({count_sql})) r(read), range({N}) k(rank)),
{p}assigned AS (
  SELECT r.split, r.rank, r.read, w.shard, w.k, ({bt} * r.rank + w.k * {bt * N})::BIGINT AS start
  FROM {p}reads r JOIN wtotal t ON r.split = t.split AND r.rank = t.rank
  JOIN wlist w ON w.split = r.split AND w.rank = r.rank AND w.ordinal = r.read % t.total)"""


def window_tokens(B: int, T: int, shard_size: int) -> str:
    bt = B * T
    return f"""wtok AS (
  SELECT a.split, a.rank, a.read, t.gpos - (a.shard * {shard_size} + a.start) AS p, t.tok
  FROM assigned a JOIN toks t ON t.split = a.split
   AND t.gpos >= a.shard * {shard_size} + a.start AND t.gpos <= a.shard * {shard_size} + a.start + {bt}),
wx AS (
  SELECT split, rank, read, (p // {T})::INTEGER AS row, string_agg(tok::VARCHAR, ' ' ORDER BY p) AS x
  FROM wtok WHERE p < {bt} GROUP BY ALL),
wy AS (
  SELECT split, rank, read, ((p - 1) // {T})::INTEGER AS row, string_agg(tok::VARCHAR, ' ' ORDER BY p) AS y
  FROM wtok WHERE p >= 1 GROUP BY ALL),
wrows AS (SELECT * FROM wx JOIN wy USING (split, rank, read, row))"""


INSTRUCTIONS = """conv AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
sysp AS (SELECT conv_id, arg_min(text, turn) AS system_prompt FROM conversations WHERE role = 'system' GROUP BY conv_id),
instructions AS (
  SELECT c.conv_id::BIGINT AS conv_id, c.turn::BIGINT AS turn, s.system_prompt, c.text AS question,
         CASE WHEN c.next_role = 'assistant' THEN c.next_text END AS response
  FROM conv c LEFT JOIN sysp s ON s.conv_id = c.conv_id WHERE c.role = 'user')"""

NL = "chr(10)"

CHAT_TEXT = f"""normed AS (
  SELECT conv_id, turn, {normalize('system_prompt')} AS s, {normalize('question')} AS q, {normalize('response')} AS r
  FROM instructions),
chat AS (
  SELECT conv_id, turn, r,
         concat_ws({NL}, CASE WHEN s <> '' THEN '<|im_start|>system' || {NL} || s || '<|im_end|>' END,
                   '<|im_start|>user' || {NL} || q || '<|im_end|>', '<|im_start|>assistant' || {NL}) AS prompt_text
  FROM normed WHERE q <> '' AND r <> ''),
chat2 AS (SELECT conv_id, turn, prompt_text, prompt_text || r || '<|im_end|>' AS full_text FROM chat)"""


def sft(max_len: int, ids=byte_ids) -> str:
    return f"""enc AS (
  SELECT conv_id, turn, prompt_text, full_text,
         list_slice({ids('prompt_text')}, 1, {max_len}) AS p_ids,
         list_slice({ids('full_text')}, 1, {max_len}) AS ids
  FROM chat2),
sft AS (
  SELECT conv_id, turn, ids, least(len(p_ids), len(ids))::BIGINT AS prompt_len FROM enc
  WHERE len(ids) >= 2 AND least(len(p_ids), len(ids)) < len(ids))"""


def collate(src: str, order: str, batch: int, max_len: int, eos: int, pad: int, warm: bool) -> str:
    if warm:
        tgt = f"list_transform(padded[2:width], lambda v, i: CASE WHEN v = {pad} AND i <> coalesce(list_position(padded[2:width], {pad}), 0) THEN -100 ELSE v END)"
        extra = ""
    else:
        tgt = "list_transform(padded[2:width], lambda v, i: CASE WHEN i - 1 < prompt_len - 1 OR i >= real_len THEN -100 ELSE v END)"
        extra = ", prompt_len"
    return f"""numbered AS (
  SELECT *, (row_number() OVER (ORDER BY {order}) - 1)::BIGINT AS row_idx FROM {src}),
seqs AS (
  SELECT *, row_idx // {batch} AS batch_id, (row_idx % {batch})::INTEGER AS batch_row,
         CASE WHEN len(ids) < {max_len} THEN ids || [{eos}] ELSE ids END AS seq FROM numbered),
widths AS (SELECT *, len(seq) AS real_len, max(len(seq)) OVER (PARTITION BY batch_id) AS width FROM seqs),
padded AS (SELECT *, seq || list_transform(range(width - real_len), lambda x: {pad}) AS padded FROM widths),
collated AS (
  SELECT *, padded[1:width - 1] AS inputs, {tgt} AS targets,
         list_transform(range(1, width), lambda j: CASE WHEN j <= real_len THEN 1 ELSE 0 END) AS attention
  FROM padded)"""


def choice_items() -> str:
    return """bwords AS (
  SELECT item_id::BIGINT AS item, string_split(text, ' ') AS w FROM benchmark),
halves AS (
  SELECT item, array_to_string(list_slice(w, 1, len(w) // 2), ' ') AS ctx,
         array_to_string(list_slice(w, len(w) // 2 + 1, len(w)), ' ') AS tail FROM bwords),
nitems AS (SELECT count(*) AS n FROM halves),
want AS (
  SELECT h.item, h.ctx, (h.item % 4)::INTEGER AS label, e.ending::INTEGER AS ending,
         (((h.item + e.ending - h.item % 4) % n.n) + n.n) % n.n AS src
  FROM halves h, nitems n, range(4) e(ending)),
items AS (
  SELECT w.item, w.ctx, w.label, list(t.tail ORDER BY w.ending) AS endings
  FROM want w JOIN halves t ON t.item = w.src GROUP BY w.item, w.ctx, w.label)"""


BYTE_LOSSES = f"""bytecounts AS (
  SELECT b AS token, count(*) AS n FROM (SELECT unnest({plain_bytes("coalesce(text, '')")}) AS b FROM documents) GROUP BY b),
alltok AS (SELECT t.token::INTEGER AS token, coalesce(c.n, 0) AS n FROM range({BYTE_VOCAB + len(SID)}) t(token)
  LEFT JOIN bytecounts c ON c.token = t.token),
byte_losses AS (SELECT token, -ln((n + 1) / ((SELECT sum(n) FROM alltok) + 256)) AS loss FROM alltok)"""

RENDERED = f"""rbase AS (
  SELECT i.item, i.label, e.ending::INTEGER AS ending, {byte_ids('i.ctx')} AS ctx_ids,
         {byte_ids("' ' || i.endings[e.ending + 1]")} AS end_ids
  FROM items i, range(4) e(ending)),
rtm AS (
  SELECT item, label, ending, len(ctx_ids) AS n_ctx, ctx_ids || end_ids AS t,
         list_transform(range(len(ctx_ids)), lambda x: 0) || list_transform(range(len(end_ids)), lambda x: 1) AS m
  FROM rbase),
rendered AS (
  SELECT item, label, ending, n_ctx, max(len(t)) OVER (PARTITION BY item) AS width,
         t || list_transform(range(max(len(t)) OVER (PARTITION BY item) - len(t)), lambda x: 0) AS tokens,
         m || list_transform(range(max(len(t)) OVER (PARTITION BY item) - len(t)), lambda x: 0) AS mask
  FROM rtm),
tpos AS (
  SELECT item, ending, unnest(tokens) AS token, unnest(range(len(tokens))) AS p,
         unnest(mask) AS m FROM rendered),
tlosses AS (
  SELECT a.item, a.ending, a.p - 1 AS pos, l.loss FROM tpos a JOIN byte_losses l ON l.token = a.token WHERE a.p >= 1),
masked AS (
  SELECT l.item, l.ending, l.pos, l.loss * b.m AS masked_loss, b.m FROM tlosses l
  JOIN tpos b ON b.item = l.item AND b.ending = l.ending AND b.p = l.pos + 1),
closs AS (
  SELECT item, ending, sum(masked_loss) AS sum_loss, sum(m)::BIGINT AS n_mask,
         CASE WHEN sum(m) > 0 THEN sum(masked_loss) / sum(m) ELSE 'NaN'::DOUBLE END AS mean_loss
  FROM masked GROUP BY item, ending),
preds AS (
  SELECT item, arg_min(ending, [sum_loss, ending]) AS pred,
         arg_min(ending, [CASE WHEN isnan(mean_loss) THEN 0 ELSE 1 END, mean_loss, ending]) AS pred_norm
  FROM closs GROUP BY item),
labelled AS (
  SELECT p.item, p.pred, p.pred_norm, i.label, (p.pred = i.label)::INTEGER AS correct,
         (p.pred_norm = i.label)::INTEGER AS correct_norm
  FROM preds p JOIN items i ON i.item = p.item)"""


LOGITS = """lg AS (
  SELECT vec_id::BIGINT AS row_id, label::INTEGER AS target, list_transform(embedding, lambda x: x::DOUBLE) AS z
  FROM embeddings),
lg2 AS (SELECT *, list_max(z) AS m FROM lg),
lg3 AS (SELECT *, list_sum(list_transform(z, lambda x: exp(x - m))) AS se FROM lg2),
scored AS (
  SELECT row_id, target, z, m, se, m + ln(se) - z[target + 1] AS loss,
         (list_position(z, m) - 1)::INTEGER AS greedy,
         list_transform(z, lambda x: exp(x - m) / se) AS probs
  FROM lg3)"""


def batch_losses(src: str) -> str:
    """Mean byte loss over the targets of each batch of ``src`` (a collated CTE)."""
    return f"""bt AS (SELECT batch_id, unnest(targets) AS token FROM {src}),
btl AS (SELECT b.batch_id, avg(l.loss) AS loss, count(*)::BIGINT AS targets FROM bt b
        JOIN byte_losses l ON l.token = b.token WHERE b.token <> -100 GROUP BY b.batch_id),
bdt AS (SELECT batch_id, sum(len(ids))::BIGINT AS dataset_tokens FROM {src} GROUP BY batch_id),
blosses AS (SELECT d.batch_id, coalesce(t.loss, 'NaN'::DOUBLE) AS loss, coalesce(t.targets, 0)::BIGINT AS targets,
            d.dataset_tokens FROM bdt d LEFT JOIN btl t ON t.batch_id = d.batch_id)"""


def cycled(accum: int, epochs: int) -> str:
    """Epochs of as many steps as read every batch once."""
    return f"""nb AS (SELECT count(*) AS n, (count(*) + {accum - 1}) // {accum} * {accum} AS per FROM blosses),
cyc AS (
  SELECT r.i AS read, (r.i // nb.per)::INTEGER AS epoch, ((r.i % nb.per) // {accum})::BIGINT AS step,
         b.loss, b.targets, b.dataset_tokens
  FROM range((SELECT (per * {epochs})::BIGINT FROM nb)) r(i), nb JOIN blosses b ON b.batch_id = r.i % nb.n)"""


TOKEN_LOSSES = """tl AS MATERIALIZED (
  SELECT t.split, t.gpos, sum(l.loss) OVER (PARTITION BY t.split ORDER BY t.gpos) AS cum
  FROM toks t JOIN byte_losses l ON l.token = t.tok)"""


def window_losses(shard_size: int, bt: int, p: str = "") -> str:
    """Losses of the windows in ``{p}assigned`` as ``{p}wl``."""
    return f"""{p}ak AS MATERIALIZED (
  SELECT split, rank, read, shard, k, shard * {shard_size} + start AS gs,
         shard * {shard_size} + start + {bt} AS ge FROM {p}assigned),
{p}wl AS (
  SELECT a.split, a.rank, a.read, a.shard, a.k, (e.cum - s.cum) / {bt} AS loss FROM {p}ak a
  JOIN tl s ON s.split = a.split AND s.gpos = a.gs
  JOIN tl e ON e.split = a.split AND e.gpos = a.ge)"""


def window_loss_sums(shard_size: int, bt: int) -> str:
    return f"{TOKEN_LOSSES},\n{window_losses(shard_size, bt)}"


WORD_PATTERN = r"(\p{L}+|\p{N}+|[^\p{L}\p{N}\t\n\x0B\f\r ]+)"


def word_vocab(size: int) -> str:
    return f"""wcount AS (
  SELECT w AS word, count(*)::BIGINT AS count
  FROM (SELECT unnest(regexp_extract_all(text, {q(WORD_PATTERN)}, 1)) AS w FROM corpus) GROUP BY w),
wvocab AS (
  SELECT word, count, (row_number() OVER (ORDER BY count DESC, word) - 1)::INTEGER AS id
  FROM wcount ORDER BY count DESC, word LIMIT {size})"""


BPE_PATTERN = r"( ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+)"


def bpe_ids(text: str, merges) -> str:
    """Ids of ``text`` as a string of numbers: its pre-tokens' bytes as ``<b>``, pre-tokens apart
    by ``|``, and one replacement for each merge in rank order."""
    byte = f"list_transform({plain_bytes('w')}, lambda b: '<' || b::VARCHAR || '>')"
    out = f"array_to_string(list_transform(regexp_extract_all({text}, {q(BPE_PATTERN)}, 1), lambda w: array_to_string({byte}, '')), '|')"
    for _, left, right, new in merges:
        out = f"replace({out}, '<{left}><{right}>', '<{new}>')"
    return f"trim(replace(replace({out}, '|', ''), '><', ' '), '<>')"


def word_ids(size: int) -> str:
    return f"""wpos AS (
  SELECT doc_id, split, unnest(ws) AS word, unnest(range(len(ws))) AS p
  FROM (SELECT doc_id, split, regexp_extract_all(text, {q(WORD_PATTERN)}, 1) AS ws FROM corpus)),
wids AS (
  SELECT c.doc_id, c.split, coalesce(list(coalesce(v.id, {size}) ORDER BY w.p) FILTER (WHERE w.p IS NOT NULL), [])::INTEGER[] AS ids
  FROM corpus c LEFT JOIN wpos w ON w.doc_id = c.doc_id LEFT JOIN wvocab v ON v.word = w.word
  GROUP BY c.doc_id, c.split)"""
