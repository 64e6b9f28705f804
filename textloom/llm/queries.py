"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op4_exact_dedup", f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""")
def op4(spark, sf_dir):
    from textloom.llm.exact_dedup import exact_groups

    out = exact_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op1_warc_normalise")
def op1(spark, sf_dir):
    from textloom.llm.warc import archive_pages
    from textloom.session import scratch_path

    out = archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_vector_packing")
def op3(spark, sf_dir):
    import public_tokenizers

    from textloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_source_mixing")
def op6(spark, sf_dir):
    from textloom.llm.mixing import mix_documents

    return mix_documents(table(spark, sf_dir, "documents"))


@query("op7_simhash_components")
def op7(spark, sf_dir):
    from textloom.llm.simhash import hex_fingerprint, near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_fingerprint(out.fp).alias("fingerprint"), "component_id")


@query("op9_chat_tokens")
def op9(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    from textloom.llm.chat_tokens import digests, format_turns, read_turns

    path = public_tokenizers.path("byte_bpe_50k.json")
    files = (path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    first = Tokenizer.from_file(path).get_vocab_size()
    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    return digests(read_turns(format_turns(rows.unionByName(extra), files, first), files, first))


@query("op10_crf_language")
def op10(spark, sf_dir):
    from textloom.llm.common import training_row
    from textloom.llm.crf import predict, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(training_row("doc_id", 5)))
    fold = docs.select("doc_id", (~training_row("doc_id", 5)).alias("held_out"), "text")
    return predict(fold, model, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")


@query("op5_maxent_lm")
def op5(spark, sf_dir):
    from textloom.llm.common import training_row
    from textloom.llm.maxent_lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"), training_row("doc_id", 10))


_SP = r"[\x20\x09-\x0D]+"
_WD = r"[^\x20\x09-\x0D]+"


@query("op2_line_frequency", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, t, regexp_extract_all(t, '{_WD}') AS w FROM d),
p AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM p) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT k)::BIGINT AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM rep) GROUP BY r),
l AS (SELECT r, host, t, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WD}'))) AS line FROM d),
dup AS (SELECT r, (count(*) - count(DISTINCT line))::BIGINT AS n FROM l GROUP BY r),
h AS (SELECT r, host, t, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SP}', ' ', 'g'), ' ') AS k,
             len(regexp_extract_all(line, '{_WD}')) AS n FROM l),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
common AS (SELECT host, k FROM h JOIN hosts USING (host) GROUP BY host, k, hosts.n HAVING count(DISTINCT t) > 3 AND 100 * count(DISTINCT t) > 2 * hosts.n),
gone AS (SELECT r, sum(n)::BIGINT AS n FROM h JOIN common USING (host, k) GROUP BY r),
f AS (SELECT doc_id, len(w.w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
      FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words - n_removed_words AS rest FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * rest >= 30 * n_words AND rest >= 20 AS kept, n_removed_words FROM b""")
def op2(spark, sf_dir):
    from textloom.llm.line_frequency import line_frequency

    return line_frequency(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8(spark, sf_dir):
    from textloom.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
             list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, br) <= 5),
m AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id NULLS LAST, s.br)::INT AS rank
      FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 3""")
def op11(spark, sf_dir):
    from textloom.llm.hard_negatives import mine

    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select("vec_id", moved.alias("label"), F.when(finite, whole).alias("embedding"))
    return mine(rows, F.col("vec_id") % 50 == 0)


@query("op12_jaccard_join", rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, s FROM (
      SELECT r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
      UNION ALL SELECT r, array_to_string(w, ' ') FROM d WHERE len(w) IN (1, 2))),
n AS (SELECT r, count(*)::BIGINT AS n FROM g GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach AS (SELECT r AS x, r AS y FROM n UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN (SELECT x, min(doc_id) AS least FROM reach JOIN d ON d.r = reach.y GROUP BY x) c ON c.x = d.r""")
def op12(spark, sf_dir):
    from textloom.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op13_fill_in_middle", """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
k AS (SELECT doc_id, t, length(t) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
             ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:] || '<M>' || t[a + 1:b]
                        ELSE '<S>' || t[b + 1:] || '<P>' || t[1:a] || '<M>' || t[a + 1:b] END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM c""")
def op13(spark, sf_dir):
    from textloom.llm.fim import fill_in_middle, restore_texts

    out = restore_texts(fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
