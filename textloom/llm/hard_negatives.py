"""Hard-negative mining with segment summaries.

Vectors are cut into segments; of each its mean and deviation are kept. With segments of m components, means a, b
and deviations s, t, a segment's inner product lies within m*a*b - m*s*t and m*a*b + m*s*t, so the sums over
segments bound a score from below and above. Summaries of 1, 4 and 16 segments are tried in turn; only pairs that
no bound rules out get their exact integer score.

Anchors are a stated query set against all rows, in blocks: rows and anchors are dealt by a hash of their row
number into blocks of bounded size, and each pair of blocks meets in one group of a shuffle. A group gives at
most ``n`` rows for each anchor (and positive), which ranks over all groups then cut to the first ``n``.

Edge rows: rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of
different lengths have no score. A null id takes part and comes last among equal scores; rows with one id are
different rows. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import stored

#: Segments at each level.
LEVELS = (1, 4, 16)
#: Rows and anchors of a block, and rows bounded at a time.
ROWS, ANCHORS, STEP = 16_384, 1_024, 2_048
LAST = np.iinfo(np.int64).max


def usable(vector: Column, label: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & label.isNotNull() & good


class Summaries:
    """Means and deviations of the segments of some vectors at each level, scaled so that plain products add up."""

    def __init__(self, x: np.ndarray):
        self.x, self.levels = x, []
        for k in LEVELS:
            if k <= max(1, x.shape[1]):
                parts = np.array_split(x, k, axis=1)
                root = np.sqrt([p.shape[1] for p in parts])
                if x.shape[1]:
                    mean = np.stack([p.mean(axis=1) for p in parts], axis=1) * root
                    dev = np.stack([p.std(axis=1) for p in parts], axis=1) * root
                else:
                    mean = dev = np.zeros((len(x), k))
                self.levels.append((mean, dev))
        self.norm = np.sqrt((x * x).sum(axis=1))


def exact_scores(a: Summaries, b: Summaries, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs (i, j)."""
    x, y = a.x, b.x
    most = max(1, x.shape[1]) * np.abs(x).max(initial=0) * np.abs(y).max(initial=0)
    if most >= 2 ** 53:  # beyond exact doubles
        return np.array([sum(int(p) * int(q) for p, q in zip(x[u], y[v])) for u, v in zip(i, j)], np.int64)
    if 8 * len(i) > len(x) * len(y):
        return (x @ y.T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), STEP * 16):
        s = slice(at, at + STEP * 16)
        out[s] = np.einsum("kd,kd->k", x[i[s]], y[j[s]]).astype(np.int64)
    return out


def survivors(a: Summaries, b: Summaries, allowed: np.ndarray, low: np.ndarray, high: np.ndarray,
              count: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose bounds meet one of their anchor's intervals [low, high] (anchors x intervals), level by level."""
    i, j = np.nonzero(allowed)
    for (ma, da), (mb, db) in zip(a.levels, b.levels):
        if not len(i):
            break
        dense = 8 * len(i) > allowed.size
        if dense:
            mid, rad = (ma @ mb.T)[i, j], (da @ db.T)[i, j]
        else:
            mid, rad = np.einsum("ks,ks->k", ma[i], mb[j]), np.einsum("ks,ks->k", da[i], db[j])
        rad = rad + 1e-9 * a.norm[i] * b.norm[j] + 1e-6
        keep = np.zeros(len(i), bool)
        for k in range(low.shape[1]):
            keep |= (mid + rad >= low[i, k]) & (mid - rad <= high[i, k])
        i, j = i[keep], j[keep]
        if count is not None:
            count.append(len(i))
    return i, j


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of each group: highest score, then smallest id, then row."""
    order = np.lexsort((rows, ids, -score, group))
    g = group[order]
    start = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0)) if len(g) else g
    return order[rank < n]


def _matrix(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and the values, one after the other, of a list column."""
    c = t.column(name).combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return np.diff(c.offsets.to_numpy()), c.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _column(t: pa.Table, name: str, missing: int = LAST) -> np.ndarray:
    return t.column(name).fill_null(missing).to_numpy().astype(np.int64)


def search(rows: pa.Table, anchors: pa.Table, n: int, other_label: bool) -> pa.Table:
    """First ``n`` rows of one block for each anchor, or for each of its intervals (``low``, ``high``)."""
    found = []
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "slot", "score", "id", "row")])
    if not rows.num_rows or not anchors.num_rows:
        return schema.empty_table()
    rlen, rval = _matrix(rows, "v")
    alen, aval = _matrix(anchors, "v")
    rat, aat = np.r_[0, np.cumsum(rlen)], np.r_[0, np.cumsum(alen)]
    rrow, rid, rlabel = (_column(rows, c) for c in ("row", "id", "label"))
    arow, alabel = _column(anchors, "row"), _column(anchors, "label")
    spans = [np.array(anchors.column(c).to_pylist(), dtype=object) if other_label else None for c in ("low", "high")]
    for d in np.intersect1d(rlen, alen):
        ai, ri = np.flatnonzero(alen == d), np.flatnonzero(rlen == d)
        take = lambda val, at, i: val[(at[i][:, None] + np.arange(d)[None, :])]
        a = Summaries(take(aval, aat, ai))
        if other_label:
            wide = max(len(spans[0][u]) for u in ai)
            low, high = np.full((len(ai), wide), np.inf), np.full((len(ai), wide), -np.inf)
            for p, u in enumerate(ai):
                low[p, :len(spans[0][u])], high[p, :len(spans[0][u])] = spans[0][u], spans[1][u]
        else:
            low, high = np.full((len(ai), 1), -np.inf), np.full((len(ai), 1), np.inf)
        wide = low.shape[1]
        least, best = low.copy(), None
        for at in range(0, len(ri), STEP):
            own = ri[at:at + STEP]
            b = Summaries(take(rval, rat, own))
            same = alabel[ai][:, None] == rlabel[own][None, :]
            allowed = ~same if other_label else same & (arow[ai][:, None] != rrow[own][None, :])
            i, j = survivors(a, b, allowed, least, high)
            if not len(i):
                continue
            s = exact_scores(a, b, i, j)
            for k in range(wide):
                fits = (s >= least[i, k]) & (s <= high[i, k])
                new = np.stack([i[fits] * wide + k, s[fits], rid[own][j[fits]], rrow[own][j[fits]]])
                best = new if best is None else np.concatenate([best, new], axis=1)
            best = best[:, first_of(*best, n)]
            groups, first, size = np.unique(best[0], return_index=True, return_counts=True)
            full, last = groups[size == n], first[size == n] + n - 1  # in order: the n-th score is the least that counts now
            least[full // wide, full % wide] = best[1, last]
        if best is not None and best.shape[1]:
            found.append(pa.table({"anchor": arow[ai][best[0] // wide], "slot": best[0] % wide, "score": best[1],
                                   "id": pa.array(best[2], mask=best[2] == LAST), "row": best[3]}))
    return pa.concat_tables([t.cast(schema) for t in found]) if found else schema.empty_table()


def _meet(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, n: int, other_label: bool) -> DataFrame:
    """Every block of rows with every block of anchors."""
    rb, ab = -(-n_rows // ROWS) or 1, -(-n_anchors // ANCHORS) or 1
    block = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    left = rows.select(F.explode(F.sequence(F.lit(0), F.lit(ab - 1))).alias("ab"), block("row", rb).alias("rb"),
                       *(F.col(c).alias(c) for c in rows.columns))
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(rb - 1))).alias("rb"), block("row", ab).alias("ab"),
                           *(F.col(c).alias(c) for c in anchors.columns))  # columns of its own: both come from one table

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        return search(x, y, n, other_label)

    return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInArrow(
        run, "anchor long, slot long, score long, id long, row long")


def _ranked(found: DataFrame, n: int, *group: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds whole numbers; ``anchor`` is a condition on ``vectors``. An anchor's positives are its first
    ``positives`` other rows of its label. For each, the first ``negatives`` rows of other labels whose score is at
    least ``low`` and at most ``high`` hundredths of the positive's score."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.where(usable(vector, F.col(label_col))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"), vector.alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    rows = stored(rows, "mine-rows")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    anchors, rows = rows.where("is_anchor").drop("is_anchor"), rows.drop("is_anchor")

    near = _ranked(_meet(rows, anchors, n_rows, n_anchors, positives, False), positives, "anchor")
    near = stored(near.select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "mine-positives")
    # whole numbers between low/100 and high/100 of the score; empty where it is negative
    ps = F.col("positive_score")
    span = F.struct("rank", F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
                    F.expr(f"({high} * positive_score) div 100").alias("high"))
    spans = near.where(ps >= 0).groupBy("anchor").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    wanted = anchors.join(spans, anchors.row == spans.anchor).select(
        "row", "id", "label", "v", F.col("spans.low").alias("low"), F.col("spans.high").alias("high"))
    far = _ranked(_meet(rows, wanted, n_rows, n_anchors, negatives, True), negatives, "anchor", "slot")

    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    far = far.select("anchor", F.col("slot") + 1, F.col("rank"), F.col("id"), F.col("score")).toDF(
        "anchor", "slot", "rank", "negative_id", "negative_score")
    of = near.withColumnRenamed("rank", "slot")
    return far.join(of, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
