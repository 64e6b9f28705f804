"""N-gram Jaccard join by prefixes of adaptive length.

A document's set is its distinct word shingles, each a 64-bit number. All sets share one order: shingles in at
most ``rare`` documents' samples first, frequent ones last, by number within each. If two sets of x and y shingles
share at least ``o``, their first x - o + m and y - o + m shingles share at least m. So every document may take a
longer prefix and ask for more matches in return: each picks the m from 1 to ``most`` of least estimated cost (shingle
occurrences to be read, plus the candidates these allow at m matches, times the price of checking one). A pair must
share min(own lengths) matches, raised by what its two sizes ask for, before its sets are compared.

How it is dealt:

* Rows with one set are one class, found by a 128-bit digest; only classes are joined.
* Frequencies come from a sample of each set that its numbers choose (the smallest ones): the same shingles in every
  set, counted over all documents. A document whose sample lacks enough rare shingles is ordered by its whole set.
* Prefix shingles of at most ``hot`` classes give pairs by an equi-join, counted per pair.
* Classes that share a shingle of more than ``hot`` classes meet as whole sets: each has a home (its most frequent such
  shingle), is sent to the homes of the classes that it shares one with, and homes are cut into blocks of bounded size.
  In a block, pairs with too few matches or a link already known are passed over, and only links that join two
  groups come out: a group of n near copies gives n - 1 links, not n * n.

Edge rows: a null, empty or blank text has an empty set, which is linked with nothing, not even another one. A null id
takes part; a component's id is its smallest non-null id, null if it has none. Repeated rows are linked. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import broadcast_if, rows_of, stored, text_bytes
from textloom.llm.components import components

#: Longest extra prefix; a shingle in more samples than this is frequent; larger groups meet as whole sets.
MOST, RARE, HOT = 8, 20, 128
#: Shingles of a block of whole sets.
BLOCK = 1_000_000
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K[3]
    h = (h ^ (h >> np.uint64(27))) * _K[4]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Distinct shingles of a text as ascending 63-bit numbers."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(shingle, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mixed(out * _K[0] + h[i:len(h) - k + 1 + i] * _K[1] + _K[2])
    return np.unique(out >> np.uint64(1)).view(np.int64)


def shared_least(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it links to."""
    return -(-percent * n // 100)


def prefix_length(n: int, m: int, percent: int) -> int:
    return min(n, n - shared_least(n, percent) + m)


def sample_size(n: int, most: int, percent: int) -> int:
    return min(n, 3 * prefix_length(n, most, percent) // 2)


def choose_prefix(tokens: np.ndarray, known: np.ndarray, counts: np.ndarray, n: int, most: int, rare: int,
                  percent: int) -> tuple[int, np.ndarray] | None:
    """(m, prefix) of a set from its smallest shingles and the counts of some of them (``known``, any order).
    None if these have too few rare ones; of a whole set, the prefix always follows."""
    df = np.ones(len(tokens), np.int64)
    if len(known):
        df[np.searchsorted(tokens, known)] = counts
    frequent = df > rare
    longest = prefix_length(n, most, percent)
    order = np.flatnonzero(~frequent)
    if len(order) < longest:
        if len(tokens) < n:
            return None
        order = np.concatenate([order, np.flatnonzero(frequent)])
    order = order[:longest]
    reads = np.cumsum(df[order])  # occurrences read, its own ones among them
    size = [prefix_length(n, m, percent) for m in range(1, min(most, shared_least(n, percent)) + 1)]
    best = min(range(1, len(size) + 1), key=lambda m: (reads[size[m - 1] - 1] + 0.3 * n * (reads[size[m - 1] - 1] - size[m - 1]) / m, m))
    return best, tokens[order[:prefix_length(n, best, percent)]]


def _sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, most: int, percent: int) -> DataFrame:
    """(id, n, digest, place, sample) per row; ``place`` finds a text with that set again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, sample = [], [], []
            for (t,) in rows_of([b], "t"):
                s = shingle_set(t, shingle)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sample.append(s[:sample_size(len(s), most, percent)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sample, pa.list_(pa.int64()))],
                ["id", "place", "n", "digest", "sample"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), _place(text_col).alias("place"), text_bytes(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, place binary, n long, digest binary, sample array<long>")


def lists_of(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column of whole numbers, as slices of one array; null as empty."""
    values, at = column.flatten().to_numpy(), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())]
    return [values[at[k]:at[k + 1]] for k in range(len(column))]


def _place(text_col: str):
    return F.unhex(F.md5(text_bytes(text_col)))


def _whole_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    """(cls, n, tokens) of the wanted classes, made again from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shingle_set(t, shingle) for (t,) in rows_of([b], "t")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.list_(pa.int64()))], ["cls", "tokens"])

    places = stored(classes.join(wanted, "cls", "left_semi").select("cls", "place"), f"{name}-places")
    texts = docs.select(_place(text_col).alias("place"), text_bytes(text_col).alias("t"))
    found = texts.join(broadcast_if(places, 200_000), "place").select("cls", "t")
    sets = found.mapInArrow(run, "cls long, tokens array<long>")
    # a text may stand in many rows: one of each stays
    return stored(sets.groupBy("cls").agg(F.any_value("tokens").alias("tokens")), name)


def _choose(sets: DataFrame, most: int, rare: int, percent: int) -> DataFrame:
    """(cls, n, p, m, prefix); m is 0 and the prefix empty where the given shingles don't decide it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            lists = (lists_of(b.column(b.schema.get_field_index(c))) for c in ("tokens", "known", "dfs"))
            for (cls, n), tokens, known, dfs in zip(rows_of([b], "cls", "n"), *lists):
                got = choose_prefix(tokens, known, dfs, n, most, rare, percent)
                out.append((cls, n, 0, 0, []) if got is None else (cls, n, len(got[1]), got[0], got[1]))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _CHOSEN.types)], names=_CHOSEN.names)

    named = sets.select("cls", "n", "tokens", F.col("known.token").alias("known"), F.col("known.df").alias("dfs"))
    return named.mapInArrow(run, "cls long, n long, p long, m long, prefix array<long>")


_CHOSEN = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("p", pa.int64()), ("m", pa.int64()), ("prefix", pa.list_(pa.int64()))])


def _known(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """Per class its shingles with their counts, those counted once left out."""
    return tokens.join(counts, "token").groupBy("cls").agg(F.collect_list(F.struct("token", "df")).alias("known"))


def link_classes(tables: list[tuple], percent: int, inner: bool) -> list[tuple[int, int]]:
    """Links that join the classes of two blocks (one, if ``inner``): each (cls, n, p, tokens with the prefix in front)."""
    cls, n, p, tokens, side = zip(*tables)
    n, p, side = np.array(n), np.array(p), np.array(side)
    flat, sizes = np.concatenate(tokens), np.array([len(t) for t in tokens])
    words, flat = np.unique(flat, return_inverse=True)
    at = np.r_[0, np.cumsum(sizes)]
    heads = np.concatenate([flat[at[k]:at[k] + p[k]] for k in range(len(n))])
    head_at = np.r_[0, np.cumsum(p)]
    group = np.arange(len(n))
    mark = np.zeros(len(words), bool)
    links = []
    for q in range(len(n)):
        if not inner and side[q]:
            continue
        mine = flat[at[q]:at[q + 1]]
        mark[mine[:p[q]]] = True
        hits = np.add.reduceat(mark[heads], head_at[:-1], dtype=np.int64)
        mark[mine[:p[q]]] = False
        both = n[q] + n
        need = -(-percent * both // (100 + percent))  # shingles that a link of these sizes shares
        ok = (hits >= need + np.minimum(p[q] - n[q], p - n)) & (100 * np.minimum(n[q], n) >= percent * np.maximum(n[q], n))
        ok &= (np.arange(len(n)) > q) if inner else side == 1
        mark[mine] = True
        for y in np.flatnonzero(ok):
            if group[y] != group[q]:
                shared = int(mark[flat[at[y]:at[y + 1]]].sum())
                if 100 * shared >= percent * (both[y] - shared):
                    links.append((cls[q], cls[y]))
                    group[group == group[y]] = group[q]
        mark[mine] = False
    return links


def _normal_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b) with as many shared prefix shingles as their lengths and sizes ask for."""
    x = postings.select("token", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"))
    y = postings.select("token", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"))
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = x.join(y, (x.token == y.token) & (F.col("a") < F.col("b")) & alike)
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / F.lit(100 + percent))
    return (pairs.groupBy("a", "b", "na", "nb", "pa", "pb").agg(F.count(F.lit(1)).alias("hits"))
            .where(F.col("hits") >= need + F.least(F.col("pa") - F.col("na"), F.col("pb") - F.col("nb"))).select("a", "b"))


def _visits(hot: DataFrame, block: int) -> DataFrame:
    """(cls, home, i, j, side): the pairs of blocks in which a class's whole set is needed."""
    spot = F.struct("size", "token")
    home = hot.groupBy("cls", "n").agg(F.max(spot).alias("home"))
    at = stored(hot.join(home.select("cls", "home"), "cls"), "jaccard-homes")
    homes = at.groupBy("token").agg(F.collect_set("home").alias("homes"))
    seen = at.join(homes, "token").groupBy("cls", "n", "home").agg(F.array_distinct(F.flatten(F.collect_list("homes"))).alias("homes"))
    # a pair meets at the later of its two homes
    sent = seen.select("cls", "n", "home", F.explode("homes").alias("to")).where(F.col("to") >= F.col("home"))
    sent = stored(sent.select("cls", "n", "to"), "jaccard-sent")
    blocks = sent.groupBy("to").agg(F.greatest(F.lit(1), F.expr(f"cast(ceil(sum(n) / {block}) as int)")).alias("g"))
    own = F.pmod(F.xxhash64("cls"), F.col("g")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1))
    dealt = sent.join(blocks, "to").select("cls", "to", own.alias("own"), other.alias("other"))
    return dealt.select("cls", F.col("to.token").alias("home"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        (F.col("own") > F.col("other")).cast("int").alias("side"))


def _hot_links(hot: DataFrame, sets: DataFrame, chosen: DataFrame, percent: int, block: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        rows = []
        for b in t.to_batches():
            lists = (lists_of(b.column(b.schema.get_field_index(c))) for c in ("tokens", "prefix"))
            for (cls, n, p, side), tokens, prefix in zip(rows_of([b], "cls", "n", "p", "side"), *lists):
                rest = np.setdiff1d(tokens, prefix, assume_unique=True)
                rows.append((cls, n, p, np.concatenate([prefix, rest]), side))
        inner = t.column("i")[0].as_py() == t.column("j")[0].as_py()
        links = link_classes(sorted(rows, key=lambda r: (r[1], r[0])), percent, inner) if rows else []
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    visits = _visits(hot, block)
    whole = sets.join(chosen, "cls")
    return visits.join(whole, "cls").groupBy("home", "i", "j").applyInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90,
                       most: int = MOST, rare: int = RARE, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id. Sets link when 100 * intersection >= ``percent`` * union."""
    rows = stored(_sets(docs, id_col, text_col, shingle, most, percent), "jaccard-rows")
    classes = stored(rows.where("n > 0").groupBy("digest").agg(
        F.min("id").alias("least"), F.any_value("n").alias("n"), F.any_value("place").alias("place"),
        F.any_value("sample").alias("sample")).withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")

    # counts over the samples, and the prefixes that these decide
    tokens = classes.select("cls", F.explode("sample").alias("token"))
    counts = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "jaccard-counts")
    sampled = classes.join(_known(tokens, counts), "cls", "left").withColumn("tokens", F.col("sample"))
    first = stored(_choose(sampled, most, rare, percent), "jaccard-prefixes")
    open_ = first.where("m = 0").select("cls")
    whole = _whole_sets(docs, classes, open_, text_col, shingle, "jaccard-open")
    known = _known(whole.select("cls", F.explode("tokens").alias("token")), counts)
    second = whole.join(classes.select("cls", "n"), "cls").join(known, "cls", "left")
    chosen = stored(first.where("m > 0").unionByName(_choose(second, most, rare, percent)), "jaccard-chosen")

    postings = chosen.select("cls", "n", "p", F.explode("prefix").alias("token"))
    sizes = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    postings = stored(postings.join(sizes, "token"), "jaccard-postings")
    pairs = stored(_normal_pairs(postings.where(F.col("size") <= hot), percent), "jaccard-pairs")
    large = postings.where(F.col("size") > hot)

    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(large.select("cls")).distinct()
    sets = _whole_sets(docs, classes, wanted, text_col, shingle, "jaccard-sets")
    at = lambda k: sets.select(F.col("cls").alias(k), F.col("tokens").alias(f"t{k}"))
    shared = F.size(F.array_intersect("ta", "tb"))
    near = pairs.join(at("a"), "a").join(at("b"), "b").where(100 * shared >= percent * (F.size("ta") + F.size("tb") - shared)).select("a", "b")
    together = _hot_links(large, sets, chosen.select("cls", "n", "p", "prefix"), percent, block)
    roots = components(near.union(together))

    named = classes.join(roots, classes.cls == roots.node, "left").select("digest", "least", F.coalesce("root", "cls").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(named.join(ids, "root").select("digest", "component_id"), "jaccard-named")
    full = rows.where("n > 0").join(named, "digest").select("id", "n", "component_id")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).toDF(id_col, "n_shingles", "component_id")
