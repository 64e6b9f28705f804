"""Mixing overlapping sources to target weights by minimum-cost flow.

Documents are aggregated by membership pattern (the set of sources they are in). A flow routes words from
patterns to source quotas; reading a pattern a second and third time costs more than the first, so repetition
is convex in cost and spread evenly. The amounts then become documents: all of a pattern's documents as often
as the amount covers them whole, and for the rest the first ones in a seeded order up to the one that would go
beyond it, found by narrowing the range of a hash step by step (counts per bucket, then the bucket that holds the
limit), never by sorting a source in one task. What is then missing is filled by later documents that still fit,
in the same way, until none fits: a source misses its target by less than its smallest document left.

The driver holds one row per pattern and per source, which must be fewer than ``MAX_PATTERNS``: a mixture is
stated by weights per source, so their number does not grow with the documents. Sources that share no pattern, even
through others, are flows of their own; one with more than ``MAX_JOINED`` patterns is an error.

Edge rows: a null text has size 0 and is taken with any amount of its pattern at no words; a null source is a
source of its own, last in order. Rows that repeat an id and text have a copy number in the seeded order. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import WORD, named_again, renamed, stored

MAX_PATTERNS = 100_000
#: Patterns of one flow: shortest paths over more would take hours on the driver.
MAX_JOINED = 2_000
MAX_REPEATS = 3
#: Bits of the seeded hash, and bits narrowed in a step.
HASH_BITS, STEP_BITS = 60, 12


def targets(sizes: dict, weights: tuple[int, ...], total: int, max_repeats: int = MAX_REPEATS) -> dict:
    """Words wanted of each source: shares of ``total`` by weight, none above ``max_repeats`` times its size;
    what a capped source leaves is shared again by weight among the others. Weights repeat over the sources in
    code-point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    free, out, left = list(order), {}, float(total)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > max_repeats * sizes[s]]
        if not full:
            return {s: out.get(s, unit * weight[s]) for s in order}
        for s in full:
            out[s] = float(max_repeats * sizes[s])
            left -= out[s]
            free.remove(s)
    return {s: out[s] for s in order}


def route(sizes: dict[str, int], members: dict[str, tuple], quota: dict, max_repeats: int = MAX_REPEATS,
          steps: list | None = None) -> dict[str, int]:
    """Words to take of each pattern: a maximum flow to the quotas with the least repetition cost, for each set of
    sources that patterns connect. ``steps`` gets the number of paths that each flow took."""
    users = defaultdict(list)
    for p, sources in members.items():
        for s in sources:
            users[s].append(p)
    out, seen = {p: 0 for p in sizes}, set()
    for p in sorted(p for p in members if members[p]):
        if p in seen:
            continue
        seen.add(p)
        joined = [p]
        for q in joined:  # grows while it is read
            new = sorted({x for s in members[q] for x in users[s]} - seen)
            seen.update(new)
            joined += new
        if len(joined) > MAX_JOINED:
            raise ValueError(f"more than {MAX_JOINED} membership patterns share sources: state the mixture over fewer")
        out.update(_flow({q: sizes[q] for q in joined}, members, quota, max_repeats, steps))
    return out


def _flow(sizes: dict[str, int], members: dict[str, tuple], quota: dict, max_repeats: int, steps: list | None) -> dict[str, int]:
    """Successive shortest paths with potentials; reading a pattern for the r-th time costs r - 1 a word."""
    shared, paths = list(sizes), 0
    graph: list[list[list]] = [[], []]  # edges: to, room, cost, place of the reverse edge
    place: dict = {}

    def node(key):
        if key not in place:
            place[key] = len(graph)
            graph.append([])
        return place[key]

    def edge(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p in sorted(shared):
        for r in range(max_repeats):
            edge(0, node(("p", p)), sizes[p], r)
        for s in members[p]:
            edge(node(("p", p)), node(("s", s)), max_repeats * sizes[p], 0)
    for s in sorted({s for p in shared for s in members[p]}, key=lambda s: (s is None, s or "")):
        edge(node(("s", s)), 1, round(quota[s]), 0)
    potential = [0] * len(graph)
    while True:
        distance, via, heap = [None] * len(graph), [None] * len(graph), [(0, 0)]
        distance[0] = 0
        while heap:
            d, a = heapq.heappop(heap)
            if d > distance[a]:
                continue
            for i, (b, room, cost, _) in enumerate(graph[a]):
                far = d + cost + potential[a] - potential[b]
                if room and (distance[b] is None or far < distance[b]):
                    distance[b], via[b] = far, (a, i)
                    heapq.heappush(heap, (far, b))
        if distance[1] is None:
            break
        paths += 1
        potential = [v + (d if d is not None else distance[1]) for v, d in zip(potential, distance)]
        path, at = [], 1
        while at:
            path.append(via[at])
            at = via[at][0]
        flow = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= flow
            graph[graph[a][i][0]][graph[a][i][3]][1] += flow
    if steps is not None:
        steps.append(paths)
    out = {}
    for p in shared:
        own = {place["s", s] for s in members[p]}
        out[p] = sum(max_repeats * sizes[p] - room for to, room, _, _ in graph[place["p", p]] if to in own)
    return out


def _cuts(rows: DataFrame, wanted: dict[str, tuple[int, int, int]]) -> dict[str, tuple[int, int]]:
    """pattern -> (limit, words): of its rows from a hash on and up to a size, those below the limit are the first
    ones that hold no more than the words wanted. ``wanted``: pattern -> (words, first hash, largest size)."""
    spark = rows.sparkSession
    state = {p: (0, need, low, most) for p, (need, low, most) in wanted.items()}  # pattern -> prefix, words still wanted
    out = {}
    for done in range(0, HASH_BITS, STEP_BITS):
        if not state:
            break
        shift = HASH_BITS - done - STEP_BITS
        want = spark.createDataFrame([(p, *v) for p, v in state.items()], "pattern string, prefix long, need long, low long, most long")
        own = rows.join(F.broadcast(want), "pattern").where(
            (F.shiftright("h", shift + STEP_BITS) == F.col("prefix")) & (F.col("h") >= F.col("low")) & (F.col("size") <= F.col("most")))
        sums = (own.groupBy("pattern", "need", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
        upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket"))
        over = F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "n")
        found = (sums.withColumn("upto", upto).groupBy("pattern")
                 .agg(F.max("upto").alias("all"), F.min(F.when(F.col("upto") > F.col("need"), over)).alias("over")).collect())
        found = {r["pattern"]: r for r in found}  # one row per pattern
        last, state = state, {}
        for p, (prefix, need, low, most) in last.items():
            r = found.get(p)
            if r is None or r["over"] is None:  # all words of the range fit
                need -= r["all"] if r else 0
                out[p] = ((prefix + 1) << (shift + STEP_BITS) if done else 1 << HASH_BITS, wanted[p][0] - need)
            elif r["over"]["n"] == 1 or shift == 0:
                out[p] = (r["over"]["bucket"] << shift, wanted[p][0] - need + r["over"]["before"])
            else:
                state[p] = (r["over"]["bucket"], need - r["over"]["before"], low, most)
    return out


def _bands(rows: DataFrame, rest: dict[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """pattern -> (first hash, limit, largest size) of rows read once more, that hold ``rest`` words or as many as fit."""
    out = {p: [] for p in rest}
    open_ = {p: (need, 0, 1 << HASH_BITS) for p, need in rest.items() if need > 0}
    while open_:
        cut = _cuts(rows, open_)
        left = []
        for p, (need, low, most) in open_.items():
            limit, words = cut[p]
            out[p].append((low, limit, most))
            if need > words:
                left.append((p, need - words, max(low, limit)))
        if not left:
            break
        state = rows.sparkSession.createDataFrame(left, "pattern string, need long, low long")
        fits = rows.join(F.broadcast(state), "pattern").where("h >= low AND size > 0 AND size <= need")
        go = {r["pattern"] for r in fits.select("pattern").distinct().collect()}
        open_ = {p: (need, low, need) for p, need, low in left if p in go}
    return out


def mix(docs: DataFrame, members: Column, size: Column, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
        max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, dict, dict, dict]:
    """(rows, sources by pattern, source sizes, targets). Rows: ``id_col``, ``size``, ``pattern`` (JSON list of sources), ``h``,
    ``repeats`` and ``taken`` words, for each input row."""
    rows, plan, lists, sources, quota = _plan(docs, members, size, weights, share, seed, id_col, text_col, max_repeats)
    out = rows.join(F.broadcast(plan), "pattern").withColumn("repeats", _repeats())
    return (out.select(F.col("id").alias(id_col), "size", "pattern", "h", "repeats", (F.col("size") * F.col("repeats")).alias("taken")),
            lists, sources, quota)


def _pattern(members: Column) -> Column:
    return F.to_json(F.sort_array(F.array_distinct(members)), {"ignoreNullFields": "false"})


def _place(row_hash: Column, copy: Column) -> Column:
    return F.xxhash64(row_hash, copy).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _repeats() -> Column:
    more = F.exists("bands", lambda b: (F.col("h") >= b["low"]) & (F.col("h") < b["limit"]) & (F.col("size") <= b["most"]))
    return F.col("whole") + more.cast("long")


def _plan(docs, members, size, weights, share, seed, id_col, text_col, max_repeats):
    """Rows (id, size, pattern, h) and the plan: how often each pattern is read whole, and which of its rows once more."""
    key = _pattern(members)
    base = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), key)
    rows = docs.select(F.col(id_col).alias("id"), size.cast("long").alias("size"), key.alias("pattern"), base.alias("b"))
    copy = F.row_number().over(Window.partitionBy("b").orderBy("b"))
    rows = stored(rows.withColumn("h", _place(F.col("b"), copy)).drop("b"), "mix-rows")

    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: state the mixture over fewer sources")
    sizes = {r["pattern"]: r["size"] for r in found}
    lists = {p: tuple(json.loads(p)) for p in sizes}
    sources: dict = defaultdict(int)
    for p, own in lists.items():
        for s in own:
            sources[s] += sizes[p]
    quota = targets(sources, weights, share * sum(sizes.values()), max_repeats)
    amount = route(sizes, lists, quota, max_repeats)

    whole = {p: amount[p] // sizes[p] if sizes[p] else 0 for p in sizes}
    bands = _bands(rows, {p: amount[p] - whole[p] * sizes[p] for p in sizes})
    plan = docs.sparkSession.createDataFrame([(p, whole[p], bands[p]) for p in sizes],
                                             "pattern string, whole long, bands array<struct<low:long,limit:long,most:long>>")
    return rows, plan, lists, dict(sources), quota


def mixed_rows(docs: DataFrame, members: Column, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, seed: int = 0,
               id_col: str = "doc_id", text_col: str = "text", max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The input rows, each as often as the mixture reads it, with all their columns. The plan is applied where the
    rows are, without a shuffle; rows that are repeated whole are read equally often."""
    _, plan, *_ = _plan(docs, members, word_count(text_col), weights, share, seed, id_col, text_col, max_repeats)
    base = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), _pattern(members))
    rows = renamed(docs, pattern=_pattern(members), h=_place(base, F.lit(1)), size=word_count(text_col).cast("long"))
    rows = rows.join(F.broadcast(plan), "pattern")
    rows = rows.withColumn("time", F.explode(F.array_repeat(F.lit(0), _repeats().cast("int"))))
    return named_again(rows, docs)


def word_count(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))


def mix_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id_col``, ``size``, its ``source_size`` and ``target``, the words ``taken``."""
    rows, sources, sizes, quota = mix(docs, F.array(source_col), word_count(text_col), id_col=id_col, text_col=text_col, **options)
    per = docs.sparkSession.createDataFrame([(p, sizes[s], quota[s]) for p, (s,) in sources.items()],
                                            "pattern string, source_size long, target double")
    return rows.join(F.broadcast(per), "pattern").select(id_col, "size", "source_size", "target", "taken", "repeats")
