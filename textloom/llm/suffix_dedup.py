"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

A byte goes when a string of ``length`` bytes that covers it also starts earlier (in a document with a smaller
id, or earlier in the same one). Matches never cross documents.

Candidates. Every window of ``length`` bytes is represented by its minimizer, the gram of ``GRAM`` bytes with the
smallest hash inside it: equal windows have the same one at the same place. Occurrences of minimizers are dealt
into ranges of the gram's hash and that of the surroundings, so a gram with very many surroundings is split over
tasks; a gram at the edge of a range, whose other occurrences may be elsewhere, is checked in full. An occurrence whose whole surroundings (all bytes that any window with this gram can cover)
equal an earlier occurrence's is repeated with all its windows; tasks settle such copies among their own rows
first, so a passage that is in a third of all documents is a few rows per task. Of the others, those that share
at least half a window's surroundings with another one are cut out as segments and dealt by that half.

Suffix arrays. Segments that meet are concatenated and their suffixes sorted in two stages: those smaller than
their successors are sorted directly (to ``length`` bytes and more), all others are induced by scanning the
buckets of first bytes from the smallest up. Neighbours in the order with a common prefix of ``length`` bytes or
more are equal windows; all but the earliest are repeated. Halves shared by more than ``hot`` segments, counted
before any is cut out, are never dealt to one task: their windows are grouped by their bytes with Spark aggregates.

Edge rows: a null text is empty. A null id counts as larger than all others (below 2^63 - 2^31, where null ids lie, told
apart by 31 bits of one hash of their text and 64 of another); rows that share an id are ordered by a 64-bit hash of the
text; of whole repeated rows, compared by length and SHA-256, the first is judged and the others, if long enough, go entirely. Texts
shorter than ``length`` stay. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import broadcast_if, rows_of, stored, text_bytes

GRAM = 24
#: Bytes hashed at a time, minimizer rows settled locally at a time, bytes of a suffix array.
STEP, LOCAL_ROWS, ARRAY_BYTES = 1 << 19, 500_000, 1 << 20
HOT = 20_000
#: Documents for a range from which its end is taken, and distinct grams with their surroundings.
SAMPLE_DOCS, SAMPLE_ROWS = 16, 1_000
#: Documents whose candidate places or removed ranges are broadcast; beyond it the join shuffles.
BROADCAST_DOCS = 250_000
LAST = (1 << 63) - 1

BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, b, _U)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours."""
    n = len(x)
    p = np.full(-(-n // w) * w, np.iinfo(_U).max, _U)
    p[:n] = x
    p = p.reshape(-1, w)
    ahead = np.minimum.accumulate(p, axis=1).ravel()
    behind = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def minimizers(x: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts lying one after another: places of minimizers, the gram's hash, that of its surroundings, and of
    the half windows left and right of it (16 bits each; 0: the text is too short there)."""
    n, wide, half = len(x), length - GRAM + 1, (length - GRAM) // 2
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none.astype(_U), none.astype(_U), none.astype(_U), none.astype(_U)
    power, inverse = _tables(n + 1)
    prefix = np.zeros(n + 1, _U)
    np.cumsum((x.astype(_U) + _U(1)) * power[:n], out=prefix[1:])
    part = lambda lo, hi: _mix((prefix[hi] - prefix[lo]) * inverse[lo])  # noqa: E731  hash of x[lo:hi]
    start = np.arange(n - GRAM + 1)
    h = part(start, start + GRAM)
    least = _sliding_min(h, wide)
    text = np.searchsorted(ends, np.arange(n), side="right")
    end = ends[text]
    begin = np.r_[0, ends[:-1]][text]
    whole = np.arange(len(least)) + length <= end[:len(least)]
    least = np.where(whole, least, _U(0))
    padded = np.zeros(len(h) + wide - 1, _U)
    padded[wide - 1:wide - 1 + len(least)] = least
    at = np.flatnonzero((~_sliding_min(~padded, wide) == h) & (h > 0))  # it is the minimum of some whole window
    lo, hi = np.maximum(begin[at], at - wide + 1), np.minimum(end[at], at + length)
    around = part(lo, hi) ^ _mix((at - lo).astype(_U) * _U(1 << 20) + (hi - at).astype(_U) + _U(1))
    left = np.where(at - lo >= half, part(np.maximum(at - half, 0), at) & _U(0xFFFF) | _U(1), _U(0))
    right = np.where(hi - at >= GRAM + half, part(at + GRAM, np.minimum(at + GRAM + half, n)) & _U(0xFFFF) | _U(1), _U(0))
    return at, h[at], around, left, right


def _first_of(groups: np.ndarray, doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row order by (group, doc, tie, pos), and for each row of that order the place of its group's first."""
    order = np.lexsort((pos, tie, doc, groups))
    g = groups[order]
    new = np.r_[True, g[1:] != g[:-1]]
    return order, np.flatnonzero(new)[np.cumsum(new) - 1]


def _range_of(key: np.ndarray, around: np.ndarray, keys: np.ndarray, arounds: np.ndarray) -> np.ndarray:
    """Number of the range of (key, around) in which each row lies; ``keys`` and ``arounds``: the ranges' last, in order."""
    first, end = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    out = first.copy()
    for i in np.unique(first[end > first]):  # a gram at which ranges end
        rows = np.flatnonzero((first == i) & (end > first))
        out[rows] += np.searchsorted(arounds[i:end[rows[0]]], around[rows], "left")
    return out


def _inside_ranges(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A key for each hash, spread evenly over the ranges that end at ``keys`` and within them."""
    ends = np.r_[np.int64(-LAST), keys, np.int64(LAST)].view(_U)
    j = (h % _U(len(ends) - 1)).astype(np.int64)
    room = ends[j + 1] - ends[j]
    return np.where(room > 1, ends[j] + _U(1) + _mix(h) % np.maximum(room - _U(1), _U(1)), h).view(np.int64)


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """Minimizer occurrences (kind 0), and those that a task finds repeated among its own rows (kind 1), with the range
    (part) of key and surroundings in which they lie. Where ranges end is taken from some documents, so that texts are
    scanned once; any ends give the same verdicts."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLE_DOCS * parts / max(1, docs.count()))
    some = _scanned(docs.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(1 << 20)) < share * (1 << 20)), length, *[np.zeros(0, np.int64)] * 2)
    some = some.where("kind = 0").select("key", "around").distinct().orderBy(F.xxhash64("key", "around")).limit(min(SAMPLE_ROWS * parts, 1_000_000)).toArrow()
    key, around = (some.column(i).to_numpy() for i in (0, 1))
    order = np.lexsort((around, key))
    last = order[np.arange(1, min(parts, len(order))) * len(order) // min(parts, max(1, len(order)))]
    return _scanned(docs, length, key[last], around[last])


def _scanned(docs: DataFrame, length: int, keys: np.ndarray, arounds: np.ndarray) -> DataFrame:
    """Occurrences with their ranges, whose last keys and surroundings these are."""
    margin = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, ends, info, size = [], [], [], 0
        done: list[tuple[np.ndarray, ...]] = []
        count = 0

        def scan() -> int:
            nonlocal buffer, ends, info, size
            x = np.frombuffer(b"".join(buffer), np.uint8)
            stops = np.array(ends)
            at, h, around, left, right = minimizers(x, stops, length)
            k = np.searchsorted(stops, at, side="right")
            doc, tie, offset, core_lo, core_hi, begin = (np.array(c, np.int64)[k] for c in zip(*info))
            pos = at - begin + offset
            own = (pos >= core_lo) & (pos < core_hi)
            lr = (left << _U(16) | right).astype(_U)
            done.append((h.view(np.int64)[own], around.view(np.int64)[own], doc[own], tie[own], pos[own], lr.view(np.int64)[own]))
            buffer, ends, info, size = [], [], [], 0
            return int(own.sum())

        def settle() -> pa.RecordBatch:
            mh, around, doc, tie, pos, lr = (np.concatenate(c) for c in zip(*done))
            done.clear()
            same = _mix(mh.view(_U) ^ _mix(around.view(_U)))
            _, inverse, n = np.unique(same, return_inverse=True, return_counts=True)
            many = np.flatnonzero(n[inverse] > 1)
            kind = np.zeros(len(mh), np.int32)
            if len(many):
                order, first = _first_of(inverse[many], doc[many], tie[many], pos[many])
                later = many[order[first != np.arange(len(first))]]
                ahead = many[order[first[first != np.arange(len(first))]]]
                equal = (doc[later] == doc[ahead]) & (tie[later] == tie[ahead]) & (pos[later] == pos[ahead])
                kind[later] = np.where(equal, 2, 1)  # 2: a repeated row, the same place
            mh = np.where(kind == 1, _inside_ranges(_mix((doc + 31 * pos).view(_U)), keys), mh)
            keep = kind < 2
            cols = [mh, around, doc, tie, pos, lr, kind, _range_of(mh, around, keys, arounds).astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], ["key", "around", "doc", "tie", "pos", "lr", "kind", "part"])

        for doc, tie, text in rows_of(batches, "doc", "tie", "text"):
            for at in range(0, max(1, len(text)), STEP):
                if len(text) < length:
                    break
                lo, hi = max(0, at - margin), min(len(text), at + STEP + margin)
                buffer.append(text[lo:hi])
                info.append((doc, tie, lo, at, at + STEP, size))
                size += hi - lo
                ends.append(size)
                if size >= STEP:
                    count += scan()
                    if count >= LOCAL_ROWS:
                        yield settle()
                        count = 0
        if buffer:
            scan()
        if done:
            yield settle()

    return docs.mapInArrow(run, "key long, around long, doc long, tie long, pos long, lr long, kind int, part int")


def _verdicts(occurrences: DataFrame) -> DataFrame:
    """kind 1: repeated with all windows. kind 2, 4 or 6: the left half (2), the right (4) or both are shared.

    The first and last gram of a range may go on in another one, so all their occurrences count as shared."""
    names = ["key", "around", "doc", "tie", "pos", "lr", "kind"]

    def judge(key, around, doc, tie, pos, lr, kind, open_first: bool, open_last: bool) -> pa.RecordBatch:
        new_key = np.r_[True, key[1:] != key[:-1]]
        new = new_key | np.r_[True, around[1:] != around[:-1]]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        other = (doc != doc[first]) | (tie != tie[first]) | (pos != pos[first])
        group = np.cumsum(new_key) - 1
        unsure = np.zeros(group[-1] + 1, bool)
        unsure[0] |= open_first
        unsure[-1] |= open_last
        several = (np.bincount(group, new) > 1) | unsure
        out = np.where(other, 1, 0)
        check = np.flatnonzero(new & several[group])
        if len(check):
            for bit, side in ((2, lr[check] >> 16 & 0xFFFF), (4, lr[check] & 0xFFFF)):
                _, inverse, n = np.unique(group[check] << 16 | side, return_inverse=True, return_counts=True)
                out[check[((n[inverse] > 1) | unsure[group[check]]) & (side > 0)]] |= bit
        own = kind == 1
        out[own] = 1
        keep = out > 0
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (doc, tie, pos, key, lr, out)], ["doc", "tie", "pos", "key", "lr", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows, cut_off = 0, True
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
            held.append(cols)
            rows += b.num_rows
            key, around = cols[0], cols[1]
            cut = int(np.searchsorted(key, key[-1]))
            inside = rows >= LOCAL_ROWS and not cut
            if inside:  # one gram with very many surroundings: cut between those
                cut = int(np.flatnonzero(np.r_[True, around[1:] != around[:-1]])[-1])
            elif rows < 50_000:
                continue
            if not cut:
                continue
            joined = [np.concatenate([h[i] for h in held[:-1]] + [cols[i][:cut]]) for i in range(len(names))]
            yield judge(*joined, cut_off, inside)
            held, rows, cut_off = [[c[cut:] for c in cols]], len(key) - cut, inside
        if held:
            yield judge(*(np.concatenate([h[i] for h in held]) for i in range(len(names))), cut_off, True)

    parts = int(occurrences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = occurrences.repartitionById(parts, "part").drop("part").sortWithinPartitions("key", "around", "doc", "tie", "pos")
    return dealt.mapInArrow(run, "doc long, tie long, pos long, key long, lr long, kind long")


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``x`` in order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(x[1:].astype(np.int16) - x[:-1].astype(np.int16))
    rise[-1] = -1
    at = np.where(rise != 0, np.arange(n), n - 1)
    smaller = rise[np.minimum.accumulate(at[::-1])[::-1]] > 0  # than the next suffix
    depth = min(depth, n)
    view = np.lib.stride_tricks.sliding_window_view(np.r_[x, np.zeros(depth, np.uint8)], depth)
    direct = np.flatnonzero(smaller)[::-1]  # of suffixes that differ in the zeros behind the end alone, the shorter first
    direct = direct[np.argsort(x[direct], kind="stable")]
    counts = np.bincount(x[direct], minlength=256)
    sorted_part = [p[np.argsort(view[p].view(f"S{depth}").ravel(), kind="stable")] for p in np.split(direct, np.cumsum(counts)[:-1])]
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[x[-1]].append(np.array([n - 1]))
    out = []

    def induce(places: np.ndarray, c: int) -> np.ndarray:
        """Deals the larger predecessors to the buckets of their first bytes; returns those in this bucket."""
        before = places[places > 0] - 1
        before = before[~smaller[before]]
        first = x[before]
        up = before[first > c]
        if len(up):
            order = np.argsort(x[up], kind="stable")
            up = up[order]
            edges = np.flatnonzero(np.diff(x[up])) + 1
            for part in np.split(up, edges):
                waiting[x[part[0]]].append(part)
        return before[first == c]

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        if len(sorted_part[c]):
            out.append(sorted_part[c])
            induce(sorted_part[c], c)
    return np.concatenate(out)


def repeated_windows(segments: list[tuple[int, int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """(doc, tie, first, last) runs of window starts that occur earlier among the segments (doc, tie, start, bytes)."""
    out, distinct = [], {}
    for s in segments:  # equal segments: only the earliest goes on
        old = distinct.get(s[3])
        if old is None or s[:3] < old[:3]:
            distinct[s[3]] = s
    for s in segments:
        if s[:3] != distinct[s[3]][:3]:
            out.append((s[0], s[1], s[2], s[2] + len(s[3]) - length))
    own = list(distinct.values())
    x = np.frombuffer(b"\0".join(s[3] for s in own) + b"\0", np.uint8)
    sizes = np.array([len(s[3]) for s in own])
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(x, length + 4)
    seg = np.searchsorted(begin, order, side="right") - 1
    inside = order - begin[seg]
    valid = inside + length <= sizes[seg]
    order, seg, inside = order[valid], seg[valid], inside[valid]
    if len(order) < 2:
        return out
    equal = np.zeros(len(order) - 1, bool)  # a common prefix with the neighbour of at least ``length``
    view = np.lib.stride_tricks.sliding_window_view(x, length)
    for lo in range(0, len(equal), 20_000):
        a, b = order[lo:lo + 20_001][:-1], order[lo + 1:lo + 20_001]
        equal[lo:lo + len(a)] = (view[a] == view[b]).all(axis=1)
    group = np.r_[0, np.cumsum(~equal)]
    many = np.flatnonzero(np.bincount(group)[group] > 1)
    if not len(many):
        return out
    doc, tie, start = (np.array(c, np.int64) for c in list(zip(*own))[:3])
    seg, inside, group = seg[many], inside[many], group[many]
    doc, tie, pos = doc[seg], tie[seg], start[seg] + inside
    rank, first = _first_of(group, doc, tie, pos)
    doc, tie, pos = doc[rank], tie[rank], pos[rank]
    later = (doc != doc[first]) | (tie != tie[first]) | (pos != pos[first])
    doc, tie, pos = doc[later], tie[later], pos[later]
    rank = np.lexsort((pos, tie, doc))
    doc, tie, pos = doc[rank], tie[rank], pos[rank]
    if len(pos):
        new = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (pos[1:] > pos[:-1] + 1)]
        lo = np.flatnonzero(new)
        hi = np.r_[lo[1:], len(pos)] - 1
        out += zip(doc[lo].tolist(), tie[lo].tolist(), pos[lo].tolist(), pos[hi].tolist())
    return out


def _places(verdicts: DataFrame, hot: int, broadcast_docs: int) -> DataFrame:
    """Places to check per document; ``hot`` there has the bits of halves that more than ``hot`` places share."""
    sides = {2: F.shiftright("lr", 16).bitwiseAND(F.lit(0xFFFF)), 4: F.col("lr").bitwiseAND(F.lit(0xFFFF))}
    check = verdicts.where("kind <> 1").withColumn("hot", F.lit(0).cast("long"))
    halves = F.array(*(F.when(F.col("kind").bitwiseAND(F.lit(bit)) > 0, F.struct(F.lit(bit).alias("bit"), side.alias("side")))
                       for bit, side in sides.items()))
    each = check.select("key", F.explode(halves).alias("half")).where("half IS NOT NULL")
    many = stored(each.groupBy("key", "half").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "suffix-hot")
    if not many.isEmpty():
        for bit, side in sides.items():
            own = many.where(F.col("half.bit") == bit).select("key", F.col("half.side").alias("side"), F.lit(bit).alias("more"))
            check = (check.withColumn("side", side).join(broadcast_if(own, broadcast_docs), ["key", "side"], "left")
                     .withColumn("hot", F.col("hot") + F.coalesce("more", F.lit(0)).bitwiseAND(F.col("kind"))).drop("side", "more"))
    return stored(check.groupBy("doc", "tie").agg(F.collect_list(F.struct("pos", "key", "kind", "hot")).alias("places")), "suffix-places")


def _segments(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Segments (key, doc, tie, start, seg, hot) around the places to check, keyed by the gram and the shared half;
    hot ones, which need not meet, by their place."""
    wide, half = length - GRAM + 1, (length - GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        out = []
        for doc, tie, text, found in rows_of(batches, "doc", "tie", "text", "places"):
            for p in found:
                at, key, kind = p["pos"], p["key"], p["kind"]
                for bit, lo, hi, a, b in ((2, at - wide + 1, at + GRAM + half, at - half, at), (4, at - half, at + length, at + GRAM, at + GRAM + half)):
                    lo, hi = max(0, lo), min(len(text), hi)
                    if kind & bit and hi - lo >= length:
                        hot = p["hot"] & bit > 0
                        met = b"%d %d" % (doc, at) if hot else text[a:b] + key.to_bytes(8, "little", signed=True)
                        out.append((xxhash.xxh64_intdigest(met, bit) - (1 << 63), doc, tie, lo, text[lo:hi], hot))
            if len(out) >= 20_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        c = list(zip(*rows))
        cols = [*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.binary()), pa.array(c[5], pa.bool_())]
        return pa.RecordBatch.from_arrays(cols, ["key", "doc", "tie", "start", "seg", "hot"])

    return docs.join(places, ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(
        run, "key long, doc long, tie long, start long, seg binary, hot boolean")


def _sorted_segments(segments: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows; hot segments are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        group: list[tuple] = []
        large: list[tuple] = []
        now, size = None, 0

        def batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.binary())], ["doc", "tie", "first", "last", "seg"])

        def sort(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            yield from batch([(*r, None) for r in repeated_windows(rows, length)])

        for key, doc, tie, start, seg, hot in rows_of(batches, "key", "doc", "tie", "start", "seg", "hot"):
            if hot:
                large.append((doc, tie, start, start, seg))
                if len(large) >= 10_000:
                    yield from batch(large)
                    large = []
                continue
            if key != now:
                if len(group) > 1:
                    ready += group
                    size += sum(len(r[3]) for r in group)
                if size >= ARRAY_BYTES:
                    yield from sort(ready)
                    ready, size = [], 0
                now, group = key, []
            group.append((doc, tie, start, seg))
        yield from batch(large)
        if len(group) > 1:
            ready += group
        if ready:
            yield from sort(ready)

    dealt = segments.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc long, tie long, first long, last long, seg binary")


def _by_bytes(hot: DataFrame, length: int) -> DataFrame:
    """Repeated windows of segments too many for one task: windows grouped by their bytes."""
    starts = F.sequence(F.lit(0), F.octet_length("seg") - length)
    each = hot.select("doc", "tie", "first", "seg", F.explode(starts).alias("k"))
    each = each.select("doc", "tie", (F.col("first") + F.col("k")).alias("first"), F.substring("seg", F.col("k") + 1, F.lit(length)).alias("w")).distinct()
    place = F.struct("doc", "tie", "first")
    least = each.groupBy("w").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("w", "least")
    later = each.join(least, "w").where(place != F.col("least"))
    return later.select("doc", "tie", "first", F.col("first").alias("last"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a document key (doc, tie) that orders them; whole repeated rows share it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.lit(LAST) - F.xxhash64(F.lit(1), F.octet_length(text), text).bitwiseAND(F.lit(0x7FFFFFFF))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("doc"), F.xxhash64(text).alias("tie"),
                       F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))


def removed_ranges(docs: DataFrame, length: int, hot: int = HOT, broadcast_docs: int = BROADCAST_DOCS) -> DataFrame:
    """(doc, tie, ranges): per document with repeated windows the runs of their starts, merged and in order."""
    verdicts = stored(_verdicts(_occurrences(docs.select("doc", "tie", "text"), length)), "suffix-verdicts")
    places = _places(verdicts, hot, broadcast_docs)
    once = docs.select("doc", "tie", "text")
    found = stored(_sorted_segments(_segments(once, broadcast_if(places, broadcast_docs), length), length), "suffix-runs")
    wide = length - GRAM + 1
    runs = (verdicts.where("kind = 1").select("doc", "tie", F.greatest(F.col("pos") - wide + 1, F.lit(0)).alias("first"), F.col("pos").alias("last"))
            .unionByName(found.where("seg IS NULL").drop("seg")))
    large = found.where("seg IS NOT NULL")
    if not large.isEmpty():
        runs = runs.unionByName(_by_bytes(large, length))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for (pairs,) in rows_of([b], "runs"):
                lo, hi = np.array([(p["first"], p["last"]) for p in pairs], np.int64).T
                order = np.argsort(lo, kind="stable")
                lo, hi = lo[order], np.maximum.accumulate(hi[order])
                new = np.r_[True, lo[1:] > hi[:-1] + 1]
                at = np.flatnonzero(new)
                out.append(np.stack([lo[at], np.r_[hi[at[1:] - 1], hi[-1]]], axis=1).ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))], ["doc", "tie", "ranges"])

    per = runs.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))  # bounded by the text's length
    return stored(per.select("doc", "tie", "runs").mapInArrow(merge, "doc long, tie long, ranges array<long>"), "suffix-ranges")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
                   broadcast_docs: int = BROADCAST_DOCS, with_bytes: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; ``with_bytes``
    adds the remaining bytes."""
    if length < GRAM + 4:
        raise ValueError(f"strings must have at least {GRAM + 4} bytes")
    rows = _keyed(docs, id_col, text_col)
    ranges = removed_ranges(rows, length, hot, broadcast_docs)
    names = ["id", "own", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, runs in rows_of([b], "text", "ranges"):
                n, removed, spans, kept, at = len(text), 0, 0, [], 0
                last = -1
                for lo, hi in zip((runs or [])[::2], (runs or [])[1::2]):
                    lo, hi = max(lo, 0), min(hi, n - length) + length  # bytes lo..hi-1
                    if hi <= lo or n < length:
                        continue
                    lo = max(lo, at)
                    spans += lo > last or last < 0
                    kept.append(text[at:lo])
                    removed += hi - lo
                    at = last = hi
                kept = b"".join([*kept, text[at:]])
                out.append((n, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            c = list(zip(*out)) if out else [[]] * 5
            cols = [b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in c[:3]), pa.array(c[3], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(c[4], pa.binary())] * with_bytes, names)

    joined = rows.join(broadcast_if(ranges, broadcast_docs), ["doc", "tie"], "left").select("id", F.sha2("text", 256).alias("own"), "text", "ranges")
    schema = "id long, own string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    done = joined.mapInArrow(cut, schema)
    copy = F.row_number().over(Window.partitionBy("id", "own", "n_bytes").orderBy(F.lit(0))) > 1  # a whole repeated row
    gone = F.col("again") & (F.col("n_bytes") >= length)
    out = done.withColumn("again", copy)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("id").alias(id_col), "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                      F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
                      F.when(gone, F.lit(empty)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
                      *([F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_bytes else []))
