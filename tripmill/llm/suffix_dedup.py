"""Exact substring deduplication with suffix arrays per shard.

Every byte that a string of ``length`` bytes covers goes, if that string also starts in a document with a
smaller doc_id. Strings never cross documents and are judged on the input.

1. Documents are gathered into shards of about ``SHARD_BYTES``, written once, bucketed by shard.
2. Every string has an anchor: the smallest hash of the ``GRAM``-byte grams in it. Equal strings have
   equal anchors, so a string whose anchor occurs in one document only is unique. A task per
   hash range finds the anchors of several shards; each shard gets a bit per anchor back.
3. Per shard, a suffix array of the stretches that repeated anchors leave is refined by prefix doubling
   on unsorted groups (Larsson-Sadakane); common prefixes by Kasai's bound, run in parallel lanes,
   part it into groups of equal strings. In each group all but the smallest document are settled;
   only strings of that one whose anchors other shards have go on, as runs of bytes.
4. A task per anchor range has each shard's strings as a sorted run and merges the runs by binary search,
   with the smallest document of each string. What it finds is checked byte by byte.
5. The spans found come back to the shards, which cut them out.

However many copies of a string there are, each shard sends it once, and tasks get ranges of hashes.

Defined cases: a null text is empty; a null doc_id is smaller than all others; rows that share a doc_id
remove nothing from each other, but each is removed from by smaller ones; a text shorter than
``length`` stays whole; an empty table gives an empty result; other columns are ignored. A document is
never cut between shards: a longer one is a shard by itself.
"""

from __future__ import annotations

import uuid
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, trim
from tripmill.session import scratch_dir

#: Production parameters: bytes of a string, of a gram, of a shard, about of text in a range of anchors.
LENGTH, GRAM, SHARD_BYTES, RANGE_BYTES = 50, 24, 1 << 20, 8 << 20
#: Anchors are found for so many positions at a time: what that takes fits the processor's cache.
AT_ONCE = 1 << 15
#: Parallel lanes of Kasai's scan are this many positions long.
LANE = 16
_BASE = 0x9E3779B97F4A7C15
_NULL = np.iinfo(np.int64).min


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on, by joining halves; the last size - 1 are missing."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width, done = data.astype(np.uint64) + np.uint64(11), 1, None
    have = 0
    rest = size
    while rest:
        if rest & 1:
            if done is None:
                done, have = power, width
            else:
                m = len(power) - have
                done = done[:m] * np.uint64(pow(_BASE, width, 1 << 64)) + power[have : have + m] if m > 0 else done[:0]
                have += width
        rest >>= 1
        if rest:
            m = len(power) - width
            power = power[:m] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:]
            width *= 2
    return _mix(done[:n])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The smallest gram hash in each string of ``length`` bytes."""
    least, width, need = rolling(data, gram), 1, length - gram + 1
    while 2 * width <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[: len(least) - (need - width)], least[need - width :]) if need > width else least


def words8(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on as a big-endian number; zeros follow the end."""
    padded = np.r_[data, np.zeros(72, np.uint8)]
    return np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,)).astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order, by Larsson-Sadakane refinement."""
    n = len(data)
    first = words8(data)[:n]
    order = np.argsort(first)
    fresh = np.r_[True, first[order][1:] != first[order][:-1]]
    starts = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    del first
    h = 8
    while True:
        # Only groups of several suffixes are sorted on, each within its own places.
        size = np.diff(np.r_[starts, n])
        open_at = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_at):
            break
        some = order[open_at]
        # What ends sooner comes first.
        beyond = some + h - n
        then = np.where(beyond < 0, rank[np.minimum(some + h, n - 1)], -1 - beyond) + h + 1
        key = rank[some] * (n + h + 1) + then
        by = np.argsort(key)
        some, key = some[by], key[by]
        order[open_at] = some
        new = np.r_[True, key[1:] != key[:-1]]
        fresh[open_at] = new
        starts = np.flatnonzero(fresh)
        leader = open_at[np.flatnonzero(new)]
        rank[some] = np.repeat(leader, np.diff(np.r_[np.flatnonzero(new), len(some)]))
        h *= 2
    return order


def _extend(eight: np.ndarray, a: np.ndarray, b: np.ndarray, have: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix lengths of suffixes a and b that share ``have`` bytes, up to ``cap`` or a little more."""
    have = have.copy()
    on = np.flatnonzero(have < cap)
    while len(on):
        x = eight[np.minimum(a[on] + have[on], len(eight) - 1)] ^ eight[np.minimum(b[on] + have[on], len(eight) - 1)]
        same = x == 0
        top = np.where(same, np.uint64(1), x & ~(x >> np.uint64(1)))
        have[on] += np.where(same, 8, 7 - (np.log2(top.astype(np.float64)).astype(np.int64) >> 3))
        on = on[same & (have[on] < cap)]
    return have


def common_prefixes(data: np.ndarray, order: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, up to ``cap``.

    Kasai: a suffix shares at least one byte less than the suffix one position earlier. The scan runs in
    parallel lanes of ``LANE`` positions.
    """
    n = len(data)
    eight = words8(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    for step in range(LANE):
        at = np.arange(step, n, LANE)
        least = np.maximum(shared[at - 1] - 1, 0) if step else np.zeros(len(at), np.int64)
        there = before[at]
        least[there < 0] = cap
        got = np.minimum(_extend(eight, at, np.maximum(there, 0), least, cap), cap)
        got = np.minimum(got, n - np.maximum(at, there))
        shared[at] = np.where(there < 0, 0, got)
    return shared[order]


class Shard:
    """Documents one after the other."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.starts = np.r_[0, self.ends[:-1]].astype(np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of strings of one document with one anchor: first, end, anchor."""
        n = max(0, len(self.data) - LENGTH + 1)
        least = np.empty(n, np.uint64)
        for k in range(0, n, AT_ONCE):
            least[k : k + AT_ONCE] = anchors(self.data[k : k + AT_ONCE + LENGTH - 1])
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64), least
        # A string that would cross the end of its document is none.
        crossing = np.zeros(n + 1, np.int32)
        np.add.at(crossing, np.clip(np.maximum(self.ends - LENGTH + 1, self.starts), 0, n), 1)
        np.add.at(crossing, np.clip(self.ends, 0, n), -1)
        valid = np.cumsum(crossing)[:n] == 0
        change = np.r_[True, (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])]
        # Documents of their own are parted even if nothing crosses between them.
        inner = self.starts[(self.starts > 0) & (self.starts < n)]
        change[inner] = True
        first = np.flatnonzero(change)
        end = np.r_[first[1:], n]
        kept = valid[first]
        # The smallest of many hashes is a small number: mixed again, anchors spread evenly over ranges.
        return first[kept], end[kept], _mix(least[first[kept]])

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")


def shard_table(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Shards bucketed by ``shard``, the buckets, and the bytes of all texts."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, ceil(total / (8 * SHARD_BYTES)))

    def run(batches):
        ids: list[int] = []
        held: list[bytes] = []
        size, task, done = 0, TaskContext.get().partitionId(), 0

        def row():
            data = b"".join(held)
            ends = np.cumsum([len(t) for t in held], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | done], pa.int64())]  # the same if the task runs again
                + [pa.array([b], pa.binary()) for b in (np.array(ids, np.int64).tobytes(), ends.tobytes(), data)],
                names=["shard", "ids", "ends", "data"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(_NULL if doc_id is None else doc_id)
                held.append((text or "").encode("utf-8", "surrogatepass"))
                size += len(held[-1])
                if size >= SHARD_BYTES or len(ids) >= 100_000:
                    yield row()
                    ids, held, size, done = [], [], 0, done + 1
        if ids:
            yield row()

    name = f"text_shards_{uuid.uuid4().hex}"
    (
        rows.mapInArrow(run, "shard long, ids binary, ends binary, data binary")
        .repartition(buckets, "shard")
        .write.bucketBy(buckets, "shard")
        .option("path", f"{scratch_dir(spark, 'text-shards')}/{name}")
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name), buckets, total


_KEYS = "part int, shard long, keys binary"


def _range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash range begins in sorted keys."""
    return np.searchsorted(_range_of(keys, parts), np.arange(parts + 1))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the order that sorts all, and the number of each sorted key among the distinct."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]][: len(keys)]
    return ordered[fresh], order, np.cumsum(fresh) - 1


def _part_keys(table: DataFrame, parts: int) -> DataFrame:
    """Sorted distinct anchors of each shard by hash range, in 5 bytes each."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = _distinct(Shard(row).strings()[2])[0]
                cut = _ranges(keys, parts)
                out = [
                    (p, row["shard"], keys[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 4::-1].T.tobytes())
                    for p, (a, b) in enumerate(zip(cut, cut[1:])) if a < b
                ]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))],
                        names=["part", "shard", "keys"],
                    )

    return table.mapInArrow(run, _KEYS)


def _repeated(table: pa.Table) -> pa.Table:
    """One hash range: a bit for each anchor of each shard, set if another shard has it."""
    rows = table.to_pylist()
    parts = []
    for r in rows:
        planes = np.frombuffer(r["keys"], np.uint8).reshape(5, -1)
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, 4::-1] = planes.T
        parts.append(wide.view("<u8").reshape(-1))
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    ordered = keys[order]
    twice = np.r_[False, ordered[1:] == ordered[:-1]]
    twice[:-1] |= twice[1:]
    again = np.empty(len(keys), bool)
    again[order] = twice
    ends = np.cumsum([len(p) for p in parts])
    bits = [np.packbits(again[e - len(p) : e]).tobytes() for p, e in zip(parts, ends)]
    return pa.table(
        [pa.array([r["part"] for r in rows], pa.int32()), pa.array([r["shard"] for r in rows], pa.int64()), pa.array(bits, pa.binary())],
        names=["part", "shard", "keys"],
    )


def _merged_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint ranges that cover the same."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.r_[True, starts[1:] > ends[:-1]]
    return starts[fresh], ends[np.r_[np.flatnonzero(fresh)[1:] - 1, len(ends) - 1]]


def _spread(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of all ranges."""
    size = end - first
    return np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum()) if len(size) else first


_FOUND = "part int, shard long, starts binary, ends binary, docs binary, data binary"


def _found(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4
    names = ["part", "shard", "starts", "ends", "docs", "data"]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def settle(shard: Shard, first, end, anchor, elsewhere) -> tuple[tuple, tuple]:
    """Spans that go for certain, and runs of strings to be compared with other shards.

    ``first``, ``end``, ``anchor``: runs of strings; ``elsewhere``: whether another shard has the anchor.
    """
    none = np.empty(0, np.int64)
    document = shard.document(first)
    # Anchors of one document in this shard, and of no other shard, have nothing to be compared with.
    order = np.argsort(anchor)
    group = np.r_[True, anchor[order][1:] != anchor[order][:-1]] if len(order) else np.empty(0, bool)
    starts = np.flatnonzero(group)
    ids = shard.ids[document][order]
    several = np.zeros(len(first), bool)
    if len(order):
        low, high = np.minimum.reduceat(ids, starts), np.maximum.reduceat(ids, starts)
        several[order] = np.repeat(low != high, np.diff(np.r_[starts, len(order)]))
    kept = several | elsewhere
    if not kept.any():
        return (none, none), (none, none, none)
    first, end, elsewhere, document = first[kept], end[kept], elsewhere[kept], document[kept]
    # Stretches of consecutive strings, with the bytes that the last of them covers.
    head = np.r_[True, (first[1:] != end[:-1]) | (document[1:] != document[:-1])]
    at = np.flatnonzero(head)
    s_first, s_end = first[at], end[np.r_[at[1:] - 1, len(end) - 1]] + LENGTH - 1
    source = _spread(s_first, s_end)
    data = shard.data[source]
    is_string = np.zeros(len(data), bool)
    base = np.r_[0, np.cumsum(s_end - s_first)[:-1]]
    is_string[_spread(base, base + s_end - s_first - LENGTH + 1)] = True
    order = suffix_array(data)
    equal = np.cumsum(common_prefixes(data, order) < LENGTH)
    chosen = is_string[order]
    order, equal = order[chosen], equal[chosen]
    position = source[order]
    owner = shard.ids[shard.document(position)]
    starts = np.flatnonzero(np.r_[True, equal[1:] != equal[:-1]])
    least = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.r_[starts, len(order)]))
    gone = np.sort(position[owner > least])
    spans = _merged_ranges(gone, gone + LENGTH)
    ahead = np.zeros(len(shard.data) + 1, bool)
    ahead[position[owner == least]] = True
    # Runs keep one anchor each, so that all copies of a string meet in one range.
    inside = _spread(first[elsewhere], end[elsewhere])
    run = np.repeat(np.flatnonzero(kept)[elsewhere], (end - first)[elsewhere])
    sent = ahead[inside]
    inside, run = inside[sent], run[sent]
    if not len(inside):
        return spans, (none, none, none)
    cut = np.flatnonzero(np.r_[True, (inside[1:] != inside[:-1] + 1) | (run[1:] != run[:-1])])
    last = np.r_[cut[1:] - 1, len(inside) - 1]
    return spans, (inside[cut], inside[last] + 1, run[cut])


def _settled(parts: int):
    def run(key, shards: pa.Table, bits: pa.Table) -> pa.Table:
        found = settled(shards, bits)
        trim()
        return found

    def settled(shards: pa.Table, bits: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in shards.to_pylist():
            shard = Shard(row)
            first, end, anchor = shard.strings()
            keys, order, number = _distinct(anchor)
            again = np.zeros(len(keys), bool)
            cut = _ranges(keys, parts)
            for r in bits.to_pylist():
                a, b = cut[r["part"]], cut[r["part"] + 1]
                again[a:b] = np.unpackbits(np.frombuffer(r["keys"], np.uint8), count=b - a).astype(bool)
            elsewhere = np.empty(len(anchor), bool)
            elsewhere[order] = again[number]
            (gone, until), (starts, ends, runs) = settle(shard, first, end, anchor, elsewhere)
            if len(gone):
                out.append((row["shard"] % parts, row["shard"], gone.tobytes(), until.tobytes(), None, None))
            of = _range_of(anchor[runs], parts)
            by = np.argsort(of, kind="stable")
            starts, ends = starts[by], ends[by]
            owner = shard.ids[shard.document(starts)]
            size = ends - starts + LENGTH - 1
            data = shard.data[_spread(starts, ends + LENGTH - 1)]
            cut, until = np.searchsorted(of[by], np.arange(parts + 1)), np.r_[0, np.cumsum(size)]
            for p in np.flatnonzero(np.diff(cut)).tolist():
                a, b = cut[p], cut[p + 1]
                out.append(
                    (p, row["shard"], starts[a:b].tobytes(), ends[a:b].tobytes(), owner[a:b].tobytes(), data[until[a] : until[b]].tobytes())
                )
        return _found(out)

    return run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs of (distinct keys, place of the string) as one, by binary search of each in another.

    Of equal keys the place with the smallest ``owner`` stays.
    """
    while len(runs) > 1:
        after = []
        for (a_keys, a_at), (b_keys, b_at) in zip(runs[::2], runs[1::2]):
            spot = np.searchsorted(a_keys, b_keys)
            hit = spot < len(a_keys)
            hit[hit] = a_keys[spot[hit]] == b_keys[hit]
            there = spot[hit]
            a_at = a_at.copy()
            a_at[there] = np.where(owner[b_at[hit]] < owner[a_at[there]], b_at[hit], a_at[there])
            new_keys, new_at, new_spot = b_keys[~hit], b_at[~hit], spot[~hit]
            keys = np.empty(len(a_keys) + len(new_keys), np.uint64)
            at = np.empty(len(keys), np.int64)
            to = new_spot + np.arange(len(new_keys))
            rest = np.ones(len(keys), bool)
            rest[to] = False
            keys[to], at[to], keys[rest], at[rest] = new_keys, new_at, a_keys, a_at
            after.append((keys, at))
        runs = after + ([runs[-1]] if len(runs) % 2 else [])
    return runs[0]


def _judged(table: pa.Table) -> pa.Table:
    found = _found(_compared(table))
    trim()
    return found


def _compared(table: pa.Table) -> list[tuple]:
    """One anchor range: strings of which another shard has a smaller document."""
    rows = table.to_pylist()
    out = [(r["part"], r["shard"], r["starts"], r["ends"], None, None) for r in rows if r["data"] is None]
    rows = [r for r in rows if r["data"] is not None]
    if rows:
        data = np.concatenate([np.frombuffer(r["data"], np.uint8) for r in rows])
        first = np.concatenate([np.frombuffer(r["starts"], np.int64) for r in rows])
        end = np.concatenate([np.frombuffer(r["ends"], np.int64) for r in rows])
        docs = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
        of_row = np.repeat(np.arange(len(rows)), [len(r["starts"]) // 8 for r in rows])
        size = end - first
        base = np.r_[0, np.cumsum(size + LENGTH - 1)[:-1]]
        at = _spread(base, base + size)  # of each string in data
        position = _spread(first, end)  # of each string in its shard
        owner, from_row = np.repeat(docs, size), np.repeat(of_row, size)
        # Hashes are made some positions at a time: what is held at once stays near the size of the strings.
        keys = np.empty(len(at), np.uint64)
        for k in range(0, len(data), AT_ONCE):
            a, b = np.searchsorted(at, (k, k + AT_ONCE))
            keys[a:b] = rolling(data[k : k + AT_ONCE + LENGTH - 1], LENGTH)[at[a:b] - k]
        runs, orders = [], []
        for a in range(0, len(keys), AT_ONCE):
            order = a + np.argsort(keys[a : a + AT_ONCE])
            ordered, ids = keys[order], owner[order]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            times = np.diff(np.r_[starts, len(order)])
            # The first place of each string that has its smallest owner.
            least = np.flatnonzero(ids == np.repeat(np.minimum.reduceat(ids, starts), times))
            runs.append((ordered[starts], order[least[np.searchsorted(least, starts)]]))
            orders.append((order, times))
        known, best = merge_runs(runs, owner)
        source = np.empty(len(keys), np.int64)
        for (some, _), (order, times) in zip(runs, orders):
            source[order] = np.repeat(best[np.searchsorted(known, some)], times)
        gone = np.flatnonzero(owner > owner[source])
        eight = words8(data)
        differs = np.zeros(len(gone), bool)
        for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            differs |= eight[at[gone] + k] != eight[at[source[gone]] + k]
        if differs.any():
            # Hashes met by chance: these strings are judged by their bytes.
            apart = np.isin(keys, keys[gone[differs]])
            gone = gone[~apart[gone]]
            least: dict[bytes, int] = {}
            raw = data.tobytes()
            text = {i: raw[at[i] : at[i] + LENGTH] for i in np.flatnonzero(apart)}
            for i, t in text.items():
                least[t] = min(least.get(t, owner[i]), owner[i])
            gone = np.r_[gone, [i for i, t in text.items() if owner[i] > least[t]]].astype(np.int64)
        gone = np.sort(gone)
        bounds = np.searchsorted(from_row[gone], np.arange(len(rows) + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            starts = position[gone[bounds[k] : bounds[k + 1]]]
            starts, ends = _merged_ranges(starts, starts + LENGTH)
            out.append((rows[k]["part"], rows[k]["shard"], starts.tobytes(), ends.tobytes(), None, None))
    return out


def _cut(key, shards: pa.Table, found: pa.Table) -> pa.Table:
    out: list[tuple] = []
    spans = found.to_pylist()
    for row in shards.to_pylist():
        shard = Shard(row)
        starts, ends = (
            np.concatenate([np.frombuffer(s[c], np.int64) for s in spans]) if spans else np.empty(0, np.int64)
            for c in ("starts", "ends")
        )
        starts, ends = _merged_ranges(starts, ends)
        # Spans that touch where a document ends are two.
        cuts = shard.starts[1:]
        inner = np.searchsorted(starts, cuts, side="right") - 1
        hit = (inner >= 0) & (ends[inner] > cuts) & (starts[inner] < cuts) if len(starts) else np.zeros(len(cuts), bool)
        starts, ends = np.sort(np.r_[starts, cuts[hit]]), np.sort(np.r_[ends, cuts[hit]])
        raw = row["data"]
        low, high = np.searchsorted(starts, shard.starts), np.searchsorted(starts, shard.ends)
        for k, (a, b) in enumerate(zip(shard.starts.tolist(), shard.ends.tolist())):
            own = list(zip(starts[low[k] : high[k]].tolist(), ends[low[k] : high[k]].tolist()))
            edges = [a, *(x for s in own for x in s), b]
            kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
            doc_id = None if shard.ids[k] == _NULL else int(shard.ids[k])
            out.append((doc_id, b - a, b - a - len(kept), len(own), kept))
    kinds = [pa.int64()] * 4 + [pa.binary()]
    columns = list(zip(*out)) if out else [()] * 5
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    has_columns(docs, "doc_id", "text")
    table, buckets, total = shard_table(docs)
    parts = max(1, ceil(total / RANGE_BYTES))
    bits = (
        _part_keys(table, parts).repartition(parts, "part").groupBy("part").applyInArrow(_repeated, _KEYS)
        .repartition(buckets, "shard")
    )
    found = (
        table.groupBy("shard").cogroup(bits.groupBy("shard")).applyInArrow(_settled(parts), _FOUND)
        .repartition(parts, "part").groupBy("part").applyInArrow(_judged, _FOUND)
        .select("shard", "starts", "ends").repartition(buckets, "shard")
    )
    return table.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op7_suffix_dedup(spark, sf_dir):
    """What is left of every document without bytes of 50-byte strings of smaller documents."""
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
