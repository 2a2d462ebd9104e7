"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Lengths are whole numbers up to the capacity, so where a piece goes depends only on its length
and on its rank among the pieces of that length. A plan is made from the number of pieces per
length (at most ``capacity`` numbers):

* Large items, over a third of the capacity, meet at most twice in a bin: from the longest on,
  each is matched with the longest other large item that still fits.
* Smaller items, from the longest on, go to the bin with the smallest gap that holds them.

Bins that are filled alike are one class with a count, so the plan has a few thousand intervals
of ranks whatever the number of documents. The documents then find their places by a join with
the intervals; nothing else passes through the driver.

Defined cases: a null or empty text has only the end id; rows that share a doc_id are packed each;
only documents longer than the capacity are cut, and only their first piece may be shorter than
the capacity; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import lean, numbered, read, written
from tripmill.llm.token_files import ids_of_texts, texts_of
from tripmill.llm.tokens import vocabulary_path

#: Production parameters.
CAPACITY, END_ID, RANKED_TOGETHER = 2048, 0, 100_000
PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece; ``copy`` tells rows with equal doc_id apart, ``ids`` only on demand."""
    end = np.uint32(end_id).tobytes()

    def run(batches):
        for batch in batches:
            for some, ids_of in ids_of_texts(batch, vocabulary, end):
                rows: list[tuple] = []
                for doc_id, raw in zip(some.column(0).to_pylist(), ids_of):
                    n = len(raw) // 4
                    cut = [0, *range(n % capacity or capacity, n, capacity), n]
                    copy = zlib.crc32(raw)
                    for piece, (start, stop) in enumerate(zip(cut, cut[1:])):
                        ids = raw[4 * start : 4 * stop]
                        rows.append((doc_id, copy, piece, start, stop - start, zlib.crc32(ids)) + ((ids,) if with_ids else ()))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "copy", "piece", "start", "length", "ids_crc32", "ids"]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(columns)]
                )

    # Encoded and cut in one pass: ids leave their worker only if they are asked for.
    return texts_of(docs).mapInArrow(lean(run), PIECES + ", ids binary" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Intervals: length, first rank, end rank, first bin, items per bin, offset in the bin."""
    used = dict.fromkeys(counts, 0)
    left = dict(counts)
    gaps: list[int] = []
    bins: dict[int, list[tuple[int, int]]] = {}
    n_bins = 0

    def put(length: int, n: int, first: int, each: int, offset: int):
        begin = used[length]
        used[length] += n
        left[length] -= n
        return length, begin, begin + n, first, each, offset

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in bins:
                insort(gaps, gap)
            bins.setdefault(gap, []).append((first, n))

    lengths = sorted(counts)
    large = [x for x in lengths if 3 * x > capacity]
    for length in reversed(large):
        while left[length]:
            room = capacity - length
            k = bisect_left(large, min(room, length) + 1) - 1
            while k >= 0 and not (left[large[k]] > (large[k] == length)):
                k -= 1
            if k < 0:
                n, gap = left[length], room
                yield put(length, n, n_bins, 1, 0)
            elif large[k] == length:
                n, gap = left[length] // 2, room - length
                yield put(length, 2 * n, n_bins, 2, 0)
            else:
                n, gap = min(left[length], left[large[k]]), room - large[k]
                yield put(length, n, n_bins, 1, 0)
                yield put(large[k], n, n_bins, 1, length)
            keep(gap, n_bins, n)
            n_bins += n
    for length in reversed(lengths):
        while left[length]:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                # No bin has room: open as many as this length fills.
                each = capacity // length
                n = -(-left[length] // each)
                keep(capacity, n_bins, n)
                n_bins += n
                continue
            gap = gaps[k]
            first, n = bins[gap].pop()
            if not bins[gap]:
                del bins[gap]
                gaps.pop(k)
            each = min(gap // length, left[length])
            taken = min(n, left[length] // each)
            yield put(length, taken * each, first, each, capacity - gap)
            keep(gap - each * length, first, taken)
            keep(gap, first + taken, n - taken)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written) with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = max(1, -(-max(counts.values(), default=0) // RANKED_TOGETHER))
    spots = pieces.sparkSession.createDataFrame(
        list(plan(counts, capacity)), "length long, low long, high long, first long, each long, base long"
    )
    order = [F.col(c) for c in ("doc_id", "copy", "piece")]
    # Dealt by document, copy and piece: neither a long document nor a repeated id is one task's.
    ranked = numbered(pieces, ["length"], order, F.struct(*order), buckets, "rank")
    spot = spots.withColumnRenamed("length", "spot_length")
    inside = F.col("rank") - F.col("low")
    # The intervals are bounded by the capacity, not by the number of documents.
    return (
        ranked.join(
            F.broadcast(spot),
            (F.col("length") == F.col("spot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        )
        .withColumn("sequence_id", F.col("first") + F.expr("(rank - low) DIV each"))
        .withColumn("offset", F.col("base") + F.pmod(inside, F.col("each")) * F.col("length"))
        .drop("rank", "spot_length", "low", "high", "first", "each", "base")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """A row per piece with its sequence and place there."""
    return place(written(token_pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from ``pack_documents(..., with_ids=True)``: sequence_id, doc_ids, lengths, ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
        F.aggregate("parts.ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)).alias("ids"),
    )


def op2_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), vocabulary_path()).drop("copy")
