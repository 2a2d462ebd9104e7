"""Ranked lexical search by length-sorted impact vectors.

A document is the vector of its impacts (term frequency against length, in integers), an item the vector of its terms'
weights; a score is their inner product. A pass over the documents writes their terms and frequencies for the terms of a
block of items only; counts of documents and terms come from that table. A task then orders vectors by Euclidean length and
cuts them into buckets. An item meets the buckets from the longest: the Cauchy-Schwarz bound of a bucket's
longest vector against the score of the item's 50th document so far ends it for all shorter ones. Inside a bucket the
inner product over the item's heaviest coordinates plus the Cauchy-Schwarz bound of what is left of both vectors
rules documents out one by one. Survivors are scored again from all terms in 64-bit integers, so floating point
never decides. Of each task at most 50 documents an item go to the final ranking; a first round over one document in
``SAMPLE`` gives every task a score that 50 documents reach, below which nothing is sent.

Items are taken in blocks of ``ITEMS``; what the driver and every task hold grows with a block's terms, never with documents.

Defined cases: a null text has no terms and counts nowhere; a document without terms is not counted in N; rows that share a
doc_id are documents each, a null doc_id ranks after all others of its score; rows of ``benchmark`` that share an item_id
(null included) are one item with the terms of all; an item without terms or without a match has no rows; empty
tables give no rows; texts have no length limit; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, written

#: Production parameters: documents of an item, items of a block, documents of a bucket and of a sorted slice,
#: coordinates bounded inside a bucket, one document in so many for the first threshold.
TOP, ITEMS, BUCKET, SLICE, FOCUS, SAMPLE = 50, 512, 1024, 1 << 15, 8, 64
#: Floating-point bounds are raised by this share before they rule anything out.
SLACK = 1e-9
#: What separates terms.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(ord(" ") if b in SEPARATORS and not 0x41 <= b <= 0x5A else b + 32 * (0x41 <= b <= 0x5A) for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8; bytes of characters beyond ASCII belong to terms."""
    return text.translate(_TABLE).split()


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Integer impact of each frequency in a document of n terms."""
    if len(n) and 50 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    m = np.asarray(50 + (50 * n * documents) // words, dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Items:
    """A block of items: ids, and for each the numbers of its terms and their weights, the heaviest first."""

    ids: list
    numbers: list[np.ndarray]
    weights: list[np.ndarray]
    documents: int
    words: int
    least: list[int]

    @property
    def vocabulary(self) -> int:
        return 1 + max((int(n.max()) for n in self.numbers if len(n)), default=-1)


class Bucket:
    """Vectors of falling length, by document and by term."""

    def __init__(self, n: np.ndarray, starts: np.ndarray, number: np.ndarray, impact: np.ndarray, norm: np.ndarray) -> None:
        self.sizes, self.starts, self.number, self.impact, self.norm = n, starts, number, impact, norm
        self.owner = np.repeat(np.arange(len(n)), n)
        self.order = np.argsort(number, kind="stable")
        self.by_term = number[self.order]

    def entries(self, term: int) -> np.ndarray:
        first, last = np.searchsorted(self.by_term, (term, term + 1))
        return self.order[first:last]

    def survivors(self, numbers: np.ndarray, weights: np.ndarray, least: float) -> np.ndarray:
        """Documents whose bound by the item's heaviest coordinates reaches ``least``."""
        inner, seen = np.zeros(len(self.sizes)), np.zeros(len(self.sizes))
        for term, weight in zip(numbers[:FOCUS].tolist(), weights[:FOCUS].tolist()):
            at = self.entries(term)
            value = self.impact[at].astype(np.float64)
            inner[self.owner[at]] += weight * value
            seen[self.owner[at]] += value * value
        rest = math.sqrt(float((weights[FOCUS:].astype(np.float64) ** 2).sum()))
        # What rounding may have taken from the remaining length is given back.
        left = np.sqrt(np.maximum(self.norm**2 * (1 + SLACK) - seen, 0)) if rest else 0.0
        return np.flatnonzero((inner + rest * left) * (1 + SLACK) >= least)

    def scores(self, some: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of documents, from all their entries."""
        sizes = self.sizes[some]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[some] - first, sizes) + np.arange(int(sizes.sum()))
        total = np.r_[0, np.cumsum(weight_of[self.number[at]] * self.impact[at])]
        return total[first + sizes] - total[first]


class Best:
    """The best documents of each item so far: scores, ids, whether the id is null."""

    def __init__(self, items: Items) -> None:
        self.items = items
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in items.ids]

    def least(self, k: int) -> int:
        """A score below this cannot be among the item's best."""
        scores = self.found[k][0]
        return max(1, self.items.least[k], int(scores[-1]) if len(scores) == TOP else 0)

    def add(self, k: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        kept = scores >= self.least(k)
        if kept.any():
            columns = [np.r_[a, b[kept]] for a, b in zip(self.found[k], (scores, ids, nulls))]
            order = np.lexsort((columns[1], columns[2], -columns[0]))[:TOP]
            self.found[k] = tuple(c[order] for c in columns)

    def batch(self) -> pa.RecordBatch:
        held = [np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*self.found)] or [np.empty(0, np.int64)] * 3
        owner = [i for i, f in zip(self.items.ids, self.found) for _ in range(len(f[0]))]
        return pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.int64()), pa.array(held[1], pa.int64(), mask=held[2].astype(bool)), pa.array(held[0], pa.int64())],
            names=["item_id", "doc_id", "score"],
        )


def search(vectors: list[tuple], items: Items, best: Best) -> tuple[int, int]:
    """Meet a slice of (doc_id, n, numbers, frequencies) with all items; documents bounded and scored exactly."""
    vectors = [v for v in vectors if len(v[2])]
    if not vectors:
        return 0, 0
    ids = np.array([v[0] or 0 for v in vectors], dtype=np.int64)
    nulls = np.array([v[0] is None for v in vectors])
    sizes = np.array([len(v[2]) for v in vectors])
    number, tf = (np.concatenate([v[c] for v in vectors]).astype(np.int64) for c in (2, 3))
    impact = impacts(tf, np.repeat([v[1] for v in vectors], sizes), items.documents, items.words)
    starts = np.cumsum(sizes) - sizes
    norm = np.sqrt(np.add.reduceat(impact.astype(np.float64) ** 2, starts))
    order = np.argsort(-norm, kind="stable")
    length = [math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in items.weights]
    weight_of, going = np.zeros(items.vocabulary, dtype=np.int64), set(range(len(items.ids)))
    bounded = scored = 0
    for start in range(0, len(order), BUCKET):
        rows = order[start : start + BUCKET]
        own = sizes[rows]
        first = np.cumsum(own) - own
        at = np.repeat(starts[rows] - first, own) + np.arange(int(own.sum()))
        bucket = Bucket(own, first, number[at], impact[at], norm[rows])
        for k in sorted(going):
            least = best.least(k)
            if length[k] * bucket.norm[0] * (1 + SLACK) < least:
                going.discard(k)
                continue
            some = bucket.survivors(items.numbers[k], items.weights[k], least)
            bounded, scored = bounded + len(rows), scored + len(some)
            if len(some):
                weight_of[items.numbers[k]] = items.weights[k]
                best.add(k, bucket.scores(some, weight_of), ids[rows[some]], nulls[rows[some]])
                weight_of[items.numbers[k]] = 0
    return bounded, scored


def _vectors(batch: pa.RecordBatch) -> list[tuple]:
    ids, n, numbers, tf = (batch.column(i).to_pylist() for i in range(4))
    return [(i, k, np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4")) for i, k, a, b in zip(ids, n, numbers, tf)]


def vectors_of(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, numbers and frequencies of the vocabulary's terms, for every document with a term."""
    has_columns(docs, "doc_id", "text")
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = held.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                rows = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    found = terms(text or b"")
                    if found:
                        counts = Counter(filter(None.__ne__, map(known.get, found)))
                        both = (np.fromiter(c, "<i4", len(counts)).tobytes() for c in (counts.keys(), counts.values()))
                        rows.append((doc_id, len(found), *both))
                columns = list(zip(*rows)) or [()] * 4
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n", "numbers", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, numbers binary, tf binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            some = [v[2] for v in _vectors(batch)]
            total += np.bincount(np.concatenate(some), minlength=size) if some else 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["number", "df"])

    out = np.zeros(size, dtype=np.int64)
    for row in vectors.mapInArrow(run, "number long, df long").groupBy("number").agg(F.sum("df").alias("df")).toArrow().to_pylist():
        out[row["number"]] = row["df"]
    return out


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    has_columns(items, "item_id", "text")

    def run(batches):
        for batch in batches:
            rows = [(i, t) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for t in set(terms(text or b""))]
            columns = list(zip(*rows)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def _ranked(candidates: DataFrame) -> DataFrame:
    """The best of each item; all but 50 of a task's rows go before the shuffle."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _candidates(vectors: DataFrame, items: Items) -> DataFrame:
    held = vectors.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, waiting = Best(held.value), []
        for batch in batches:
            waiting += _vectors(batch)
            if len(waiting) >= SLICE:
                search(waiting, held.value, best)
                waiting = []
        search(waiting, held.value, best)
        yield best.batch()

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


def _searched_block(docs: DataFrame, item_terms: dict[int | None, list[bytes]]) -> DataFrame:
    vocabulary = {t: k for k, t in enumerate(sorted({t for found in item_terms.values() for t in found}))}
    vectors = written(vectors_of(docs, vocabulary), "impact-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("words")).first()
    documents, words = total["n"], total["words"] or 1
    df = _document_counts(vectors, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(k) + 1))) for k in df]
    ids, numbers, weights = list(item_terms), [], []
    for found in item_terms.values():
        some = sorted((vocabulary[t] for t in found), key=lambda k: (-weight[k], k))
        numbers.append(np.array(some, dtype=np.int64))
        weights.append(np.array([weight[k] for k in some], dtype=np.int64))
    items = Items(ids, numbers, weights, documents, words, [0] * len(ids))
    sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE)) == 0)
    reached = _ranked(_candidates(sample, items)).where(F.col("rank") == TOP).select("item_id", "score").collect()
    known = {r["item_id"]: r["score"] for r in reached}
    items.least = [known.get(i, 0) for i in ids]
    return _ranked(_candidates(vectors, items))


def search_documents(docs: DataFrame, items: DataFrame, block: int = ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score: the 50 best documents of every item."""
    spark = docs.sparkSession
    item_terms = written(_item_terms(items), "item-terms")
    blocks = max(1, math.ceil(item_terms.select("item_id").distinct().count() / block))
    found = []
    for k in range(blocks):
        own: dict[int | None, list[bytes]] = {}
        chosen = item_terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        for row in chosen.toArrow().to_pylist():
            own.setdefault(row["item_id"], []).append(bytes(row["term"]))
        if own:
            found.append(written(_searched_block(docs, own), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found).select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return search_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_TERMS = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
)
ORACLE = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (SELECT r, {_TERMS} AS term FROM numbered),
held AS (SELECT r, term, count(*) AS tf FROM words GROUP BY 1, 2),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
frequency AS (SELECT term, count(*) AS df FROM held GROUP BY 1),
items AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
weights AS (
  SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM items JOIN frequency USING (term), total),
scores AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM weights JOIN held USING (term) JOIN sizes USING (r), total GROUP BY 1, 2),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores JOIN numbered USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
