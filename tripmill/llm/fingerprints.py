"""I-Match fingerprints with randomised lexicons.

Terms (lower-cased, cut at white space) whose inverse document frequency ln(N / df) over the distinct
texts of the corpus lies in a band form the lexicon: copies of a text count once. Each of ``SUBSETS`` random subsets of it, nested by level
(a term stays in a subset on level L with probability 2^-L), gives one hash of the sorted
distinct terms that a document has in it. The level follows the number of lexicon terms, so that a
subset holds about one of them, and the two next levels are kept for comparisons with longer documents.
The likeness of two fingerprints is the share of equal hashes among subsets that are not empty
in both, on the finest level that both need; documents whose numbers of terms differ by more than
about 8 to 1 have likeness 0.

A document whose lexicon terms are less than ``SHARE`` of its distinct terms is filled up to that share with its
rarest other terms: those below the band in order of their hashes, then those above it in order of df. One
term more or less changes the chosen terms by one or two, so near copies stay alike however common their text
is. At most mean distinct terms * e^(upper idf) terms can be in the band or above it, whatever the number of
documents: this bounds what every task holds.

Defined cases: a null text is an empty one; an empty text has a fingerprint without terms, like only
to equal ones; equal texts have equal fingerprints; rows that share a doc_id follow each other in
order of their texts; a null doc_id comes first; the only document of a table is its own next; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, shuffle_partitions, written

#: Production parameters: band of ln(N / df), random subsets, levels kept.
IDF_BAND, SUBSETS, LEVELS = (2.0, 8.0), 48, 3
#: Least share of a document's distinct terms that its fingerprint is made of.
SHARE = 0.5
#: Texts are told apart as repeated or not by this many bits of their hash; repeated ones are then compared whole.
SLOTS = 1 << 24
#: Distinct terms that a task counts before it hands the counts on; terms whose hashes a worker keeps.
COUNTED_TERMS, KEPT_TERMS = 400_000, 600_000
_ODD = 0x9E3779B97F4A7C15
_SEEDS = np.array([(k + 1) * _ODD % 2**64 for k in range(SUBSETS)], dtype=np.uint64)


def terms(text: str) -> set[str]:
    return set(text.lower().split())


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def depths(hashes: np.ndarray) -> np.ndarray:
    """Deepest level on which each subset still has each term: one row per term."""
    out = np.empty((len(hashes), SUBSETS), dtype=np.uint8)
    # Many terms a column at a time; few in one go.
    width = 1 if len(hashes) > 4096 else SUBSETS
    for k in range(0, SUBSETS, width):
        unit = (_mix(hashes[:, None] + _SEEDS[k : k + width]) >> np.uint64(11)).astype(np.float64) + 0.5
        out[:, k : k + width] = np.minimum(40, np.floor(53 - np.log2(unit))).astype(np.uint8)
    return out


_POWERS = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, dtype=np.uint64))


@dataclass(frozen=True)
class Fingerprint:
    level: int
    hashes: np.ndarray  # LEVELS x SUBSETS of 16 bits, 0 for no term

    def text(self) -> str:
        return f"{self.level:02x}" + self.hashes.astype(">u2").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        level = max(self.level, other.level)
        if level - min(self.level, other.level) >= LEVELS:
            return 0.0
        a, b = self.hashes[level - self.level], other.hashes[level - other.level]
        told = (a != 0) | (b != 0)
        if not told.any():
            return float(self.level == other.level and np.array_equal(self.hashes, other.hashes))
        return float(((a == b) & told).sum() / told.sum())


def _fingerprint(hashes: np.ndarray, deep: np.ndarray) -> Fingerprint:
    """``hashes``: sorted distinct term hashes; ``deep``: their rows of :func:`depths`."""
    n = len(hashes)
    level = int(math.log2(2 * n)) if n else 0
    out = np.zeros((LEVELS, SUBSETS), dtype=np.uint16)
    subset, term = np.nonzero((deep >= level).T)
    depth, values = deep[term, subset], _mix(hashes[term])
    for k in range(LEVELS):
        if not len(subset):
            break
        starts = np.flatnonzero(np.r_[True, subset[1:] != subset[:-1]])
        sizes = np.diff(np.r_[starts, len(subset)])
        place = np.arange(len(subset)) - np.repeat(starts, sizes)
        sums = np.add.reduceat(values * _POWERS[place % len(_POWERS)], starts)
        out[k, subset[starts]] = 1 + (_mix(sums) % np.uint64(65535)).astype(np.uint16)
        kept = depth > level + k
        subset, depth, values = subset[kept], depth[kept], values[kept]
    return Fingerprint(level, out)


class Fingerprinter:
    """``common``: hashes of the terms above the band, the rarest first."""

    def __init__(self, lexicon: np.ndarray, common: np.ndarray = np.empty(0, np.uint64)) -> None:
        self.n_lexicon = len(lexicon)
        self.known = np.concatenate([lexicon, common])
        self.deep = depths(self.known)
        self.by_hash = {h: k for k, h in enumerate(self.known.tolist())}
        self.places: dict[str, int] = {}

    def _place(self, term: str) -> int:
        place = self.by_hash.get(term_hash(term), -1)
        if len(self.places) < KEPT_TERMS:
            self.places[term] = place
        return place

    def __call__(self, text: str) -> Fingerprint:
        found = terms(text)
        get = self.places.get
        places = [get(t) for t in found]
        if None in places:
            places = [self._place(t) if p is None else p for t, p in zip(found, places)]
        at = np.array(places, dtype=np.int64)
        at = np.sort(at[at >= 0])
        end = int(np.searchsorted(at, self.n_lexicon))
        missing = math.ceil(SHARE * len(found)) - end
        if missing <= 0:
            return _fingerprint(self.known[at[:end]], self.deep[at[:end]])
        rare = np.unique(np.array([term_hash(t) for t, p in zip(found, places) if p < 0], dtype=np.uint64))[:missing]
        at = at[: end + missing - len(rare)]
        hashes, deep = np.concatenate([self.known[at], rare]), np.concatenate([self.deep[at], depths(rare)])
        order = np.argsort(hashes)
        return _fingerprint(hashes[order], deep[order])


def once(docs: DataFrame) -> tuple[DataFrame, int]:
    """``text`` of every distinct text, null as empty, and their number.

    Only texts whose slot holds a repeated one are shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slot = F.pmod(F.xxhash64("text"), F.lit(SLOTS))
    place = F.pmod(slot, F.lit(64)).cast("int")
    texts = docs.select(text.alias("text"))
    bit = F.when(F.col("n") > 1, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))).otherwise(F.lit(0).cast("long"))
    words = (
        texts.groupBy(F.xxhash64("text").alias("h"), F.floor(slot / 64).alias("word"), place.alias("place"))
        .agg(F.count("*").alias("n"))
        .groupBy("word").agg(F.count("*").alias("texts"), F.bit_or(bit).alias("bits"))
    )
    words = written(words, "repeated-texts")
    # At most SLOTS / 64 rows of two numbers.
    held = F.broadcast(words.where("bits <> 0").select("word", "bits"))
    placed = texts.withColumn("word", F.floor(slot / 64)).withColumn("place", place).join(held, "word", "left")
    again = F.coalesce(F.call_function("getbit", F.col("bits"), F.col("place")), F.lit(0)) == 1
    found = placed.where(~again).select("text").unionByName(placed.where(again).select("text").distinct())
    return found, words.agg(F.sum("texts")).first()[0] or 0


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms in the band, sorted, and of those above it, the rarest first; over distinct texts."""

    def run(batches):
        counts: Counter = Counter()

        def rows():
            hashes = np.fromiter(map(term_hash, counts), np.uint64, len(counts)).view(np.int64)
            numbers = np.fromiter(counts.values(), np.int64, len(counts))
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(numbers)], names=["term", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(terms(text or ""))
                if len(counts) >= COUNTED_TERMS:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    texts, n_texts = once(docs)
    low, high = (n_texts / math.exp(i) for i in reversed(band))
    counted = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= low).toArrow()
    hashes, df = found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy()
    common = df > high
    order = np.lexsort((hashes[common], df[common]))
    return np.sort(hashes[~common]), hashes[common][order]


def with_next(docs: DataFrame, ids: str, parts: int) -> DataFrame:
    """Documents dealt into ranges of ``ids``, sorted, each range closed by the first row of the next.

    Columns: bucket, closing, then those of ``docs``. Only one id per range passes through the driver.
    """
    cuts = sorted(set(docs.stat.approxQuantile(ids, [i / parts for i in range(1, parts)], 1 / (4 * parts))))
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    bucket = F.coalesce(F.size(F.filter(bounds, lambda c: c < F.col(ids))), F.lit(0))
    bucket = F.when(F.col(ids).isNull(), F.lit(0)).otherwise(bucket)
    # Nulls come first: a range whose smallest id is null is headed by the null.
    smallest = F.min(F.struct(F.col(ids).isNotNull(), F.col(ids).alias("id")))["id"]
    heads = sorted((r[0], r[1]) for r in docs.groupBy(bucket.alias("b")).agg(smallest.alias("h")).collect())
    before = [(h, heads[k - 1][0]) for k, (_, h) in enumerate(heads)]
    closing = docs.sparkSession.createDataFrame(before, "head_id long, closes int")
    here = F.struct(bucket.alias("bucket"), F.lit(0).alias("closing"))
    there = F.struct(F.col("closes").alias("bucket"), F.lit(1).alias("closing"))
    copies = F.when(F.col("closes").isNull(), F.array(here)).otherwise(F.array(here, there))
    return (
        # One row per range of ids: bounded by the number of partitions.
        docs.join(F.broadcast(closing), F.col(ids).eqNullSafe(F.col("head_id")), "left")
        .select(F.explode(copies).alias("at"), *docs.columns)
        .select("at.*", *docs.columns)
    )


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the beginning of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    has_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = spark.sparkContext.broadcast(lexicon(docs, band))
    parts = shuffle_partitions(spark)

    def run(batches):
        of = Fingerprinter(*held.value)
        out: list[tuple] = []
        last = None  # bucket, whether closed, doc_id, text, fingerprint

        def judged(row, text, mark):
            _, doc_id, own, own_mark = row
            changed = edited(own, text)
            changed_mark = of(changed)
            sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            return (
                doc_id, len(own), sha, own_mark.text(), changed_mark.text(),
                own_mark.likeness(changed_mark), own_mark.likeness(mark),
            )

        for batch in batches:
            for bucket, closing, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if closing and (last is None or last[0] != bucket):
                    continue  # a second copy of the closing row
                text = text or ""
                mark = of(text)
                if last is not None and last[0] == bucket:
                    out.append(judged(last, text, mark))
                last = None if closing else (bucket, doc_id, text, mark)
                if len(out) == 500:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    rows = with_next(docs, "doc_id", parts).repartition(parts, "bucket")
    return rows.sortWithinPartitions("bucket", "closing", "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def op1_fingerprints(spark, sf_dir):
    """I-Match fingerprints of every document and of its edited text."""
    return fingerprint_documents(read(spark, sf_dir, "documents"))
