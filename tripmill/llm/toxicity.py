"""Counterfactual-regularised toxicity classifier.

Logistic regression over the distinct words of a text, with weights kept sparse (FTRL-proximal,
L1 and L2). For every labelled text with identity terms a counterfactual is made by swapping
each for another term of its group; the squared change of the logit is penalised, so a term
of a group mentioned in toxic texts earns no weight of its own and neutral mentions score low.

The model is fitted on at most ``TRAIN_DOCUMENTS`` labelled documents, those of the smallest hash of
doc_id; what is scored is every document, whole. Labels are read only from rows whose
crc32(doc_id as text) mod 5 is not 0. A score depends on the text alone.

Defined cases: a null or empty text gets the score of a text without known words; a null doc_id
counts as held out; documents that share a doc_id are scored each; a document with several labels
is toxic if one says so, labels other than 0 and 1 and null are ignored; without usable labels all scores are
0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import give_back, has_columns, lean, read

#: Production parameters. TRAIN_DOCUMENTS bounds what is learnt from, in documents.
TRAIN_DOCUMENTS, EPOCHS, MINI_BATCH = 12_000, 30, 64
ALPHA, L1, L2, COUNTERFACTUAL = 0.5, 0.1, 0.05, 4.0
FOLDS, THRESHOLD = 5, 0.5
#: Weight of a toxic document in the fit: they are few.
TOXIC_WEIGHT = 2.0
#: A word is a feature if its counts by label differ by this log-likelihood ratio (p below 10^-6).
MIN_RATIO = 25.0
KEPT_WORDS = 100_000
#: Identity terms by group; a term is swapped for the next of its group.
IDENTITY = {
    "gender": "men women",
    "gender_one": "man woman",
    "religion": "christian muslim jewish hindu buddhist atheist",
    "religions": "christians muslims jews hindus buddhists atheists",
    "orientation": "gay straight lesbian bisexual",
    "colour": "black white asian latino",
    "age": "young old",
    "gender_fr": "hommes femmes",
    "religion_fr": "chrétiens musulmans juifs",
    "gender_de": "männer frauen",
    "religion_de": "christen muslime juden",
    "gender_es": "hombres mujeres",
    "religion_es": "cristianos musulmanes judíos",
}
_WORD = re.compile(r"\w+")


def swaps(groups: dict[str, str] = IDENTITY) -> dict[str, str]:
    out = {}
    for terms in map(str.split, groups.values()):
        out |= dict(zip(terms, [*terms[1:], terms[0]]))
    return out


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def hashes(some: set[str]) -> np.ndarray:
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some)))


def held_out(doc_id: Column) -> Column:
    key = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == 0


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        self.rows = rows

    def logits(self, weights: np.ndarray, which: range) -> np.ndarray:
        return np.array([weights[self.rows[i]].sum() for i in which])

    def gradient(self, factors: np.ndarray, which: range, size: int) -> np.ndarray:
        some = [self.rows[i] for i in which]
        return np.bincount(
            np.concatenate(some) if some else [], np.repeat(factors, [len(r) for r in some]), minlength=size
        )


def _telling(samples: list[tuple]) -> np.ndarray:
    """Words whose share of documents differs between the labels beyond chance."""
    n = np.array([sum(s[0] == y for s in samples) for y in (0, 1)], dtype=float)
    if not n.all():
        return np.empty(0, np.uint64)
    known, counts = np.unique(np.concatenate([s[1] for s in samples]), return_counts=True)
    toxic = np.zeros(len(known))
    for label, row, _ in samples:
        if label == 1:
            toxic[np.searchsorted(known, row)] += 1
    ratio = np.zeros(len(known))
    with np.errstate(divide="ignore", invalid="ignore"):
        for seen, of in ((toxic, n[1]), (counts - toxic, n[0])):
            for observed, expected in ((seen, counts * of / n.sum()), (of - seen, of - counts * of / n.sum())):
                ratio += 2 * np.where(observed > 0, observed * np.log(observed / expected), 0)
    return known[ratio >= MIN_RATIO]


def fit(
    samples: list[tuple[int, np.ndarray, np.ndarray | None]], counterfactual: float = COUNTERFACTUAL
) -> dict[int, float]:
    """Weights by word hash, 0 for the intercept, from (label, words, words of the counterfactual)."""
    if not samples:
        return {}
    known = _telling(samples)
    size = len(known) + 1

    def places(row: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, row)
        at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == row)] if len(known) else at[:0]
        return np.r_[0, at + 1]

    labels = np.array([s[0] for s in samples], dtype=float)
    rows = Rows([places(s[1]) for s in samples])
    others = Rows([places(s[2] if s[2] is not None else s[1]) for s in samples])
    swapped = np.array([s[2] is not None for s in samples])
    z, n, weights = np.zeros(size), np.zeros(size), np.zeros(size)
    penalty = np.full(size, L1)
    penalty[0] = 0.0
    for _ in range(EPOCHS):
        for start in range(0, len(samples), MINI_BATCH):
            batch = range(start, min(start + MINI_BATCH, len(samples)))
            part = slice(batch.start, batch.stop)
            logit = rows.logits(weights, batch)
            wrong = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]
            wrong *= np.where(labels[part] == 1, TOXIC_WEIGHT, 1.0)
            gradient = rows.gradient(wrong, batch, size)
            if swapped[part].any() and counterfactual:
                change = 2 * counterfactual * (logit - others.logits(weights, batch))
                gradient += rows.gradient(change, batch, size) - others.gradient(change, batch, size)
            more = n + gradient**2
            z += gradient - (np.sqrt(more) - np.sqrt(n)) / ALPHA * weights
            n = more
            weights = -np.sign(z) * np.maximum(np.abs(z) - penalty, 0) / (L2 + np.sqrt(n) / ALPHA)
    kept = np.flatnonzero(weights[1:]) + 1
    return {0: float(weights[0])} | {int(known[k - 1]): float(weights[k]) for k in kept}


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS, counterfactual: float = COUNTERFACTUAL) -> dict[int, float]:
    """Weights from at most ``most`` labelled documents outside the held-out fold, one text for each doc_id."""
    has_columns(labels, "doc_id", "toxic")
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(most)
    )
    # At most ``most`` rows of two numbers. Of rows that share a doc_id, each task sends on the text of the smallest hash.
    text = F.col("text").cast("string")
    sample = (
        docs.select("doc_id", text.alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .groupBy("label", "labelled")
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
        .select("label", "labelled", "least.text")
    )

    def run(batches):
        turn = swaps()
        for batch in batches:
            own, other = [], []
            for text in batch.column(2).to_pylist():
                found = words(text or "")
                own.append(hashes(found).tobytes())
                hit = found & turn.keys()
                other.append(hashes((found - hit) | {turn[w] for w in hit}).tobytes() if hit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.binary()), pa.array(other, pa.binary())],
                names=["label", "labelled", "own", "other"],
            )

    found = sample.mapInArrow(lean(run), "label int, labelled long, own binary, other binary").toArrow().to_pylist()
    # The order is that of a hash, so that it follows neither ids nor partitions.
    found.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r["labelled"])), r["own"]))
    arrays = [(r["label"], *(None if v is None else np.frombuffer(v, np.uint64) for v in (r["own"], r["other"]))) for r in found]
    return fit(arrays, counterfactual)


class Scorer:
    def __init__(self, weights: dict[int, float]) -> None:
        self.weights, self.start = weights, weights.get(0, -math.inf)
        self.known: dict[str, float] = {}

    def __call__(self, text: str) -> float:
        total, known = self.start, self.known
        for word in words(text):
            weight = known.get(word)
            if weight is None:
                weight = self.weights.get(xxhash.xxh3_64_intdigest(word), 0.0)
                if len(known) < KEPT_WORDS:
                    known[word] = weight
            total += weight
        return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def score_documents(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """``row`` (a struct of all columns, whatever they are called) and ``score``."""
    has_columns(docs, "text")
    held = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Scorer(held.value)
        try:
            for texts in series:
                yield pd.Series([of(t or "") for t in texts], dtype="float64")
        finally:
            del of
            give_back()

    return docs.select(F.struct(*docs.columns).alias("row"), score(F.col("text").cast("string")).alias("score"))


def op5_toxicity(spark, sf_dir):
    """Toxicity of every document by a model that never saw the held-out fold's labels."""
    docs = read(spark, sf_dir, "documents")
    weights = train(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), weights).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
