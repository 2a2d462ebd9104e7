"""From documents to packed training sequences: filter, deduplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes what a stage returns and reads it again for the next.

Defined cases: a null or empty text is scored as a text without known words, has one empty line (a null text comes out of the second
stage as an empty one), is near nothing, contains no benchmark item, and is packed as its end id; so it is kept throughout.
Rows repeated with equal doc_id and text count as one document in the line counts, and one of them
survives the third stage if it has words; rows that share a doc_id with different texts are documents each. A null doc_id is
smaller than all others. Of a group of near copies the smallest doc_id stays; ties go by the text's hash. Texts of any
length go through whole. Other columns of the documents are carried up to the last stage, whatever they are called.
Empty tables (documents, labels, benchmark) give an empty result or drop nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from tripmill.llm.common import read, written
from tripmill.llm.tokens import vocabulary_path

#: Near duplicates: words of a shingle and least likeness in hundredths.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold."""
    weights = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, weights).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many hold; n_chars follows the text."""
    rows = line_dedup.dedup_lines(docs).select("row.*", "text")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_per_group(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence."""
    return packing.pack_documents(docs, vocabulary_path()).drop("copy")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), name)
    return rows
