"""Line deduplication with levelled sorted runs of line hashes.

Lines of at least ``min_chars`` code points, compared by a key (ASCII white space stripped, A-Z
lower-cased), stay only in the document of the largest doc_id once ``min_docs`` documents hold
them. The documents come in batches of descending doc_id. Each batch is merge-anti-joined with
the runs: keys that no run holds get their holder from this batch, the others only add to the
count of documents. What a batch adds is a run of its own, sorted and bucketed by hash; when a
level has ``fanout`` runs, they are compacted into one run of the next level. All runs have the
same buckets, so that joins and compactions read them without a shuffle.

Keys are hashed to 128 bits. The path is DataFrame functions throughout.

Defined cases: a null or empty text is one empty line; a document is a doc_id, so rows that share
a doc_id count once and keep the line together; a null doc_id is smaller than all others, and
counts as one document that holds a line only if no other does; repeated lines of the holder all
stay; an empty table gives an empty result; other columns are carried as they are.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, shuffle_partitions, written
from tripmill.session import scratch_dir

#: Production parameters.
MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 2
#: What a key loses at both ends.
WHITE = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    # lower() is the quick way where no letter but A-Z can change.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, upper, upper.lower()))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2 of every line that is long enough."""
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .where(F.char_length("line") >= min_chars)
        .withColumn("line", line_key(F.col("line")))
        .where(F.char_length("line") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    )


class LineRuns:
    """Levels of sorted runs: h1, h2, n_docs, holder (null where an earlier run has it), held."""

    def __init__(self, spark, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.folder = scratch_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self._tables: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.write.bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", f"{self.folder}/{name}")
            .format("parquet")
            .saveAsTable(name)
        )
        self._tables.append(name)
        return name

    @staticmethod
    def _counted(lines: DataFrame) -> DataFrame:
        """Documents and holder of each key. Distinct (key, document) pairs lie apart; each task counts its own of them, so
        that a line which all documents hold sends a row per task. By as many partitions as buckets, a bucket is one file."""
        return (
            lines.groupBy(*HASH, "doc_id").agg(F.lit(1).alias("n"))
            .groupBy(*HASH)
            .agg(F.count("n").alias("n_docs"), F.max("doc_id").alias("holder"), F.lit(True).alias("held"))
        )

    def add(self, lines: DataFrame) -> None:
        """One more batch; its doc_ids are below those of all batches before."""
        own = self._counted(lines)
        held = [self.spark.table(t).where("held").select(*HASH) for level in self.levels for t in level]
        if held:
            own = self.spark.table(self._write(own))
            fresh = reduce(lambda rows, run: rows.join(run, HASH, "left_anti"), held, own)
            known = reduce(DataFrame.union, [own.join(run, HASH, "left_semi") for run in held])
            own = fresh.union(
                known.select(*HASH, "n_docs", F.lit(None).cast("long").alias("holder"), F.lit(False).alias("held"))
            )
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.levels[level], merged = [], self._write(self._merged(self.levels[level]))
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def _merged(self, tables: list[str]) -> DataFrame:
        """Runs merged two by two; their buckets meet without a shuffle."""

        def merge(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.select(*HASH, *(F.col(c).alias(f"{c}_2") for c in ("n_docs", "holder", "held")))
            return left.join(right, HASH, "full").select(
                *HASH,
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_docs_2", F.lit(0))).alias("n_docs"),
                F.greatest("holder", "holder_2").alias("holder"),
                F.greatest("held", "held_2").alias("held"),
            )

        return reduce(merge, [self.spark.table(t) for t in tables])

    def close(self, schema) -> DataFrame:
        """All runs as one, read by path; the tables leave the catalog."""
        tables = [t for level in self.levels for t in level]
        final = tables[0] if len(tables) == 1 else self._write(self._merged(tables))
        for name in self._tables:
            self.spark.sql(f"DROP TABLE {name}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{final}")


def _batched(lines: DataFrame, docs: DataFrame, batches: int) -> tuple[DataFrame, int]:
    """Lines with their batch: 0 has the largest doc_ids, the last the smallest and null."""
    cuts = sorted(set(docs.stat.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.001)))
    above = reduce(lambda total, cut: total + (F.col("doc_id") > cut).cast("int"), cuts, F.lit(0))
    return lines.withColumn("batch", F.lit(len(cuts)) - F.coalesce(above, F.lit(0))), len(cuts) + 1


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``row`` (the other columns), ``text`` (what is left), ``n_lines``, ``n_dropped``."""
    has_columns(docs, "doc_id", "text")
    spark, docs = docs.sparkSession, docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    hashed, n = _batched(hashed_lines(docs, min_chars), docs, batches)
    lines = written(hashed, "lines", ["batch"])
    runs = LineRuns(spark, fanout)
    for batch in range(n):
        runs.add(lines.where(F.col("batch") == batch))
    found = runs.close("h1 long, h2 long, n_docs long, holder long, held boolean")
    repeated = found.where(F.col("n_docs") >= min_docs).select(*HASH, "holder")
    dropped = (
        lines.join(repeated, HASH)
        .where(~F.col("doc_id").eqNullSafe(F.col("holder")))
        .groupBy(F.col("doc_id").alias("drop_id"), F.col("text_hash").alias("drop_hash"))
        .agg(F.collect_set("pos").alias("dropped"))
    )
    rest = [c for c in docs.columns if c != "text"]
    split = docs.select(
        F.struct(*rest).alias("row"),
        F.xxhash64("text").alias("text_hash"),
        lines_of(F.col("text")).alias("lines"),
    )
    joined = split.join(
        dropped,
        F.col("row.doc_id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash")),
        "left",
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(
        F.transform(left, lambda i: F.col("lines")[i])
    )
    return joined.select(
        "row",
        F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op3_line_dedup(spark, sf_dir):
    """What line deduplication leaves of every document."""
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_lines", F.greatest("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.holder AS dropped
  FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
