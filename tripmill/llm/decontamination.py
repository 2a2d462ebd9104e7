"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

A document is contaminated by an item when it holds at least ``threshold`` of the item's distinct
five-word shingles. Jaccard MinHash cannot see a short item in a long document, so the sketch is
made of the item alone: the shingles of the smallest hashes, probed in the documents. Items are
partitioned by size (powers of two); a partition whose items have at most u shingles keeps
2 * floor((1 - threshold) * u) + 2 of them. An item of n shingles that a document contains can miss
at most floor((1 - threshold) * n), so at least the rest of its sketch is found: candidates are
lossless. Documents too small for an item are left out by size. Candidates are verified on the
exact shingles.

The path is DataFrame functions throughout. Sketches are broadcast only while they have at most
``BROADCAST_ROWS`` rows; beyond, Spark joins them by shuffle.

An item of fewer words than a shingle is one shingle of all its words: documents are probed with
shingles of that size as well, for the sizes that occur among the items. ``ORACLE`` has no such items.

Words are runs of characters other than space and U+0009 to U+000D, lower-cased.

Defined cases: a null text has no words; an item without words is found nowhere;
items that share an item_id are searched each and reported by the largest containment; rows that share
doc_id and text are judged alike, and nulls in doc_id or item_id are values like others; an empty table of documents
or items gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, written

#: Production parameters.
SHINGLE, THRESHOLD, BROADCAST_ROWS = 5, 0.8, 1_000_000
WHITE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often and in whichever lambdas it is used."""
    return F.transform(F.array(value), use)[0]


def shingles_of(words: Column, size: int | Column = SHINGLE) -> Column:
    """Distinct shingles in their places; none of fewer words than ``size``."""
    size = F.lit(size)

    def distinct(known: Column) -> Column:
        last = F.size(known) - size
        all_of = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.concat_ws(" ", F.slice(known, i + 1, size)),
        )
        return F.when(last >= 0, F.array_distinct(all_of)).otherwise(F.array().cast("array<string>"))

    return once(words, distinct)


def _hash(shingle: Column) -> Column:
    return F.xxhash64(shingle)


def item_shingles(items: DataFrame) -> DataFrame:
    """key, item_id, size (words of a shingle), shingles, n, missing (how many may be absent)."""
    has_columns(items, "item_id", "text")
    rows = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("size", F.least(F.size("words"), F.lit(SHINGLE))).where("size > 0")
    rows = rows.select("item_key", "item_id", "size", shingles_of(F.col("words"), F.col("size")).alias("shingles"))
    n = F.size("shingles")
    return (
        rows.dropDuplicates(["item_key"])
        .withColumn("n", n)
        .withColumn("missing", F.floor(F.round((1 - F.lit(THRESHOLD)) * n, 9)).cast("int"))
    )


def sketches(items: DataFrame) -> DataFrame:
    """A row per sketch element: item_key, h, least (elements that must be found), least_size."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    size = (2 * F.floor((1 - F.lit(THRESHOLD)) * upper) + 2).cast("int")
    hashes = F.array_sort(F.array_distinct(F.transform("shingles", _hash)))
    rows = items.select(
        "item_key", "n", "missing", F.slice(hashes, F.lit(1), F.least(size, F.size(hashes))).alias("sketch")
    )
    least = F.greatest(F.size("sketch") - F.col("missing"), F.lit(1))
    return rows.select(
        "item_key", least.alias("least"), (F.col("n") - F.col("missing")).alias("least_size"), F.explode("sketch").alias("h")
    )


def candidates(docs: DataFrame, items: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, item_key of documents that hold enough of the sketch of an item with shingles of ``size``."""
    probes = written(sketches(items.where(F.col("size") == size)), "sketches")
    if probes.count() <= BROADCAST_ROWS:
        probes = F.broadcast(probes)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    # Hashes are made and probed row by row inside one generated loop; no row of a shingle is written.
    places = words.where(F.size("words") >= size).select(
        "doc_id", "text_hash", "words", (F.size("words") - size + 1).alias("size"),
        F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("i"),
    )
    shingle = F.concat_ws(" ", *(F.col("words")[F.col("i") + k] for k in range(size)))
    found = (
        places.select("doc_id", "text_hash", "size", _hash(shingle).alias("h"))
        .join(probes, "h")
        .where(F.col("size") >= F.col("least_size"))
    )
    pair = ["doc_id", "text_hash", "item_key"]
    return (
        found.groupBy(*pair, "h").agg(F.first("least").alias("least"))
        .groupBy(*pair).agg(F.count("*").alias("hits"), F.first("least").alias("least"))
        .where(F.col("hits") >= F.col("least"))
        .select(*pair)
    )


def searched(docs: DataFrame, benchmark: DataFrame, how: str) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``matches``: verified (item_id, n_item, n_shared).

    ``how`` "left" keeps all documents, "inner" those with candidates.
    """
    has_columns(docs, "doc_id", "text")
    items = written(item_shingles(benchmark), "item-shingles")
    # One size where all items are long, at most SHINGLE of them.
    sizes = sorted(r[0] for r in items.select("size").distinct().collect()) or [SHINGLE]
    pairs = reduce(DataFrame.unionByName, [candidates(docs.select("doc_id", "text"), items, k) for k in sizes])
    near = (
        pairs.join(items, "item_key")
        .groupBy(F.col("doc_id").alias("near_id"), F.col("text_hash").alias("near_hash"))
        .agg(F.collect_list(F.struct("item_id", "shingles", "n", "missing")).alias("near"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("row_hash")).join(
        near, F.col("row.doc_id").eqNullSafe(F.col("near_id")) & (F.col("row_hash") == F.col("near_hash")), how
    )

    def judged(own: Column) -> Column:
        return F.transform(
            "near",
            lambda p: F.struct(
                p["item_id"].alias("item_id"), p["n"].alias("n_item"), p["missing"].alias("missing"),
                F.size(F.array_intersect(p["shingles"], own)).alias("n_shared"),
            ),
        )

    # Only documents with candidates are cut into shingles again.
    # Shingles of different sizes are never equal.
    own = once(words_of(F.col("row.text")), lambda words: F.concat(*(shingles_of(words, k) for k in sizes)))
    shared = F.when(F.col("near").isNotNull(), once(own, judged))
    kept = F.filter(shared, lambda p: p["n_shared"] >= p["n_item"] - p["missing"])
    return rows.select("row", kept.alias("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item."""
    clean = F.coalesce(F.size("matches"), F.lit(0)) <= 0
    return searched(docs, benchmark, "left").where(clean).select("row.*")


def op6_decontamination(spark, sf_dir):
    """Documents and the benchmark items that they contain."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = searched(docs, read(spark, sf_dir, "benchmark"), "inner")
    return (
        found.select(F.col("row.doc_id").alias("doc_id"), F.explode("matches").alias("m"))
        .groupBy("doc_id", F.col("m.item_id").alias("item_id"))
        .agg(F.max(F.struct((F.col("m.n_shared") / F.col("m.n_item")).alias("c"), "m.n_item", "m.n_shared")).alias("best"))
        .select(
            "doc_id", "item_id", F.col("best.n_item").cast("long").alias("n_item"),
            F.col("best.n_shared").cast("long").alias("n_shared"), F.col("best.c").alias("containment"),
        )
    )


_SHINGLES = """
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (
    SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM (
      SELECT {id} AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS w FROM {table}))"""
ORACLE = f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
sizes AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM d JOIN b USING (s) JOIN sizes ON sizes.id = b.id
GROUP BY d.id, b.id HAVING 10 * count(*) >= 8 * any_value(n)
"""
