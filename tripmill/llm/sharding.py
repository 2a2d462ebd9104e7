"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. On each level every child draws an exponential number
with the child's weight as its rate, hashed from the key and the child's place in the tree, and
the smallest draw wins. A child's draw depends on nothing but the key, its place and its weight:
when a weight changes, rows move only into or out of the subtree below it.

A shard added to a planned tree opens a branch of its own at the root, so that it takes rows only
into itself and no other shards exchange rows.

Defined cases: a null key hashes like any other value, so all null keys share a shard; rows with
equal keys share a shard; a null text has no bytes; an empty table gives an empty result; columns
other than the key are carried and never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, numbered

#: Production parameters: shards of the planned tree, its regions, racks in a region.
SHARDS, REGIONS, RACKS = 24, 2, 3
#: Buckets in which the rows of a shard get their slots.
SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Tree:
    """``leaves[region][rack]``: (shard, weight) pairs."""

    leaves: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    def grown(self, shard: int, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region and a rack of its own."""
        return Tree((*self.leaves, (((shard, weight),),)))

    def weights(self) -> tuple[list, list, list]:
        """Weights by region, by region and rack, by region, rack and shard."""
        shards = [[[w for _, w in rack] for rack in region] for region in self.leaves]
        racks = [[sum(rack) for rack in region] for region in shards]
        return [sum(region) for region in racks], racks, shards


def planned_tree(shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """``shards`` of weight 1, dealt in order over regions and racks as evenly as possible."""

    def deal(items: list, parts: int) -> list[list]:
        cut = [round(i * len(items) / parts) for i in range(parts + 1)]
        return [items[a:b] for a, b in zip(cut, cut[1:]) if a < b]

    return Tree(
        tuple(
            tuple(tuple((s, 1.0) for s in rack) for rack in deal(region, racks))
            for region in deal(list(range(shards)), regions)
        )
    )


def _literal(value) -> Column:
    return F.array(*map(_literal, value)) if isinstance(value, (list, tuple)) else F.lit(value)


def _draw(key: Column, level: str, path: list[Column], weights: Column) -> Column:
    """Position of the child of the smallest draw; ``weights`` has a number per child."""

    def score(weight: Column, child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), *path, child, key), 11)
        unit = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(unit) / weight).alias("draw"), child.alias("child"))

    return F.array_min(F.transform(weights, score))["child"]


def assign(rows: DataFrame, tree: Tree, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``rows`` with the shard of each."""
    has_columns(rows, key)
    by_region, by_rack, by_shard = (_literal(w) for w in tree.weights())
    ids = _literal([[[s for s, _ in rack] for rack in region] for region in tree.leaves])
    at = F.col(key)
    region, rack, leaf = F.col("_region"), F.col("_rack"), F.col("_leaf")
    return (
        rows.withColumn("_region", _draw(at, "region", [], by_region))
        .withColumn("_rack", _draw(at, "rack", [region], by_rack[region]))
        .withColumn("_leaf", _draw(at, "shard", [region, rack], by_shard[region][rack]))
        .withColumn(name, ids[region][rack][leaf])
        .drop("_region", "_rack", "_leaf")
    )


def shard_documents(docs: DataFrame, tree: Tree, slot_buckets: int = SLOT_BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32, shard and gapless slot of every document.

    The size is the UTF-8 bytes of the text plus 8. Slots follow a hash of doc_id, then doc_id.
    """
    has_columns(docs, "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return numbered(assign(rows, tree), ["shard"], order, F.col("doc_id"), slot_buckets, "slot")


def op10_sharding(spark, sf_dir):
    """Every document in one of 24 shards under the law ``key``, and its shard of 25."""
    from tripmill.llm.common import read

    tree = planned_tree()
    placed = shard_documents(read(spark, sf_dir, "documents"), tree)
    return assign(placed, tree.grown(SHARDS), name="grown_shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard",
    )
