"""Exact medians that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import round_to

# Fine enough that a bin holds few distinct values, coarse enough that the bins of
# one group (some 30 doublings for amounts in cents) stay far below a million.
_BINS_PER_DOUBLING = 16384
# Log2 of every finite double lies within ±1100, so shifted bins keep their sign.
_LOG_RANGE = 1100


def _bin(value: Column) -> Column:
    """Order-preserving bin of a double, about 0.004 % wide; negatives mirror positives."""

    def positive(v: Column) -> Column:
        log = F.least(F.log2(v), F.lit(float(_LOG_RANGE)))
        return F.floor(log * _BINS_PER_DOUBLING) + (_LOG_RANGE * _BINS_PER_DOUBLING + 1)

    return F.when(value > 0, positive(value)).when(value < 0, -positive(-value)).otherwise(F.lit(0))


def join_on_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join two aggregates on their group keys; NULL keys match, as in a group-by."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(Column.__and__, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def exact_medians(
    rows: DataFrame, keys: Sequence[str], measures: dict[str, Column], digits: int | None = None
) -> DataFrame:
    """Median of each measure per group, as the mean of the two middle values.

    Spark's own ``median`` keeps every distinct value of a group in one task. Here
    equal values are counted first, spread over (group, value). Ranks are then
    found in two steps: over bins of the value, whose number is bounded however
    large the group is, and inside the one or two bins holding the middle.
    """
    keys = list(keys)
    unpivoted = rows.select(
        *keys, F.posexplode(F.array(*[m.cast("double") for m in measures.values()])).alias("_m", "_v")
    )
    counted = (
        unpivoted.where(F.col("_v").isNotNull())
        .groupBy(*keys, "_m", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _medians(counted, keys, list(measures), digits)


def medians_of_counts(
    counts: DataFrame, keys: Sequence[str], name: str, value: str, n: str, digits: int | None = None
) -> DataFrame:
    """The same from counts of equal values, which add up over months: the rows themselves are not needed."""
    keys = list(keys)
    counted = (
        counts.where(F.col(value).isNotNull())
        .groupBy(*keys, F.lit(0).alias("_m"), F.col(value).cast("double").alias("_v"))
        .agg(F.sum(n).alias("_n"))
    )
    return _medians(counted, keys, [name], digits)


def _medians(counted: DataFrame, keys: list[str], names: list[str], digits: int | None) -> DataFrame:
    counted = counted.withColumn("_bin", _bin(F.col("_v")))
    group = [*keys, "_m"]
    bins = counted.groupBy(*group, "_bin").agg(F.sum("_n").alias("_in_bin"))
    # A few thousand doublings at most are ordered per group, then the bins of the one or two
    # doublings that hold the middle.
    doublings = bins.withColumn("_wide", F.floor(F.col("_bin") / _BINS_PER_DOUBLING))
    by_doubling = Window.partitionBy(*group).orderBy("_wide")
    whole = by_doubling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.col("_size")
    middle_doublings = (
        doublings.groupBy(*group, "_wide").agg(F.sum("_in_bin").alias("_in_wide"))
        .withColumn("_size", F.sum("_in_wide").over(whole))
        .withColumn("_upto", F.sum("_in_wide").over(by_doubling.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_low", F.floor((size + 1) / 2))
        .withColumn("_high", F.floor(size / 2) + 1)
        .withColumn("_below", F.col("_upto") - F.col("_in_wide"))
        .where("_upto >= _low AND _below < _high")
        .select(*group, "_wide", "_below", "_low", "_high")
    )
    by_bin = Window.partitionBy(*group, "_wide").orderBy("_bin")
    running = by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle_bins = (
        join_on_group(doublings, middle_doublings, [*group, "_wide"], "inner")
        .withColumn("_upto", F.col("_below") + F.sum("_in_bin").over(running))
        .withColumn("_before", F.col("_upto") - F.col("_in_bin"))
        .where("_upto >= _low AND _before < _high")
        .select(*group, "_bin", "_before", "_low", "_high")
    )
    near = join_on_group(counted, middle_bins, [*group, "_bin"], "inner")
    inside = Window.partitionBy(*group, "_bin").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    middle = (
        near.withColumn("_rank_to", F.col("_before") + F.sum("_n").over(inside))
        .where("_rank_to >= _low AND _rank_to - _n < _high")
        .groupBy(*group)
        .agg(((F.min("_v") + F.max("_v")) / 2).alias("_median"))
    )
    columns = []
    for position, name in enumerate(names):
        median = F.max(F.when(F.col("_m") == position, F.col("_median")))
        columns.append((median if digits is None else round_to(median, digits)).alias(name))
    return middle.groupBy(*keys).agg(*columns)
