"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(rows: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``rows`` as a table in the shared scratch folder, read back.

    Cuts the lineage: what follows survives lost executors without recomputing it.
    """
    spark = rows.sparkSession
    path = f"{scratch_dir(spark, label)}/{label}"
    rows.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: list[str], order: list[Column], key: Column, buckets: int, name: str) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... within each group, without gathering a group.

    Rows of a group are dealt into ``buckets`` by the hash of ``key``; counts per bucket give
    where each bucket starts, and only a bucket is ordered in one task.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys)
        .count()
        .select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(starts, keys)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_bucket", "_inside", "_start")
    )


def give_back() -> None:
    """Memory that a finished task has freed goes back to the system: Python workers live on, stage after stage."""
    gc.collect()
    trim()


def trim() -> None:
    """The same without a search for cycles, for the end of a large group."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's library can
        ctypes.CDLL(None).malloc_trim(0)


#: Parameters of the C library's ``mallopt``, and what its thresholds rise to by themselves.
_TRIM_THRESHOLD, _MMAP_THRESHOLD, _HIGHEST = -1, -3, 1 << 25


def roomy(run: Callable) -> Callable:
    """A function of one argument, during which freed memory stays with the process for its next arrays, whose pages would
    all be mapped anew; at its end the memory goes back."""

    def inner(given):
        with contextlib.suppress(OSError, AttributeError):
            library = ctypes.CDLL(None)
            library.mallopt(_MMAP_THRESHOLD, _HIGHEST)
            library.mallopt(_TRIM_THRESHOLD, 1 << 30)
        try:
            return run(given)
        finally:
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).mallopt(_TRIM_THRESHOLD, 2 * _HIGHEST)
            trim()

    return inner


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that gives its memory back at the end of a task."""

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def has_columns(rows: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in rows.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing: {json.dumps(rows.columns)}")
