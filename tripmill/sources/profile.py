"""Profile of a source file before it is trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.contracts import month_start

CODE_COLUMNS = ("vendorid", "ratecodeid", "payment_type", "store_and_fwd_flag")


def files(spark: SparkSession, path: str) -> DataFrame:
    """Name, size, publication time and row count of each file under ``path``."""
    return (
        spark.read.parquet(path)
        .select("_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_name", "file_size", "file_modification_time")
        .agg(F.count(F.lit(1)).alias("nb_rows"))
    )


def columns(spark: SparkSession, path: str) -> DataFrame:
    """Every column of each file: type, rows, nulls and an example (the smallest value), with the file's size and time.

    One scan: a row per file is aggregated, then turned into a row per column.
    """
    trips = spark.read.parquet(path)
    names = trips.columns
    file = {"_name": "file_name", "_size": "file_size", "_time": "file_modification_time"}
    rows = trips.select(
        *[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)],
        *[F.col(f"_metadata.{of}").alias(alias) for alias, of in file.items()],
    )
    wide = rows.groupBy(*file).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(names))],
        *[F.min(f"c{i}").cast("string").alias(f"v{i}") for i in range(len(names))],
    )
    items = [
        F.struct(
            F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("nb_rows"), (F.col("_rows") - F.col(f"n{i}")).alias("nb_nulls"), F.col(f"v{i}").alias("example"),
        )
        for i, field in enumerate(trips.schema.fields)
    ]
    return wide.select(
        F.col("_name").alias("file_name"), F.col("_size").alias("file_size"), F.col("_time").alias("file_time"),
        F.inline(F.array(*items)),
    )


def code_frequencies(trips: DataFrame, code_columns: Sequence[str] = CODE_COLUMNS) -> DataFrame:
    """Values of the code columns, NULL included, with their frequency; one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("code")) for c in code_columns]
    )
    return (
        trips.select(F.inline(pairs))
        .groupBy("column_name", "code")
        .agg(F.count(F.lit(1)).alias("nb_rows"))
        .orderBy("column_name", "code")
    )


def anomalies(trips: DataFrame, month: str) -> DataFrame:
    """Range of pickup times and counts of suspect rows for the file of ``month``."""
    first_day = F.lit(month_start(month)).cast("timestamp_ntz")
    next_month = F.add_months(F.lit(month_start(month)), 1).cast("timestamp_ntz")
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.agg(
        F.min(pickup).alias("first_pickup"),
        F.max(pickup).alias("last_pickup"),
        F.count_if((pickup < first_day) | (pickup >= next_month)).alias("outside_month"),
        F.count_if(F.col("trip_distance") <= 0).alias("no_distance"),
        F.count_if(F.col("total_amount") < 0).alias("negative_total"),
        F.count_if(dropoff < pickup).alias("dropoff_before_pickup"),
        F.count_if(F.col("passenger_count").isNull()).alias("no_passenger_count"),
    )
