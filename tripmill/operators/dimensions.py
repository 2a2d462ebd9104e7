"""Calendar, zone and code dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.contracts import (
    AIRPORT_BOROUGH,
    AIRPORT_NAME_PATTERN,
    PAYMENT_TYPES,
    RATE_CODES,
    UNKNOWN_ZONES,
    VENDORS,
)
from tripmill.functions import date_key, iso_weekday


def _describe_days(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week_iso"),
        F.dayname(day).alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
    )


def calendar(spark: SparkSession, start_month: date, end_month: date) -> DataFrame:
    """One row per day from ``start_month`` up to, not including, ``end_month``."""
    if end_month <= start_month:
        raise ValueError("end_month must be after start_month")
    bounds = spark.range(1).select(
        F.lit(start_month).cast("date").alias("first_day"), F.lit(end_month).cast("date").alias("end_day")
    )
    every_day = F.sequence("first_day", F.date_sub("end_day", 1))
    return _describe_days(bounds.select(F.explode(every_day).alias("full_date")))


def dim_zone(
    zones: DataFrame,
    airport_pattern: str = AIRPORT_NAME_PATTERN,
    airport_borough: str = AIRPORT_BOROUGH,
    unknown_zones: tuple[int, ...] = UNKNOWN_ZONES,
) -> DataFrame:
    is_airport = F.col("zone_name").ilike(airport_pattern) | (F.col("borough") == airport_borough)
    return zones.select(
        "zone_key",
        "zone_name",
        "borough",
        "service_zone",
        is_airport.alias("is_airport"),
        F.col("zone_key").isin(*unknown_zones).alias("is_unknown_zone"),
    )


def _code_table(spark: SparkSession, codes: list[tuple[int, str]], key: str, label: str) -> DataFrame:
    rows = ", ".join(f"({code}, '{text}')" for code, text in codes)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({key}, {label})")


def payment_types(spark: SparkSession) -> DataFrame:
    return _code_table(spark, PAYMENT_TYPES, "payment_type_key", "payment_type_label")


def rate_codes(spark: SparkSession) -> DataFrame:
    return _code_table(spark, RATE_CODES, "rate_code_key", "rate_code_label")


def vendors(spark: SparkSession) -> DataFrame:
    return _code_table(spark, VENDORS, "vendor_key", "vendor_name")
