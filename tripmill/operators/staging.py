"""Renaming and typing of loaded rows; every row is kept."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.contracts import UNKNOWN_RATE_CODE
from tripmill.functions import file_month


def _int(raw: str) -> Column:
    """A code beyond 32 bits is none: it becomes NULL instead of stopping the month."""
    return F.col(raw).try_cast("int")


def _amount(raw: str) -> Column:
    return F.col(raw).cast("double")


def _fee(raw: str) -> Column:
    """Fees absent from older files count as zero; other amounts stay NULL."""
    return F.coalesce(_amount(raw), F.lit(0.0))


def stage_trips(raw: DataFrame, month: date | None = None) -> DataFrame:
    """All loaded trips, or those of one file month.

    The month is read from the file name, the partition column of the loaded trips,
    so asking for one month prunes the other files and needs no work per row.
    """
    named_month = file_month(F.col("_source_file"))
    if month is not None:
        raw = raw.where(named_month == F.lit(month))
    columns = {
        "vendor_key": _int("vendorid"),
        "rate_code_key": F.coalesce(_int("ratecodeid"), F.lit(UNKNOWN_RATE_CODE)),
        "payment_type_key": _int("payment_type"),
        "pickup_zone_key": _int("pulocationid"),
        "dropoff_zone_key": _int("dolocationid"),
        "pickup_at": F.col("tpep_pickup_datetime"),
        "dropoff_at": F.col("tpep_dropoff_datetime"),
        "passenger_count": _int("passenger_count"),
        "trip_distance_miles": _amount("trip_distance"),
        "is_store_and_forward": F.col("store_and_fwd_flag") == "Y",
        "fare_amount": _amount("fare_amount"),
        "extra_amount": _amount("extra"),
        "mta_tax_amount": _amount("mta_tax"),
        "tip_amount": _amount("tip_amount"),
        "tolls_amount": _amount("tolls_amount"),
        "improvement_surcharge_amount": _amount("improvement_surcharge"),
        "congestion_surcharge_amount": _fee("congestion_surcharge"),
        "airport_fee_amount": _fee("airport_fee"),
        "cbd_congestion_fee_amount": _fee("cbd_congestion_fee"),
        "total_amount": _amount("total_amount"),
        "source_file": F.col("_source_file"),
        "source_file_month": named_month if month is None else F.lit(month),
        "loaded_at": F.col("_loaded_at"),
    }
    return raw.select([expr.alias(name) for name, expr in columns.items()])


def stage_zones(raw: DataFrame) -> DataFrame:
    return raw.select(
        _int("locationid").alias("zone_key"),
        F.col("zone").alias("zone_name"),
        "borough",
        "service_zone",
        F.col("_source_file").alias("source_file"),
        F.col("_loaded_at").alias("loaded_at"),
    )
