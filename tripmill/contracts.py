"""Table contracts, code tables and run parameters."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# File names, code tables and zone keys published with the data.
# ---------------------------------------------------------------------------
TRIP_FILE_NAME = "yellow_tripdata_{month}.parquet"
ZONE_FILE_NAME = "taxi_zone_lookup.csv"
FILE_MONTH_PATTERN = "[0-9]{4}-[0-9]{2}"

PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null or unknown"),
]
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]
UNKNOWN_RATE_CODE = 99
CARD = 1
CASH = 2
UNCOLLECTED_PAYMENTS = (3, 4)
VENDOR_WITH_FEES_IN_EXTRA = 1
AIRPORT_NAME_PATTERN = "%airport%"
AIRPORT_BOROUGH = "EWR"
UNKNOWN_ZONES = (264, 265)
ZONE_COUNT = 265
OUTLIER_TOTAL = 500.0
# ---------------------------------------------------------------------------

_INT, _LONG, _DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
_STR, _BOOL, _DATE, _TS = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampNTZType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


# Columns delivered by a monthly trip file. Wide types on purpose: a column may
# be integer one month and fractional the next.
TRIP_FILE_SCHEMA = _schema(
    ("vendorid", _LONG),
    ("tpep_pickup_datetime", _TS),
    ("tpep_dropoff_datetime", _TS),
    ("passenger_count", _LONG),
    ("trip_distance", _DOUBLE),
    ("ratecodeid", _LONG),
    ("store_and_fwd_flag", _STR),
    ("pulocationid", _LONG),
    ("dolocationid", _LONG),
    ("payment_type", _LONG),
    ("fare_amount", _DOUBLE),
    ("extra", _DOUBLE),
    ("mta_tax", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("improvement_surcharge", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("congestion_surcharge", _DOUBLE),
    ("airport_fee", _DOUBLE),
    ("cbd_congestion_fee", _DOUBLE),
)
# The file name is the partition column of the loaded trips, so it comes last.
RAW_TRIPS = T.StructType(
    TRIP_FILE_SCHEMA.fields + _schema(("_loaded_at", _TS), ("_source_file", _STR)).fields
)

ZONE_FILE_SCHEMA = _schema(
    ("locationid", _LONG), ("borough", _STR), ("zone", _STR), ("service_zone", _STR)
)
RAW_ZONES = T.StructType(
    ZONE_FILE_SCHEMA.fields + _schema(("_source_file", _STR), ("_loaded_at", _TS)).fields
)

STAGED_TRIPS = _schema(
    ("vendor_key", _INT),
    ("rate_code_key", _INT),
    ("payment_type_key", _INT),
    ("pickup_zone_key", _INT),
    ("dropoff_zone_key", _INT),
    ("pickup_at", _TS),
    ("dropoff_at", _TS),
    ("passenger_count", _INT),
    ("trip_distance_miles", _DOUBLE),
    ("is_store_and_forward", _BOOL),
    ("fare_amount", _DOUBLE),
    ("extra_amount", _DOUBLE),
    ("mta_tax_amount", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("improvement_surcharge_amount", _DOUBLE),
    ("congestion_surcharge_amount", _DOUBLE),
    ("airport_fee_amount", _DOUBLE),
    ("cbd_congestion_fee_amount", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("source_file", _STR),
    ("source_file_month", _DATE),
    ("loaded_at", _TS),
)

FLAGGED_TRIPS = T.StructType(
    STAGED_TRIPS.fields + _schema(("trip_duration_min", _DOUBLE), ("rejection_reason", _STR)).fields
)

ENRICHED_TRIPS = _schema(
    ("trip_sk", _STR),
    ("vendor_key", _INT),
    ("rate_code_key", _INT),
    ("payment_type_key", _INT),
    ("pickup_zone_key", _INT),
    ("dropoff_zone_key", _INT),
    ("pickup_at", _TS),
    ("dropoff_at", _TS),
    ("pickup_date", _DATE),
    ("pickup_date_key", _INT),
    ("pickup_hour", _INT),
    ("pickup_day_of_week_iso", _INT),
    ("is_weekend", _BOOL),
    ("passenger_count", _INT),
    ("is_store_and_forward", _BOOL),
    ("trip_distance_miles", _DOUBLE),
    ("trip_duration_min", _DOUBLE),
    ("avg_speed_mph", _DOUBLE),
    ("fare_amount", _DOUBLE),
    ("extra_amount", _DOUBLE),
    ("mta_tax_amount", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("improvement_surcharge_amount", _DOUBLE),
    ("congestion_surcharge_amount", _DOUBLE),
    ("airport_fee_amount", _DOUBLE),
    ("cbd_congestion_fee_amount", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("tip_rate_pct", _DOUBLE),
    ("source_file", _STR),
    ("source_file_month", _DATE),
    ("loaded_at", _TS),
)

FACT_TRIPS = _schema(
    ("trip_sk", _STR),
    ("pickup_date_key", _INT),
    ("pickup_zone_key", _INT),
    ("dropoff_zone_key", _INT),
    ("payment_type_key", _INT),
    ("rate_code_key", _INT),
    ("vendor_key", _INT),
    ("pickup_at", _TS),
    ("dropoff_at", _TS),
    ("pickup_date", _DATE),
    ("pickup_hour", _INT),
    ("is_weekend", _BOOL),
    ("passenger_count", _INT),
    ("trip_distance_miles", _DOUBLE),
    ("trip_duration_min", _DOUBLE),
    ("avg_speed_mph", _DOUBLE),
    ("fare_amount", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("surcharges_amount", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("tip_rate_pct", _DOUBLE),
    ("source_file", _STR),
    ("source_file_month", _DATE),
    ("loaded_at", _TS),
)

# One trip is one combination of these columns, in this order wherever they are compared or hashed.
BUSINESS_KEY = [
    "vendor_key",
    "pickup_at",
    "dropoff_at",
    "pickup_zone_key",
    "dropoff_zone_key",
    "trip_distance_miles",
    "fare_amount",
    "total_amount",
]


@dataclass(frozen=True)
class PipelineParams:
    """Thresholds and calendar range of a run; defaults are the production values."""

    max_trip_distance_miles: float = 100
    max_trip_duration_min: float = 180
    start_month: date = date(2025, 1, 1)
    end_month: date = date(2025, 4, 1)
    max_rejection_rate: float = 0.15
    # Proposed extra rule, off unless a ceiling is given.
    max_total_amount: float | None = None


_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def check_month(month: str) -> str:
    """Return ``month`` if it is a valid ``YYYY-MM`` text, else raise."""
    if not isinstance(month, str) or not _MONTH.fullmatch(month):
        raise ValueError(f"month must look like YYYY-MM, got {month!r}")
    return month


def month_start(month: str) -> date:
    return date.fromisoformat(f"{check_month(month)}-01")


def check_in_calendar(month: str, params: PipelineParams) -> str:
    """Return ``month`` if the run's calendar covers it, else raise: its trips would join no day."""
    if not params.start_month <= month_start(month) < params.end_month:
        raise ValueError(
            f"month {month} is outside the calendar from {params.start_month} to before {params.end_month}"
        )
    return month


def trip_file_name(month: str) -> str:
    return TRIP_FILE_NAME.format(month=check_month(month))
