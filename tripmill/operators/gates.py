"""Quality gates: one-row checks that must hold before anything is published."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.contracts import RAW_TRIPS, TRIP_FILE_SCHEMA, ZONE_COUNT, PipelineParams
from tripmill.functions import ratio
from tripmill.operators.rules import rejection_rules
from tripmill.sources.landing import Parts

#: File columns that make a trip's business key; without them copies cannot be told from trips.
KEY_COLUMNS = (
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid", "trip_distance",
    "fare_amount", "total_amount",
)


class GateFailed(RuntimeError):
    """A check returned a value that is false, NULL or zero."""


def month_is_loaded(raw: DataFrame, file_name: str) -> DataFrame:
    present = raw.where(F.col("_source_file") == file_name)
    return present.agg((F.count(F.lit(1)) > 0).alias("month_loaded"))


def trips_are_distinct(enriched: DataFrame, month: date) -> DataFrame:
    """Keys are compared as 16 bytes rather than 32 hexadecimal digits: half the shuffle."""
    rows = F.count(F.lit(1))
    return enriched.where(F.col("source_file_month") == F.lit(month)).agg(
        (rows > 0).alias("month_not_empty"),
        (rows == F.countDistinct(F.unhex("trip_sk"))).alias("no_duplicates"),
    )


def rejection_rate_is_low(flagged: DataFrame, month: date, params: PipelineParams) -> DataFrame:
    """Strictly below the limit; an empty month gives NULL and so fails."""
    rate = ratio(F.count_if(F.col("rejection_reason").isNotNull()), F.count(F.lit(1)))
    return flagged.where(F.col("source_file_month") == F.lit(month)).agg(
        (rate < params.max_rejection_rate).alias("rejection_rate_ok")
    )


def run_gate(check: DataFrame) -> None:
    """Raise unless every value of the check's single row is true."""
    row = check.first()
    if row is None:
        raise GateFailed("the check returned no row")
    pass_gate(row.asDict())


def pass_gate(values: dict[str, object]) -> None:
    """Raise unless every value is true. What a writing job has observed needs no job of its own."""
    failed = {name: value for name, value in values.items() if not value}
    if failed:
        raise GateFailed(f"failed checks: {failed}")


def status_metrics(params: PipelineParams) -> list[Column]:
    """Rows of each status, ``valid`` among them, for ``DataFrame.observe``."""
    reason = F.col("rejection_reason")
    return [
        F.count_if(reason.isNull()).alias("valid"),
        *[F.count_if(reason == rule.reason).alias(rule.reason) for rule in rejection_rules(params)],
    ]


def observed_rejection_rate(statuses: dict[str, int], params: PipelineParams) -> dict[str, object]:
    """``rejection_rate_is_low`` from counts by status."""
    rows = sum(statuses.values())
    rate = (rows - statuses["valid"]) / rows if rows else None
    return {"rejection_rate_ok": None if rate is None else rate < params.max_rejection_rate}


def distinct_metrics(kept: str) -> list[Column]:
    """Rows, and the most rows of one key, of enriched trips with their ``kept`` column."""
    return [F.count(F.lit(1)).alias("rows"), F.max(kept).alias("most")]


def observed_distinct(metrics: dict[str, int | None]) -> dict[str, object]:
    """``trips_are_distinct`` from these metrics."""
    return {"month_not_empty": metrics["rows"] > 0, "no_duplicates": (metrics["most"] or 1) == 1}


def drift(parts: list[Parts], contract: T.StructType = TRIP_FILE_SCHEMA) -> list[Drift]:
    """How the schemas of a landed file's parts differ from the contract, worst first.

    A column that is missing, new or of another type is reported. Only a key column stops the
    month: one that is missing, or whose type cannot be brought to the contract without loss.
    """
    out: dict[tuple, int] = {}
    for part in parts:
        found = {f.name.lower(): f.dataType for f in part.schema.fields}
        for field in contract.fields:
            dtype = found.pop(field.name, None)
            if dtype is None:
                item = (field.name, "missing", None, field.dataType.simpleString(), field.name in KEY_COLUMNS)
            elif dtype != field.dataType:
                stops = field.name in KEY_COLUMNS and not _widens(dtype, field.dataType)
                item = (field.name, "retyped", dtype.simpleString(), field.dataType.simpleString(), stops)
            else:
                continue
            out[item] = out.get(item, 0) + part.nb_rows
        for name, dtype in found.items():
            item = (name, "new", dtype.simpleString(), None, False)
            out[item] = out.get(item, 0) + part.nb_rows
    rows = [Drift(*item, nb_rows) for item, nb_rows in out.items()]
    return sorted(rows, key=lambda d: (not d.stops, d.column_name, d.problem, d.found_type or ""))


class Drift(NamedTuple):
    column_name: str
    problem: str
    found_type: str | None
    expected_type: str | None
    stops: bool
    nb_rows: int


DRIFT_SCHEMA = "column_name string, problem string, found_type string, expected_type string, stops boolean, nb_rows bigint"


def drift_report(spark: SparkSession, parts: list[Parts]) -> DataFrame:
    return spark.createDataFrame(drift(parts), DRIFT_SCHEMA)


def _widens(found: T.DataType, expected: T.DataType) -> bool:
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(expected, T.LongType):
        return isinstance(found, whole)
    if isinstance(expected, T.DoubleType):
        return isinstance(found, (*whole, T.FloatType, T.DecimalType))
    return False


def keys_have_not_drifted(parts: list[Parts]) -> dict[str, object]:
    return {f"{d.column_name}_{d.problem}": False for d in drift(parts) if d.stops}


def contract_problems(raw: DataFrame, contract: T.StructType = RAW_TRIPS) -> list[str]:
    """Differences between a loaded table's schema and its contract."""
    found = {f.name.lower(): f.dataType for f in raw.schema.fields}
    problems = []
    for field in contract.fields:
        dtype = found.get(field.name.lower())
        if dtype is None:
            problems.append(f"missing column {field.name}")
        elif dtype != field.dataType:
            problems.append(
                f"column {field.name} is {dtype.simpleString()}, not {field.dataType.simpleString()}"
            )
    return problems


def load_summary(raw: DataFrame) -> DataFrame:
    """Rows and earliest load time per file."""
    return raw.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("nb_rows"), F.min("_loaded_at").alias("first_loaded_at")
    )


def zones_are_complete(zones: DataFrame, expected: int = ZONE_COUNT) -> DataFrame:
    rows = F.count(F.lit(1))
    return zones.agg(
        (rows == expected).alias("zone_count_ok"),
        (rows == F.countDistinct("locationid")).alias("zone_keys_distinct"),
    )


def amounts_keep_decimals(raw: DataFrame) -> DataFrame:
    """At least one fare and one total have cents; rounding types would lose them all."""
    return raw.agg(
        *[
            (F.count_if(F.col(c) != F.floor(c)) > 0).alias(f"{c}_has_decimals")
            for c in ("fare_amount", "total_amount")
        ]
    )
