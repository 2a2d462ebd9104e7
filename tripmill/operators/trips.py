"""From labelled trips to the fact: filter, deduplicate, derive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.contracts import BUSINESS_KEY, CARD, ENRICHED_TRIPS, FACT_TRIPS, VENDOR_WITH_FEES_IN_EXTRA
from tripmill.functions import date_key, iso_weekday, key_values, ratio, round_rows, trip_key


def keep_first_copy(trips: DataFrame, kept: str | None = None) -> DataFrame:
    """One row per business key: the earliest loaded copy.

    Copies loaded together are ordered by their remaining columns, so the choice
    is repeatable. Filtering on row number 1 lets Spark drop all but one copy per
    key in each map task, before the shuffle: a key with a third of all rows then
    sends one row per task.

    ``kept`` names a column for the number of rows left of the key, counted where they
    lie: 1, unless this function is wrong. It costs neither a shuffle nor a sort.
    """
    tie_breakers = [c for c in trips.columns if c not in BUSINESS_KEY and c != "loaded_at"]
    # Amounts that differ beyond the tenth decimal make one key; the smallest comes first.
    order = ["loaded_at", *tie_breakers, *BUSINESS_KEY]
    # The key as columns: what is dealt by them once stays dealt. Its hash comes first, so that a sort compares
    # eight bytes and looks at the key only where these are equal.
    key = {f"_key{i}": value for i, value in enumerate(key_values())}
    keyed = trips.withColumns(key).withColumn("_hash", F.xxhash64(*key))
    same = Window.partitionBy("_hash", *key)
    first = keyed.withColumn("_copy", F.row_number().over(same.orderBy(*order))).where("_copy = 1")
    if kept is not None:
        first = first.withColumn(kept, F.count(F.lit(1)).over(same))
    return first.drop("_copy", "_hash", *key)


def valid_trips(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("rejection_reason").isNull())


def enrich_trips(flagged: DataFrame, kept: str | None = None) -> DataFrame:
    """Valid distinct trips with their key and derived measures, and ``kept`` (see ``keep_first_copy``)."""
    distinct = keep_first_copy(valid_trips(flagged).drop("rejection_reason"), kept)
    day = F.col("pickup_at").cast("date")
    minutes, fare = F.col("trip_duration_min"), F.col("fare_amount")
    speed = ratio(F.col("trip_distance_miles"), minutes) * 60
    # Tips are recorded for card payments only.
    tip_rate = F.when(
        (F.col("payment_type_key") == CARD) & (fare > 0),
        round_rows(F.col("tip_amount") / fare * 100, 2),
    )
    derived = distinct.withColumns(
        {
            "trip_sk": trip_key(),
            "pickup_date": day,
            "pickup_date_key": date_key(day),
            "pickup_hour": F.hour("pickup_at"),
            "pickup_day_of_week_iso": iso_weekday(day),
            "is_weekend": iso_weekday(day) >= 6,
            "avg_speed_mph": round_rows(speed, 2),
            "trip_duration_min": round_rows(minutes, 2),
            "tip_rate_pct": tip_rate,
        }
    )
    return derived.select(*ENRICHED_TRIPS.names, *([kept] if kept else []))


def build_fact(enriched: DataFrame) -> DataFrame:
    """Fact rows; one vendor already reports the zone and airport fees in ``extra``."""
    separate_fees = (
        F.col("congestion_surcharge_amount")
        + F.col("airport_fee_amount")
        + F.col("cbd_congestion_fee_amount")
    )
    added = F.when(F.col("vendor_key") == VENDOR_WITH_FEES_IN_EXTRA, F.lit(0.0)).otherwise(separate_fees)
    base = F.col("extra_amount") + F.col("mta_tax_amount") + F.col("improvement_surcharge_amount")
    return enriched.withColumn("surcharges_amount", base + added).select(FACT_TRIPS.names)
