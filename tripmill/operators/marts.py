"""Published marts.

The marts cover all months, but a run changes one. Each month therefore keeps
small partial aggregates (sums and counts that add up, bitmaps of days that can be
united, counts of equal fares); the marts and the busiest cells are made
from these and never scan the fact again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.contracts import CARD, CASH
from tripmill.functions import average, ratio, round_to
from tripmill.operators.analyses import is_collected

# Grain of the partial aggregates of the fact.
CELL_KEYS = [
    "pickup_zone_key",
    "pickup_date",
    "pickup_date_key",
    "pickup_hour",
    "is_weekend",
    "payment_type_key",
    "is_collected",
    "source_file_month",
]
# Fact measure -> name used in the partial sums.
_SUMMED = {
    "total_amount": "total",
    "fare_amount": "fare",
    "tip_amount": "tip",
    "surcharges_amount": "surcharges",
    "trip_distance_miles": "distance",
    "trip_duration_min": "duration",
    "avg_speed_mph": "speed",
    "tip_rate_pct": "tip_rate",
}


def trip_cells(fact: DataFrame) -> DataFrame:
    """Sums and non-NULL counts per zone, day, hour, payment type and whether the amount counts as collected."""
    sums = [F.sum(column).alias(f"{name}_sum") for column, name in _SUMMED.items()]
    counts = [F.count(column).alias(f"{name}_n") for column, name in _SUMMED.items()]
    marked = fact.withColumn("is_collected", F.coalesce(is_collected(), F.lit(False)))
    return marked.groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("trips"), *sums, *counts)


def _added(*names: str) -> list[Column]:
    """Sums of what cells and partials have summed and counted."""
    parts = [f"{name}_{kind}" for name in names for kind in ("sum", "n")]
    return [F.sum(part).alias(part) for part in ["trips", *parts]]


def daily_partials(cells: DataFrame) -> DataFrame:
    """Per day and payment type of a month."""
    return cells.groupBy("pickup_date_key", "payment_type_key", "source_file_month").agg(
        *_added("total", "fare", "tip", "surcharges", "distance")
    )


def _day() -> Column:
    return F.unix_date("pickup_date")


def _with_days(*keys: str) -> list[Column]:
    """Grouping columns of a partial, the days' bitmap bucket (89 years) among them."""
    return [*map(F.col, keys), F.bitmap_bucket_number(_day()).alias("day_bucket")]


def _days() -> Column:
    """The days with a trip, a bit for each, so that months can be united."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(_day())).alias("days")


def demand_partials(cells: DataFrame) -> DataFrame:
    """Per zone, hour and weekend flag of a month; however many days, one row."""
    keys = _with_days("pickup_zone_key", "pickup_hour", "is_weekend", "source_file_month")
    return cells.groupBy(*keys).agg(_days(), *_added("total", "fare", "distance", "duration", "speed", "tip_rate"))


def collected_partials(cells: DataFrame) -> DataFrame:
    """Collected trips per zone and hour of a month, card and cash apart."""

    def total_of(payment: int, name: str) -> list[Column]:
        paid = F.col("payment_type_key") == payment
        parts = {"trips": "trips", "sum": "total_sum", "n": "total_n"}
        return [F.coalesce(F.sum(F.when(paid, F.col(part))), F.lit(0)).alias(f"{name}_{kind}") for kind, part in parts.items()]

    keys = _with_days("pickup_zone_key", "pickup_hour", "source_file_month")
    return cells.where("is_collected").groupBy(*keys).agg(
        _days(), *_added("fare", "total"), *total_of(CARD, "card"), *total_of(CASH, "cash")
    )


def fare_counts(fact: DataFrame) -> DataFrame:
    """Collected trips per zone, hour and fare of a month: medians come from these, added up."""
    return fact.where(is_collected() & F.col("fare_amount").isNotNull()).groupBy(
        "pickup_zone_key", "pickup_hour", "fare_amount", "source_file_month"
    ).agg(F.count(F.lit(1)).alias("trips"))


def daily_revenue(cells: DataFrame, dim_date: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Day × payment label, from cells or daily partials. Days outside the calendar are left out; a payment code
    without a label stays, with a NULL label."""
    per_day = cells.groupBy("pickup_date_key", "payment_type_key").agg(
        F.sum("trips").alias("trips"),
        *[
            F.sum(f"{name}_{kind}").alias(f"{name}_{kind}")
            for name in ("total", "fare", "tip", "surcharges", "distance")
            for kind in ("sum", "n")
        ],
    )
    days = dim_date.select("date_key", "full_date", "day_name", "is_weekend")
    return (
        per_day.join(days, per_day.pickup_date_key == days.date_key)
        .join(dim_payment, "payment_type_key", "left")
        .groupBy("full_date", "day_name", "is_weekend", "payment_type_label")
        .agg(
            F.sum("trips").alias("nb_trips"),
            round_to(F.sum("total_sum"), 2).alias("total_revenue"),
            round_to(F.sum("fare_sum"), 2).alias("total_fare"),
            round_to(F.sum("tip_sum"), 2).alias("total_tips"),
            round_to(F.sum("surcharges_sum"), 2).alias("total_surcharges"),
            round_to(average("total_sum", "total_n"), 2).alias("avg_revenue_per_trip"),
            round_to(F.sum("distance_sum"), 1).alias("total_distance_miles"),
        )
    )


def zone_hourly_demand(cells: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Pickup zone × hour × weekend flag; days are those with a trip in the cell."""
    return demand_of_partials(demand_partials(cells), dim_zone)


def demand_of_partials(partials: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """The same from the month partials, whose days are united."""
    keys = ["pickup_zone_key", "pickup_hour", "is_weekend"]
    names = ("total", "fare", "distance", "duration", "speed", "tip_rate")
    united = partials.groupBy(*keys, "day_bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("days")).alias("days"), *_added(*names)
    )
    demand = united.groupBy(*keys).agg(
        F.sum("trips").alias("nb_trips"),
        F.sum("days").alias("nb_days"),
        round_to(ratio(F.sum("trips"), F.sum("days")), 1).alias("avg_trips_per_day"),
        round_to(F.sum("total_sum"), 2).alias("total_revenue"),
        round_to(average("total_sum", "total_n"), 2).alias("avg_revenue_per_trip"),
        round_to(average("fare_sum", "fare_n"), 2).alias("avg_fare"),
        round_to(average("distance_sum", "distance_n"), 2).alias("avg_distance_miles"),
        round_to(average("duration_sum", "duration_n"), 1).alias("avg_duration_min"),
        round_to(average("speed_sum", "speed_n"), 1).alias("avg_speed_mph"),
        round_to(average("tip_rate_sum", "tip_rate_n"), 1).alias("avg_tip_rate_pct_card"),
        round_to(ratio(F.sum("total_sum"), F.sum("duration_sum")) * 60, 2).alias(
            "revenue_per_hour_driven"
        ),
    )
    zones = dim_zone.select(
        F.col("zone_key").alias("pickup_zone_key"),
        F.col("zone_name").alias("pickup_zone_name"),
        F.col("borough").alias("pickup_borough"),
        F.col("is_airport").alias("pickup_is_airport"),
    )
    leading = ["pickup_zone_key", "pickup_zone_name", "pickup_borough", "pickup_is_airport"]
    joined = demand.join(zones, "pickup_zone_key", "left")
    return joined.select(*leading, *[c for c in demand.columns if c not in leading])


def status_counts(flagged: DataFrame) -> DataFrame:
    """Rows per file, month and status; the partial behind the quality mart."""
    return flagged.groupBy(
        "source_file",
        "source_file_month",
        F.coalesce("rejection_reason", F.lit("valid")).alias("status"),
    ).agg(F.count(F.lit(1)).alias("nb_rows"))


def data_quality(counts: DataFrame) -> DataFrame:
    """Share of each status in its file. ``counts`` has a handful of rows per file."""
    in_file = F.sum("nb_rows").over(Window.partitionBy("source_file"))
    return (
        counts.where(F.col("source_file").isNotNull())
        .withColumn("nb_rows_total", in_file)
        .withColumn(
            "pct_of_file", round_to(F.col("nb_rows") / F.col("nb_rows_total") * 100, 3)
        )
    )
