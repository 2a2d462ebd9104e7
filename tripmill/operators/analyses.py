"""Questions asked of the published tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.contracts import CARD, CASH, OUTLIER_TOTAL, UNCOLLECTED_PAYMENTS
from tripmill.functions import average, ntz, ratio, round_to
from tripmill.operators.medians import exact_medians, join_on_group, medians_of_counts


def _n() -> Column:
    return F.count(F.lit(1))


def _share(hits: Column, rows: Column, digits: int) -> Column:
    return round_to(100 * hits / rows, digits)


def is_collected(max_total: float = OUTLIER_TOTAL) -> Column:
    """A plausible and collected amount; NULL for an unknown payment or amount."""
    return (F.col("total_amount") <= max_total) & ~F.col("payment_type_key").isin(*UNCOLLECTED_PAYMENTS)


def collected_trips(fact: DataFrame, max_total: float = OUTLIER_TOTAL) -> DataFrame:
    """Trips with a plausible and collected amount. An unknown payment (NULL) drops out."""
    return fact.where(is_collected(max_total))


def _known_zones(dim_zone: DataFrame) -> DataFrame:
    return dim_zone.where(~F.col("is_unknown_zone")).select(
        F.col("zone_key").alias("pickup_zone_key"), F.col("zone_name").alias("zone"), "borough"
    )


def top_zone_hours(
    fact: DataFrame, dim_zone: DataFrame, k: int = 10, max_total: float = OUTLIER_TOTAL
) -> DataFrame:
    """The ``k`` busiest pickup zone × hour cells and what a trip earns there."""
    trips = collected_trips(fact, max_total)
    zones = _known_zones(dim_zone)
    group = ["zone", "borough", "pickup_hour"]

    def total_if(payment: int) -> Column:
        return F.when(F.col("payment_type_key") == payment, F.col("total_amount"))

    # Aggregate by key and day before the zone names are joined: the join then
    # handles a few rows per zone, hour and day instead of every trip.
    daily = trips.groupBy("pickup_zone_key", "pickup_hour", "pickup_date").agg(
        _n().alias("trips"),
        F.sum("fare_amount").alias("fare_sum"),
        F.count("fare_amount").alias("fare_n"),
        F.sum("total_amount").alias("total_sum"),
        F.count("total_amount").alias("total_n"),
        F.count_if(F.col("payment_type_key") == CARD).alias("card_trips"),
        F.sum(total_if(CARD)).alias("card_sum"),
        F.count(total_if(CARD)).alias("card_n"),
        F.sum(total_if(CASH)).alias("cash_sum"),
        F.count(total_if(CASH)).alias("cash_n"),
    )
    busiest = (
        daily.join(zones, "pickup_zone_key")
        .groupBy(*group)
        .agg(F.countDistinct("pickup_date").alias("days"), *_totals())
    )
    cells, in_cells = _busiest(busiest, zones, k)
    ranked = trips.select("pickup_zone_key", "pickup_hour", "fare_amount").join(
        in_cells, ["pickup_zone_key", "pickup_hour"]
    )
    medians = exact_medians(ranked, ["cell"], {"median_fare": F.col("fare_amount")}, digits=2)
    return cells.join(medians, "cell", "left").drop("cell").orderBy(*_ranking())


_RANKING = [("nb_trips", False), ("zone", True), ("borough", True), ("pickup_hour", True)]
# Sums that the busiest cells are made of.
_CELL_SUMS = ["trips", "fare_sum", "fare_n", "total_sum", "total_n", "card_trips", "card_sum", "card_n", "cash_sum", "cash_n"]


def _ranking() -> list[Column]:
    return [F.asc(name) if ascending else F.desc(name) for name, ascending in _RANKING]


def _totals() -> list[Column]:
    return [F.sum(name).alias(name) for name in _CELL_SUMS]


def _busiest(totals: DataFrame, zones: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The ``k`` largest cells under a number, and the zone keys and hours of each."""
    busiest = totals.select(
        "zone", "borough", "pickup_hour",
        F.col("trips").alias("nb_trips"),
        round_to(F.col("trips") / F.col("days"), 0).alias("trips_per_day"),
        round_to(ratio(F.col("fare_sum"), F.col("fare_n")), 2).alias("avg_fare"),
        round_to(ratio(F.col("total_sum"), F.col("total_n")), 2).alias("avg_total"),
        _share(F.col("card_trips"), F.col("trips"), 1).alias("card_share_pct"),
        round_to(ratio(F.col("card_sum"), F.col("card_n")), 2).alias("avg_total_card"),
        round_to(ratio(F.col("cash_sum"), F.col("cash_n")), 2).alias("avg_total_cash"),
    ).orderBy(*_ranking()).limit(k)
    # The cells are known now: only their trips are ranked, under a number instead of names.
    cells = busiest.withColumn("cell", F.row_number().over(Window.orderBy(*_ranking())))
    zone_of = zones.select("pickup_zone_key", F.col("zone").alias("_zone"), F.col("borough").alias("_borough"))
    in_cells = cells.select("zone", "borough", "pickup_hour", "cell").join(
        zone_of,
        F.col("zone").eqNullSafe(F.col("_zone")) & F.col("borough").eqNullSafe(F.col("_borough")),
    ).select("pickup_zone_key", "pickup_hour", "cell")
    return cells, in_cells


def top_zone_hours_of_partials(collected: DataFrame, fare_counts: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    """The same from month partials (``marts.collected_partials``, ``marts.fare_counts``): the fact is not read.

    Days are counted in merged bitmaps, the median comes from merged counts of equal fares.
    """
    zones = _known_zones(dim_zone)
    group = ["zone", "borough", "pickup_hour"]
    totals = (
        collected.join(zones, "pickup_zone_key")
        .groupBy(*group, "day_bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("days")).alias("days"), *_totals())
        .groupBy(*group)
        .agg(F.sum("days").alias("days"), *_totals())
    )
    cells, in_cells = _busiest(totals, zones, k)
    fares = fare_counts.join(in_cells, ["pickup_zone_key", "pickup_hour"])
    medians = medians_of_counts(fares, ["cell"], "median_fare", "fare_amount", "trips", digits=2)
    return cells.join(medians, "cell", "left").drop("cell").orderBy(*_ranking())


def _cell_trips(fact: DataFrame, dim_zone: DataFrame, zone_name: str, hour: int) -> DataFrame:
    in_zone = dim_zone.where(F.col("zone_name") == zone_name).select(
        F.col("zone_key").alias("pickup_zone_key")
    )
    return fact.where(F.col("pickup_hour") == hour).join(in_zone, "pickup_zone_key")


def payment_mix(
    fact: DataFrame, dim_zone: DataFrame, dim_payment: DataFrame, zone_name: str, hour: int
) -> DataFrame:
    """Mean amount by payment type in one zone and hour."""
    return (
        _cell_trips(fact, dim_zone, zone_name, hour)
        .join(dim_payment, "payment_type_key")
        .groupBy("payment_type_label")
        .agg(_n().alias("nb_trips"), round_to(F.avg("total_amount"), 2).alias("avg_total"))
        .orderBy(F.desc("nb_trips"), "payment_type_label")
    )


def outlier_share(fact: DataFrame, threshold: float = OUTLIER_TOTAL) -> DataFrame:
    """Trips above an amount and their share of all trips, in one pass."""
    above = F.count_if(F.col("total_amount") > threshold)
    return fact.agg(
        above.alias("nb_outliers"),
        round_to(ratio(100 * above, _n()), 3).alias("share_pct"),
    )


def top_outliers(
    fact: DataFrame, dim_zone: DataFrame, zone_name: str, hour: int, payment_type: int, k: int = 5
) -> DataFrame:
    """The ``k`` most expensive trips of one cell and payment type."""
    return (
        _cell_trips(fact.where(F.col("payment_type_key") == payment_type), dim_zone, zone_name, hour)
        .orderBy(F.desc("total_amount"), "pickup_at", "trip_sk")
        .limit(k)
        .select("pickup_at", "trip_distance_miles", "fare_amount", "total_amount")
    )


def robust_mean_and_median(
    fact: DataFrame, dim_zone: DataFrame, zone_name: str, hour: int, below: float
) -> DataFrame:
    """Mean without extreme amounts next to the median, for one zone and hour."""
    trips = _cell_trips(fact.where(F.col("total_amount") < below), dim_zone, zone_name, hour)
    mean = trips.agg(round_to(F.avg("total_amount"), 2).alias("avg_total_without_outliers"))
    median = exact_medians(trips, [], {"median_total": F.col("total_amount")}, digits=2)
    # One row each; merged without a join.
    return mean.unionByName(median, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("avg_total_without_outliers", "median_total")]
    )


def tips_by_payment(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Mean tip and share of trips with one, by payment type."""
    per_code = fact.groupBy("payment_type_key").agg(
        _n().alias("trips"),
        F.sum("tip_amount").alias("tip_sum"),
        F.count("tip_amount").alias("tip_n"),
        F.count_if(F.col("tip_amount") > 0).alias("tipped"),
    )
    return (
        per_code.join(dim_payment, "payment_type_key")
        .groupBy("payment_type_label")
        .agg(
            F.sum("trips").alias("nb_trips"),
            round_to(average("tip_sum", "tip_n"), 2).alias("avg_tip"),
            _share(F.sum("tipped"), F.sum("trips"), 1).alias("tipped_share_pct"),
        )
        .orderBy(F.desc("nb_trips"), "payment_type_label")
    )


def fare_by_payment(
    fact: DataFrame, dim_payment: DataFrame, codes: Sequence[int] = (CARD, CASH)
) -> DataFrame:
    """Mean fare against mean total for chosen payment types."""
    per_code = (
        fact.where(F.col("payment_type_key").isin(*codes))
        .groupBy("payment_type_key")
        .agg(
            *[
                agg(f"{name}_amount").alias(f"{name}_{kind}")
                for name in ("fare", "total")
                for kind, agg in (("sum", F.sum), ("n", F.count))
            ]
        )
    )
    return (
        per_code.join(dim_payment, "payment_type_key")
        .groupBy("payment_type_label")
        .agg(
            round_to(average("fare_sum", "fare_n"), 2).alias("avg_fare"),
            round_to(average("total_sum", "total_n"), 2).alias("avg_total"),
        )
    )


def medians_by_payment(
    fact: DataFrame, dim_payment: DataFrame, max_total: float = OUTLIER_TOTAL
) -> DataFrame:
    """Median distance, fare and price per mile by payment type."""
    # Codes that share a label count as the smallest of them; labels join at the end.
    smallest = F.min("payment_type_key").over(Window.partitionBy("payment_type_label"))
    codes = dim_payment.select("payment_type_key", "payment_type_label", smallest.alias("code"))
    trips = (
        fact.where(F.col("total_amount") <= max_total)
        .join(codes.select("payment_type_key", "code"), "payment_type_key")
        .select("code", "trip_distance_miles", "fare_amount")
    )
    fare, distance = F.col("fare_amount"), F.col("trip_distance_miles")
    means = trips.groupBy("code").agg(
        _n().alias("nb_trips"), round_to(F.avg(fare), 2).alias("avg_fare")
    )
    names = {
        "median_distance": distance,
        "median_fare": fare,
        "median_price_per_mile": ratio(fare, distance),
    }
    medians = exact_medians(trips, ["code"], names, digits=2)
    labels = codes.where("payment_type_key = code").select("code", "payment_type_label")
    both = join_on_group(means, medians, ["code"], "left").join(labels, "code").drop("code")
    return both.select("payment_type_label", *[c for c in both.columns if c != "payment_type_label"]).orderBy(
        F.desc("nb_trips"), "payment_type_label"
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    counted = [
        table.agg(_n().alias("nb_rows")).select(F.lit(name).alias("table_name"), "nb_rows")
        for name, table in tables.items()
    ]
    result, *others = counted
    for other in others:
        result = result.unionByName(other)
    return result


def rows_per_file(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy(F.col("_source_file").alias("source_file"))
        .agg(_n().alias("nb_rows"))
        .orderBy("source_file")
    )


def rejection_rate_by_month(flagged: DataFrame) -> DataFrame:
    rejected = F.count_if(F.col("rejection_reason").isNotNull())
    return (
        flagged.groupBy("source_file_month")
        .agg(
            _n().alias("nb_trips"),
            rejected.alias("nb_rejected"),
            _share(rejected, _n(), 2).alias("rejection_rate_pct"),
        )
        .orderBy("source_file_month")
    )


def _recent(usage: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return usage.where(F.col("start_time") >= ntz(as_of - timedelta(days=days)))


def usage_by_day(usage: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Usage per entity and day over the trailing ``days``."""
    return (
        _recent(usage, as_of, days)
        .groupBy("entity", F.col("start_time").cast("date").alias("usage_date"))
        .agg(round_to(F.sum("usage"), 3).alias("usage"))
        .orderBy("usage_date", "entity")
    )


def usage_totals(usage: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Usage per entity with its split and the number of metered records."""
    return (
        _recent(usage, as_of, days)
        .groupBy("entity")
        .agg(
            round_to(F.sum("usage"), 3).alias("usage_total"),
            round_to(F.sum("usage_compute"), 3).alias("usage_compute"),
            round_to(F.sum("usage_services"), 3).alias("usage_services"),
            _n().alias("active_hours"),
        )
        .orderBy(F.desc("usage_total"), "entity")
    )
