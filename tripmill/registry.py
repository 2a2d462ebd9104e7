"""Every job as a named query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import fixtures as fx
from tripmill.contracts import month_start, trip_file_name
from tripmill.operators import analyses, dimensions, gates, marts, rules
from tripmill.operators.staging import stage_trips, stage_zones
from tripmill.operators.trips import (
    build_fact,
    enrich_trips,
    keep_first_copy,
    valid_trips,
)
from tripmill.plans import monthly
from tripmill.plans.warehouse import Warehouse
from tripmill.session import scratch_dir
from tripmill.sources import profile
from tripmill.sources.landing import parts_by_schema
from tripmill.streaming.arrivals import empty_month, forget_month, ingest_month, ingest_zones

# Parameters of the registered queries, shared with their SQL counterparts.
MIX_ZONE, MIX_HOUR = "NATION_3", 17
OUTLIER_ZONE, OUTLIER_HOUR, OUTLIER_PAYMENT, OUTLIER_AMOUNT = "NATION_7", 0, 3, 100000.0
PROFILE_MONTH = "1998-02"
REPLAYED_MONTH, EMPTIED_MONTH = "1996-05", "1997-03"
FILE_MONTHS = ["2024-01", "2024-02"]
LAST_OLDER_PAYMENT = 2
# Months of the published runs: days after January's trips, and whether the month must pass its gates.
RUN_MONTHS = {"2024-01": (0, True), "2024-02": (31, False), "2024-03": (60, True)}
REPAIRED_MONTH = "2024-02"


class Trips:
    """The layers over one of the trip-shaped views, built lazily."""

    def __init__(self, raw: DataFrame, params) -> None:
        self.raw, self.params = raw, params
        self.staged = stage_trips(raw)
        self.flagged = rules.flag_trips(self.staged, params)

    @property
    def enriched(self) -> DataFrame:
        return enrich_trips(self.flagged)

    @property
    def fact(self) -> DataFrame:
        return build_fact(self.enriched)

    @property
    def cells(self) -> DataFrame:
        return marts.trip_cells(self.fact)


def events(spark: SparkSession, sf_dir: str) -> Trips:
    return Trips(fx.trips_from_events(spark, sf_dir), fx.EVENT_PARAMS)


def lines(spark: SparkSession, sf_dir: str) -> Trips:
    return Trips(fx.trips_from_lineitem(spark, sf_dir), fx.LINEITEM_PARAMS)


def stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the shared scratch folder and read back.

    For analyses that scan a table more than once: in a warehouse it is published
    already, and recomputing the whole pipeline per scan would cost far more.
    """
    path = f"{scratch_dir(spark, label)}/{label}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_zone(stage_zones(fx.zones_from_nations(spark, sf_dir)), **fx.ZONE_OPTIONS)


def staging_projection(spark, sf_dir):
    return events(spark, sf_dir).staged


def zones_staging(spark, sf_dir):
    return stage_zones(fx.zones_from_nations(spark, sf_dir))


def dim_zone(spark, sf_dir):
    return zones(spark, sf_dir)


def code_dimensions(spark, sf_dir):
    """The three code tables with the number of loaded trips of each code."""
    codes = {
        "payment_type": dimensions.payment_types(spark),
        "rate_code": dimensions.rate_codes(spark),
        "vendor": dimensions.vendors(spark),
    }
    labels = reduce(
        DataFrame.union,
        [t.select(F.lit(name).alias("dimension"), t[0].alias("code"), t[1].alias("label"))
         for name, t in codes.items()],
    )
    pairs = [
        F.struct(F.lit(name).alias("dimension"), F.col(f"{name}_key").alias("code")) for name in codes
    ]
    used = (
        events(spark, sf_dir).staged.select(F.inline(F.array(*pairs)))
        .groupBy("dimension", "code").agg(F.count(F.lit(1)).alias("n"))
    )
    return labels.join(used, ["dimension", "code"], "left").select(
        "dimension", "code", "label", F.coalesce("n", F.lit(0)).alias("nb_trips")
    )


def _file_months(staged: DataFrame) -> tuple[date, date]:
    """The first file month and the month after the last: what a run's calendar has to cover."""
    span = staged.agg(F.min("source_file_month").alias("first"), F.add_months(F.max("source_file_month"), 1).alias("end"))
    return tuple(span.first())


def dim_date(spark, sf_dir):
    return dimensions.calendar(spark, *_file_months(events(spark, sf_dir).staged))


def flagged_trips(spark, sf_dir):
    return events(spark, sf_dir).flagged


def flagged_trips_volume(spark, sf_dir):
    return lines(spark, sf_dir).flagged


def amount_cap_statuses(spark, sf_dir):
    """Statuses with the proposed ceiling on the total switched on."""
    trips = lines(spark, sf_dir)
    capped = replace(trips.params, max_total_amount=OUTLIER_AMOUNT)
    return marts.data_quality(marts.status_counts(rules.flag_trips(trips.staged, capped)))


def valid_deduplicated(spark, sf_dir):
    return keep_first_copy(valid_trips(events(spark, sf_dir).flagged)).drop("rejection_reason")


def trip_surrogate_key(spark, sf_dir):
    return events(spark, sf_dir).enriched.select("trip_sk", "vendor_key", "pickup_at", "total_amount")


def enriched_trips(spark, sf_dir):
    return events(spark, sf_dir).enriched.drop("trip_sk")


def enriched_trips_volume(spark, sf_dir):
    return lines(spark, sf_dir).enriched


def enriched_known_copies(spark, sf_dir):
    """The monthly run's way: labelled trips are written, then compared and enriched."""
    return enrich_trips(stored(spark, events(spark, sf_dir).flagged, "flagged"))


def enriched_known_copies_volume(spark, sf_dir):
    return enrich_trips(stored(spark, lines(spark, sf_dir).flagged, "flagged"))


def fact_trips(spark, sf_dir):
    return events(spark, sf_dir).fact


def mart_daily_revenue(spark, sf_dir):
    days = dimensions.calendar(spark, *_file_months(events(spark, sf_dir).staged))
    return marts.daily_revenue(events(spark, sf_dir).cells, days, dimensions.payment_types(spark))


def mart_daily_revenue_volume(spark, sf_dir):
    trips = lines(spark, sf_dir)
    days = dimensions.calendar(spark, trips.params.start_month, trips.params.end_month)
    return marts.daily_revenue(trips.cells, days, dimensions.payment_types(spark))


def mart_zone_hourly_demand(spark, sf_dir):
    return marts.zone_hourly_demand(events(spark, sf_dir).cells, zones(spark, sf_dir))


def mart_zone_hourly_demand_volume(spark, sf_dir):
    return marts.zone_hourly_demand(lines(spark, sf_dir).cells, zones(spark, sf_dir))


def mart_data_quality(spark, sf_dir):
    return marts.data_quality(marts.status_counts(events(spark, sf_dir).flagged))


def top_zone_hours(spark, sf_dir):
    fact = stored(spark, events(spark, sf_dir).fact, "fact")
    return analyses.top_zone_hours(fact, zones(spark, sf_dir))


def anomaly_counts(spark, sf_dir):
    trips = lines(spark, sf_dir)
    return rules.anomaly_counts(trips.staged, trips.params, by=["source_file_month"])


def anomaly_histogram(spark, sf_dir):
    trips = lines(spark, sf_dir)
    return rules.anomaly_histogram(trips.staged, trips.params)


def payment_mix_for_zone_hour(spark, sf_dir):
    return analyses.payment_mix(
        events(spark, sf_dir).fact, zones(spark, sf_dir), dimensions.payment_types(spark),
        MIX_ZONE, MIX_HOUR,
    )


def outlier_share(spark, sf_dir):
    return analyses.outlier_share(lines(spark, sf_dir).fact, OUTLIER_AMOUNT)


def top_outliers(spark, sf_dir):
    return analyses.top_outliers(
        lines(spark, sf_dir).fact, zones(spark, sf_dir), OUTLIER_ZONE, OUTLIER_HOUR, OUTLIER_PAYMENT
    )


def robust_mean_vs_median(spark, sf_dir):
    fact = stored(spark, lines(spark, sf_dir).fact, "fact")
    return analyses.robust_mean_and_median(
        fact, zones(spark, sf_dir), OUTLIER_ZONE, OUTLIER_HOUR, OUTLIER_AMOUNT
    )


def tips_by_payment(spark, sf_dir):
    return analyses.tips_by_payment(events(spark, sf_dir).fact, dimensions.payment_types(spark))


def fare_card_vs_cash(spark, sf_dir):
    return analyses.fare_by_payment(events(spark, sf_dir).fact, dimensions.payment_types(spark))


def median_price_per_mile(spark, sf_dir):
    fact = stored(spark, events(spark, sf_dir).fact, "fact")
    return analyses.medians_by_payment(fact, dimensions.payment_types(spark))


def median_price_per_mile_volume(spark, sf_dir):
    fact = stored(spark, lines(spark, sf_dir).fact, "fact")
    return analyses.medians_by_payment(fact, dimensions.payment_types(spark), OUTLIER_AMOUNT)


def star_filters_joins(spark, sf_dir):
    """Collected trips joined with both dimensions, by borough and payment label."""
    fact, zone = events(spark, sf_dir).fact, zones(spark, sf_dir)
    return (
        analyses.collected_trips(fact)
        .join(zone.where("NOT is_unknown_zone"), F.col("pickup_zone_key") == F.col("zone_key"))
        .join(dimensions.payment_types(spark), "payment_type_key")
        .groupBy("borough", "is_airport", "payment_type_label")
        .agg(F.count(F.lit(1)).alias("nb_trips"), F.max("total_amount").alias("max_total"))
    )


def table_counts(spark, sf_dir):
    trips, zone = events(spark, sf_dir), zones(spark, sf_dir)
    flagged = stored(spark, trips.flagged, "flagged")
    fact = stored(spark, build_fact(enrich_trips(flagged)), "fact")
    demand = marts.zone_hourly_demand(marts.trip_cells(fact), zone)
    return analyses.table_counts(
        {
            "raw.yellow_tripdata": trips.raw,
            "raw.taxi_zone_lookup": fx.zones_from_nations(spark, sf_dir),
            "intermediate.int_trips__flagged": flagged,
            "marts.fct_trips": fact,
            "marts.mart_zone_hourly_demand": demand,
            "marts.mart_data_quality": marts.data_quality(marts.status_counts(flagged)),
        }
    )


def rows_per_file(spark, sf_dir):
    return analyses.rows_per_file(events(spark, sf_dir).raw)


def rejection_rate_by_month(spark, sf_dir):
    return analyses.rejection_rate_by_month(lines(spark, sf_dir).flagged)


def usage_daily_rollup(spark, sf_dir):
    return analyses.usage_by_day(fx.usage_from_events(spark, sf_dir), fx.USAGE_AS_OF)


def usage_totals(spark, sf_dir):
    return analyses.usage_totals(fx.usage_from_events(spark, sf_dir), fx.USAGE_AS_OF)


def gate_values(spark, sf_dir):
    """Every gate of both file months, one row per check."""
    trips, checks = events(spark, sf_dir), []
    flagged = stored(spark, trips.flagged, "flagged")
    enriched = stored(spark, enrich_trips(flagged), "enriched")
    for month in FILE_MONTHS:
        day = month_start(month)
        for gate in (
            gates.month_is_loaded(trips.raw, trip_file_name(month)),
            gates.trips_are_distinct(enriched, day),
            gates.rejection_rate_is_low(flagged, day, trips.params),
        ):
            values = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("passed")) for c in gate.columns]
            checks.append(
                gate.select(F.inline(F.array(*values))).withColumn("source_file_month", F.lit(day))
            )
    return reduce(DataFrame.unionByName, checks)


def raw_contract_checks(spark, sf_dir):
    return gates.load_summary(events(spark, sf_dir).raw)


def raw_value_checks(spark, sf_dir):
    """Zone list complete and unique, amounts with their cents; one row per check."""
    checks = [
        gates.zones_are_complete(fx.zones_from_nations(spark, sf_dir), expected=25),
        gates.amounts_keep_decimals(lines(spark, sf_dir).raw),
    ]
    rows = []
    for check in checks:
        values = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("passed")) for c in check.columns]
        rows.append(check.select(F.inline(F.array(*values))))
    return reduce(DataFrame.unionByName, rows)


def source_profile_codes(spark, sf_dir):
    return profile.code_frequencies(events(spark, sf_dir).raw)


def source_profile_anomalies(spark, sf_dir):
    return profile.anomalies(lines(spark, sf_dir).raw, PROFILE_MONTH)


def source_profile_files(spark, sf_dir):
    return profile.files(spark, f"{sf_dir}/events.parquet").select("file_name", "nb_rows")


def source_profile_columns(spark, sf_dir):
    """Size and time are those of the file; what is comparable is that they are there."""
    return profile.columns(spark, f"{sf_dir}/events.parquet").select(
        "file_name", (F.col("file_size") > 0).alias("has_size"), F.col("file_time").isNotNull().alias("has_time"),
        "column_name", "data_type", "nb_rows", "nb_nulls", "example",
    )


def _warehouse(spark: SparkSession, label: str) -> tuple[Warehouse, str]:
    """A warehouse of its own under the shared scratch folder, and a landing folder."""
    root = scratch_dir(spark, label)
    prefix = "q_" + root.rsplit("-", 1)[-1].lower() + "_"
    warehouse = Warehouse(spark, f"{root}/warehouse", prefix)
    warehouse.create()
    return warehouse, f"{root}/landing"


def _land_trips(raw: DataFrame, landing: str, month: str, **changes) -> None:
    name = trip_file_name(month)
    file_rows = raw.where(F.col("_source_file") == name).drop("_source_file", "_loaded_at")
    file_rows.withColumns(changes).write.mode("append").parquet(f"{landing}/{name}")


def month_replace(spark, sf_dir):
    """Fill all months, replay one, empty another; rows per month and status."""
    warehouse, _ = _warehouse(spark, "replace")
    flagged = lines(spark, sf_dir).flagged
    warehouse.append("int_trips__flagged", flagged)
    for month, keep in ((REPLAYED_MONTH, True), (EMPTIED_MONTH, False)):
        day = month_start(month)
        rows = flagged.where((F.col("source_file_month") == F.lit(day)) & F.lit(keep))
        warehouse.replace_partition("int_trips__flagged", day, rows)
    return marts.status_counts(warehouse.read("int_trips__flagged"))


def load_once(spark, sf_dir):
    """Two drifting files, each offered twice; the staged rows."""
    warehouse, landing = _warehouse(spark, "load")
    raw = events(spark, sf_dir).raw
    january = raw.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    january = january.withColumnsRenamed({"airport_fee": "Airport_fee", "vendorid": "VendorID"})
    _land_trips(january, landing, "2024-01")
    _land_trips(raw.drop("cbd_congestion_fee"), landing, "2024-02", surprise=F.lit("new column"))
    for month in FILE_MONTHS * 2:
        ingest_month(warehouse, landing, month, fx.FIRST_LOAD)
    return stage_trips(warehouse.read("yellow_tripdata"))


def load_parts(spark, sf_dir):
    """All trips as one month's folder of parts that drift from each other; the staged rows."""
    warehouse, landing = _warehouse(spark, "parts")
    raw = events(spark, sf_dir).raw.withColumn("_source_file", F.lit(trip_file_name("2024-01")))
    older = F.col("payment_type") <= LAST_OLDER_PAYMENT
    early = raw.where(older).withColumn("passenger_count", F.col("passenger_count").cast("double"))
    _land_trips(early.drop("cbd_congestion_fee"), landing, "2024-01")
    _land_trips(raw.where(~older), landing, "2024-01")
    ingest_month(warehouse, landing, "2024-01", fx.FIRST_LOAD)
    return stage_trips(warehouse.read("yellow_tripdata"))


def csv_zones(spark, sf_dir):
    """Zones written as CSV with a quoted comma, loaded and staged."""
    warehouse, landing = _warehouse(spark, "zones")
    (
        fx.zones_from_nations(spark, sf_dir)
        .select("locationid", "borough", F.concat_ws(", ", "zone", "borough"), "service_zone")
        .write.option("header", True).csv(f"{landing}/taxi_zone_lookup.csv")
    )
    for _ in range(2):
        ingest_zones(warehouse, landing, fx.FIRST_LOAD)
    return stage_zones(warehouse.read("taxi_zone_lookup"))


def monthly_run(spark, sf_dir):
    """January publishes, February stops at a gate; the fact afterwards."""
    warehouse, landing = _warehouse(spark, "run")
    raw = events(spark, sf_dir).raw
    monthly.side_by_side(
        lambda: _land_zones(spark, sf_dir, landing), *[lambda m=m: _land_trips(raw, landing, m) for m in FILE_MONTHS]
    )
    try:
        monthly.backfill(
            warehouse, landing, FILE_MONTHS, fx.EVENT_PARAMS,
            loaded_at=fx.FIRST_LOAD, zone_options=fx.ZONE_OPTIONS,
        )
    except gates.GateFailed:
        pass
    return warehouse.read("fct_trips")


def _run_trips(raw: DataFrame, month: str, passes: bool | None = None) -> DataFrame:
    """All trips, moved into one of the published runs' months; those of a month that fails its gate break a rule."""
    days, usually = RUN_MONTHS[month]
    passes = usually if passes is None else passes
    later, distance = F.expr(f"INTERVAL {days} DAYS"), F.col("trip_distance")
    return raw.withColumns(
        {
            "tpep_pickup_datetime": F.col("tpep_pickup_datetime") + later,
            "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime") + later,
            "trip_distance": distance if passes else F.when(F.col("passenger_count") > 3, distance).otherwise(-1.0),
            "_source_file": F.lit(trip_file_name(month)),
        }
    )


def _land_zones(spark: SparkSession, sf_dir: str, landing: str) -> None:
    zone_rows = fx.zones_from_nations(spark, sf_dir).drop("_source_file", "_loaded_at")
    zone_rows.write.option("header", True).csv(f"{landing}/taxi_zone_lookup.csv")


def _published(spark: SparkSession, sf_dir: str) -> Warehouse:
    """January and March publish, February holds valid trips but fails its gate; January runs twice."""
    warehouse, landing = _warehouse(spark, "months")
    raw = stored(spark, events(spark, sf_dir).raw, "trips")
    monthly.side_by_side(
        lambda: _land_zones(spark, sf_dir, landing),
        *[lambda m=m: _land_trips(_run_trips(raw, m), landing, m) for m in RUN_MONTHS],
    )
    for month in [*RUN_MONTHS, "2024-01"]:
        try:
            monthly.run_month(
                warehouse, landing, month, fx.EVENT_PARAMS,
                loaded_at=fx.FIRST_LOAD, zone_options=fx.ZONE_OPTIONS,
            )
        except gates.GateFailed:
            pass
    return warehouse


def monthly_fact(spark, sf_dir):
    return _published(spark, sf_dir).read("fct_trips")


def monthly_daily_revenue(spark, sf_dir):
    return _published(spark, sf_dir).read("mart_daily_revenue")


def monthly_zone_demand(spark, sf_dir):
    return _published(spark, sf_dir).read("mart_zone_hourly_demand")


def monthly_quality(spark, sf_dir):
    return _published(spark, sf_dir).read("mart_data_quality")


def monthly_top_zone_hours(spark, sf_dir):
    """The flagship over published months: from their partials, without reading the fact."""
    return monthly.top_zone_hours(_published(spark, sf_dir))


def backfill_resumed(spark, sf_dir):
    """Three months; the second fails its gate, is landed anew, and the backfill goes on there. Rows and runs by month."""
    warehouse, landing = _warehouse(spark, "backfill")
    raw = stored(spark, events(spark, sf_dir).raw, "trips")
    monthly.side_by_side(
        lambda: _land_zones(spark, sf_dir, landing),
        *[lambda m=m: _land_trips(_run_trips(raw, m), landing, m) for m in RUN_MONTHS],
    )
    options = {"loaded_at": fx.FIRST_LOAD, "zone_options": fx.ZONE_OPTIONS}
    # Moved trips of the last days of a shorter month fall outside it.
    params, ran = replace(fx.EVENT_PARAMS, max_rejection_rate=0.4), []
    try:
        monthly.backfill(warehouse, landing, list(RUN_MONTHS), params, resume=True, **options)
    except gates.GateFailed:
        # The file of the month that stopped comes again under its name, with its distances.
        warehouse.delete_path(f"{landing}/{trip_file_name(REPAIRED_MONTH)}")
        _land_trips(_run_trips(raw, REPAIRED_MONTH, passes=True), landing, REPAIRED_MONTH)
        ran = monthly.backfill(warehouse, landing, list(RUN_MONTHS), params, resume=True, **options)
    runs = spark.createDataFrame([(month_start(m), m in ran) for m in RUN_MONTHS], "source_file_month date, ran_again boolean")
    rows = warehouse.read("fct_trips").groupBy("source_file_month").agg(
        F.count(F.lit(1)).alias("nb_trips"), F.countDistinct("trip_sk").alias("nb_keys")
    )
    return runs.join(rows, "source_file_month")


def load_history(spark, sf_dir):
    """Loaded, offered again, changed under its name, emptied, offered, forgotten and loaded again: the ledger."""
    warehouse, landing = _warehouse(spark, "history")
    raw = events(spark, sf_dir).raw
    for month in FILE_MONTHS:
        _land_trips(raw, landing, month)
        ingest_month(warehouse, landing, month, fx.FIRST_LOAD)
    january = FILE_MONTHS[0]
    ingest_month(warehouse, landing, january, fx.FIRST_LOAD)
    warehouse.delete_path(f"{landing}/{trip_file_name(january)}")
    _land_trips(raw.withColumn("tip_amount", F.lit(0.0)), landing, january)
    ingest_month(warehouse, landing, january, fx.FIRST_LOAD)
    empty_month(warehouse, january)
    ingest_month(warehouse, landing, january, fx.FIRST_LOAD)
    forget_month(warehouse, january)
    ingest_month(warehouse, landing, january, fx.FIRST_LOAD)
    return warehouse.ledger.events().select("file_name", "event", "state", "nb_rows")


def drift_report(spark, sf_dir):
    """A month whose parts drift from the contract: what differs, in how many rows, and what would stop the run."""
    _, landing = _warehouse(spark, "drift")
    raw = events(spark, sf_dir).raw
    older = F.col("payment_type") <= LAST_OLDER_PAYMENT
    text_key = {"vendorid": F.col("vendorid").cast("string"), "passenger_count": F.col("passenger_count").cast("double")}
    _land_trips(raw.where(older).drop("cbd_congestion_fee"), landing, "2024-01", **text_key)
    _land_trips(raw.where(~older), landing, "2024-01", surprise=F.lit("x"), pulocationid=F.col("pulocationid").cast("int"))
    return gates.drift_report(spark, parts_by_schema(spark, f"{landing}/{trip_file_name('2024-01')}"))


def staging_views(spark, sf_dir):
    """Loaded trips and zones as another session sees them through the catalog's views."""
    warehouse, landing = _warehouse(spark, "views")
    raw = events(spark, sf_dir).raw
    for month in FILE_MONTHS:
        _land_trips(raw, landing, month)
        ingest_month(warehouse, landing, month, fx.FIRST_LOAD)
    _land_zones(spark, sf_dir, landing)
    ingest_zones(warehouse, landing, fx.FIRST_LOAD)
    staging = f"{warehouse.prefix}staging"
    return spark.newSession().sql(
        f"SELECT t.*, z.zone_name, z.borough FROM {staging}.stg_tlc__yellow_trips t "
        f"LEFT JOIN {staging}.stg_tlc__taxi_zones z ON z.zone_key = t.pickup_zone_key"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        staging_projection,
        zones_staging,
        dim_zone,
        code_dimensions,
        dim_date,
        flagged_trips,
        flagged_trips_volume,
        amount_cap_statuses,
        valid_deduplicated,
        trip_surrogate_key,
        enriched_trips,
        enriched_trips_volume,
        enriched_known_copies,
        enriched_known_copies_volume,
        fact_trips,
        mart_daily_revenue,
        mart_daily_revenue_volume,
        mart_zone_hourly_demand,
        mart_zone_hourly_demand_volume,
        mart_data_quality,
        top_zone_hours,
        anomaly_counts,
        anomaly_histogram,
        payment_mix_for_zone_hour,
        outlier_share,
        top_outliers,
        robust_mean_vs_median,
        tips_by_payment,
        fare_card_vs_cash,
        median_price_per_mile,
        median_price_per_mile_volume,
        star_filters_joins,
        table_counts,
        rows_per_file,
        rejection_rate_by_month,
        usage_daily_rollup,
        usage_totals,
        gate_values,
        raw_contract_checks,
        raw_value_checks,
        source_profile_codes,
        source_profile_anomalies,
        source_profile_files,
        source_profile_columns,
        month_replace,
        load_once,
        load_parts,
        csv_zones,
        monthly_run,
        monthly_fact,
        monthly_daily_revenue,
        monthly_zone_demand,
        monthly_quality,
        monthly_top_zone_hours,
        backfill_resumed,
        load_history,
        drift_report,
        staging_views,
    )
}
