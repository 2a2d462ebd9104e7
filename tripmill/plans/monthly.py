"""The monthly run and the backfill of several months."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmill.contracts import (
    PAYMENT_TYPES,
    RATE_CODES,
    VENDORS,
    ZONE_FILE_NAME,
    PipelineParams,
    check_in_calendar,
    check_month,
    month_start,
    trip_file_name,
)
from tripmill.operators import analyses, dimensions, gates, marts
from tripmill.operators.rules import flag_trips
from tripmill.operators.staging import stage_trips, stage_zones
from tripmill.operators.trips import build_fact, enrich_trips
from tripmill.plans import ledger
from tripmill.plans.warehouse import Publication, Warehouse
from tripmill.sources.landing import parts_by_schema
from tripmill.streaming.arrivals import file_changed, ingest_month, ingest_zones, reload_month


def side_by_side(*jobs: Callable[[], None]) -> None:
    """Run independent Spark jobs together; raise the first failure once all ended."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    for job in running:
        job.result()


def _of_month(trips: DataFrame, month: str) -> DataFrame:
    return trips.where(F.col("source_file_month") == F.lit(month_start(month)))


def publish_dimensions(
    run: Publication,
    landing: str,
    params: PipelineParams,
    zone_options: dict | None = None,
    loaded_at: datetime | None = None,
) -> None:
    """Zones, unless they are loaded, and all dimensions. One that would be made from the same again stays as it is."""
    warehouse, spark = run.warehouse, run.warehouse.spark
    if warehouse.read("taxi_zone_lookup").isEmpty():
        # The zone list is loaded once; later months need not bring it.
        ingest_zones(warehouse, landing, loaded_at)
    load = warehouse.ledger.last(ZONE_FILE_NAME, ledger.LOADED)
    options, days = zone_options or {}, (params.start_month, params.end_month)
    zones = stage_zones(warehouse.read("taxi_zone_lookup"))
    codes = {
        "payment_type": (PAYMENT_TYPES, dimensions.payment_types),
        "rate_code": (RATE_CODES, dimensions.rate_codes),
        "vendor": (VENDORS, dimensions.vendors),
    }
    side_by_side(
        lambda: run.write_if_new("dim_date", repr(days), lambda: dimensions.calendar(spark, *days)),
        lambda: run.write_if_new(
            "dim_zone", f"load {load and load.event} {sorted(options.items())}", lambda: dimensions.dim_zone(zones, **options)
        ),
        *[
            lambda name=name, values=values, rows=rows: run.write_if_new(f"{name}_codes", repr(values), lambda: rows(spark))
            for name, (values, rows) in codes.items()
        ],
    )
    for name in codes:
        run.share(f"dim_{name}", f"{name}_codes")


def publish_intermediate(run: Publication, month: str, params: PipelineParams) -> dict[str, object]:
    """Label the month's trips, then keep, key and enrich the valid ones; the values of the month's gates.

    Gates and status counts are observed by the jobs that write: no rows are read for them.
    """
    warehouse, day = run.warehouse, month_start(month)
    staged = stage_trips(warehouse.read("yellow_tripdata"), day)
    seen, kept = Observation(), Observation()
    flagged = flag_trips(staged, params).observe(seen, *gates.status_metrics(params))
    warehouse.replace_partition("int_trips__flagged", day, flagged)
    statuses = seen.get

    def enrich() -> None:
        labelled = _of_month(warehouse.read("int_trips__flagged"), month)
        enriched = enrich_trips(labelled, "_kept").observe(kept, *gates.distinct_metrics("_kept"))
        warehouse.replace_partition("int_trips__enriched", day, enriched.drop("_kept"))

    def count() -> None:
        # Published here, not with the marts: a month stopped by a gate is reported too,
        # as soon as a later run publishes.
        counts = [(trip_file_name(month), day, status, n) for status, n in statuses.items() if n]
        run.write("int_trips__status_counts", warehouse.spark.createDataFrame(counts, _STATUS_COUNTS), day)
        run.commit("int_trips__status_counts")
        run.write("mart_data_quality", marts.data_quality(run.read("int_trips__status_counts")))

    side_by_side(enrich, count)
    return {**gates.observed_distinct(kept.get), **gates.observed_rejection_rate(statuses, params)}


_STATUS_COUNTS = "source_file string, source_file_month date, status string, nb_rows bigint"


def publish_marts(run: Publication, month: str) -> None:
    """The month of the fact and its partials, and the marts."""
    day = month_start(month)
    fact = build_fact(_of_month(run.warehouse.read("int_trips__enriched"), month))

    def revenue() -> None:
        run.write("int_trips__daily", marts.daily_partials(cells), day)
        daily = marts.daily_revenue(run.read("int_trips__daily"), run.read("dim_date"), run.read("dim_payment_type"))
        run.write("mart_daily_revenue", daily)

    def demand() -> None:
        run.write("int_trips__demand", marts.demand_partials(cells), day)
        rows = marts.demand_of_partials(run.read("int_trips__demand"), run.read("dim_zone"))
        run.write("mart_zone_hourly_demand", rows)

    cells = run.scratch("cells", marts.trip_cells(fact))
    side_by_side(
        revenue,
        demand,
        lambda: run.write("int_trips__collected", marts.collected_partials(cells), day),
        lambda: run.write("fct_trips", fact, day),
        lambda: run.write("int_trips__fare_counts", marts.fare_counts(fact), day),
    )


def top_zone_hours(warehouse: Warehouse, k: int = 10) -> DataFrame:
    """The busiest cells of the published months, from their partials alone."""
    now = warehouse.snapshot()
    return analyses.top_zone_hours_of_partials(
        now.read("int_trips__collected"), now.read("int_trips__fare_counts"), now.read("dim_zone"), k
    )


def run_month(
    warehouse: Warehouse,
    landing: str,
    month: str,
    params: PipelineParams = PipelineParams(),
    loaded_at: datetime | None = None,
    zone_options: dict | None = None,
) -> None:
    """Load, label, enrich, check and publish one month. A failed gate raises
    before anything is published; a run that stops anywhere leaves the previous publication
    readable in full, and running the month again repairs the rest."""
    check_in_calendar(month, params)
    warehouse.create()
    landing, file_name = landing.rstrip("/"), trip_file_name(month)
    run = warehouse.publication()

    def trips() -> None:
        # Without its landed file a month stays what it was loaded as.
        parts = parts_by_schema(warehouse.spark, f"{landing}/{file_name}") if _landed(warehouse, landing, file_name) else []
        gates.pass_gate(gates.keys_have_not_drifted(parts))
        gates.pass_gate({"month_loaded": ingest_month(warehouse, landing, month, loaded_at, parts) > 0})
        gates.pass_gate(publish_intermediate(run, month, params))

    try:
        # Dimensions do not wait for the trips; neither is seen before both are there.
        side_by_side(trips, lambda: publish_dimensions(run, landing, params, zone_options, loaded_at))
        publish_marts(run, month)
        run.commit()
    except Exception as error:
        run.abandon()
        warehouse.ledger.record(file_name, ledger.STOPPED, note=f"{type(error).__name__}: {error}"[:500])
        raise
    warehouse.ledger.record(file_name, ledger.PUBLISHED, note=_settings(params, zone_options))


def _landed(warehouse: Warehouse, landing: str, file_name: str) -> bool:
    return warehouse.path_exists(f"{landing}/{file_name}")


def _settings(params: PipelineParams, zone_options: dict | None) -> str:
    """What a month was published with; the calendar's range may grow without a month being run again."""
    rules = replace(params, start_month=date.min, end_month=date.max)
    return f"{rules} {sorted((zone_options or {}).items())}"


def backfill(
    warehouse: Warehouse,
    landing: str,
    months: Sequence[str],
    params: PipelineParams = PipelineParams(),
    resume: bool = False,
    **options,
) -> list[str]:
    """Run months one at a time, in order; the first failed gate stops the rest. The months that ran.

    Nothing is loaded if the calendar misses one of them. With ``resume`` the ledger says where to go on: a month that
    was published with the same settings from the file as it is now is left alone, and a file that has changed since
    it was loaded is loaded anew.
    """
    done = []
    for month in [check_in_calendar(m, params) for m in sorted(check_month(m) for m in months)]:
        if resume and not _outstanding(warehouse, landing.rstrip("/"), month, params, options):
            continue
        run_month(warehouse, landing, month, params, **options)
        done.append(month)
    return done


def _outstanding(warehouse: Warehouse, landing: str, month: str, params: PipelineParams, options: dict) -> bool:
    file_name = trip_file_name(month)
    if _landed(warehouse, landing, file_name):
        if file_changed(warehouse, file_name, parts_by_schema(warehouse.spark, f"{landing}/{file_name}")):
            warehouse.create()
            reload_month(warehouse, landing, month, options.get("loaded_at"))
            return True
    last = warehouse.ledger.last(file_name, ledger.PUBLISHED, ledger.STOPPED, ledger.FORGOTTEN, ledger.EMPTIED)
    settings = _settings(params, options.get("zone_options"))
    return last is None or last.state != ledger.PUBLISHED or last.note != settings
