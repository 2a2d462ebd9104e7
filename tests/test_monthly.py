"""Publication, replay, gates, several months."""

import shutil
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmill import fixtures as fx
from tripmill.operators import gates
from tripmill.plans import monthly
from tripmill.plans.warehouse import Warehouse
from tripmill.registry import _land_trips
from tripmill.operators.staging import stage_trips
from tripmill.operators.rules import flag_trips

JANUARY, FEBRUARY = date(2024, 1, 1), date(2024, 2, 1)
TABLES = [
    "yellow_tripdata", "int_trips__flagged", "int_trips__enriched", "fct_trips", "dim_date", "dim_zone",
    "dim_payment_type", "dim_rate_code", "dim_vendor", "mart_daily_revenue", "mart_zone_hourly_demand",
    "mart_data_quality",
]
OPTIONS = {"loaded_at": fx.FIRST_LOAD, "zone_options": fx.ZONE_OPTIONS}


@pytest.fixture
def landing(landed, tmp_path):
    """A landing folder of its own."""
    return shutil.copytree(landed, tmp_path / "landing").as_posix()


@pytest.fixture(scope="session")
def landed(spark, tmp_path_factory):
    """January and February files with the same valid share, and the zone list."""
    folder = str(tmp_path_factory.mktemp("landed"))
    raw = fx.trips_from_events(spark, SF)
    _land_trips(raw, folder, "2024-01")
    later = raw.where(F.col("_source_file").contains("2024-01")).withColumns(
        {
            c: F.expr(f"{c} + interval 31 days")
            for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    # 29 days in February: trips of the last days fall outside their file month.
    later = later.withColumn("_source_file", F.lit("yellow_tripdata_2024-02.parquet"))
    _land_trips(later, folder, "2024-02")
    _land_trips(raw.withColumn("_source_file", F.lit("yellow_tripdata_2024-03.parquet")), folder, "2024-03")
    zones = fx.zones_from_nations(spark, SF).drop("_source_file", "_loaded_at")
    zones.write.option("header", True).csv(f"{folder}/taxi_zone_lookup.csv")
    return folder


def _content(warehouse, table):
    return sorted(map(str, warehouse.read(table).collect()))


def _snapshot(warehouse):
    return {table: _content(warehouse, table) for table in TABLES}


def test_two_months_then_replay_then_failed_gate(spark, warehouse, landing, tmp_path):
    done = monthly.backfill(warehouse, landing, ["2024-02", "2024-01"], fx.EVENT_PARAMS, **OPTIONS)
    assert done == ["2024-01", "2024-02"]
    raw, flagged = warehouse.read("yellow_tripdata"), warehouse.read("int_trips__flagged")
    # Every loaded trip is labelled; rejected and valid trips add up; no copy is published.
    assert raw.count() == flagged.count()
    quality = warehouse.read("mart_data_quality").groupBy("status").agg(F.sum("nb_rows")).collect()
    assert sum(r[1] for r in quality) == raw.count()
    fact = warehouse.read("fct_trips")
    valid = flagged.where("rejection_reason IS NULL").count()
    assert fact.count() == fact.select("trip_sk").distinct().count() <= valid
    assert {r[0] for r in fact.select("source_file_month").distinct().collect()} == {JANUARY, FEBRUARY}
    revenue = warehouse.read("mart_daily_revenue").agg(F.sum("nb_trips")).first()[0]
    demand = warehouse.read("mart_zone_hourly_demand").agg(F.sum("nb_trips")).first()[0]
    assert revenue == demand == fact.count()
    assert warehouse.read("dim_date").count() == 91

    # The marts built from month partials equal aggregates over the whole fact.
    direct = fact.groupBy("pickup_zone_key", "pickup_hour", "is_weekend").agg(
        F.count(F.lit(1)).alias("nb_trips"), F.countDistinct("pickup_date").alias("nb_days"),
        F.avg("fare_amount").alias("fare"), F.avg("tip_rate_pct").alias("tip_rate"),
    )
    published = warehouse.read("mart_zone_hourly_demand")
    both = published.drop("nb_trips", "nb_days").join(direct, ["pickup_zone_key", "pickup_hour", "is_weekend"])
    assert both.count() == published.count() == direct.count()
    assert both.where("abs(avg_fare - fare) > 0.0051 OR abs(avg_tip_rate_pct_card - tip_rate) > 0.051").count() == 0
    counts = ["pickup_zone_key", "pickup_hour", "is_weekend", "nb_trips", "nb_days"]
    assert published.select(counts).exceptAll(direct.select(counts)).count() == 0

    # Replaying a month changes nothing anywhere.
    before = _snapshot(warehouse)
    monthly.run_month(warehouse, landing, "2024-01", fx.EVENT_PARAMS, **OPTIONS)
    assert _snapshot(warehouse) == before

    # A tightened threshold stops the month before the marts.
    strict = replace(fx.EVENT_PARAMS, max_rejection_rate=0.01, max_trip_distance_miles=1)
    with pytest.raises(gates.GateFailed, match="rejection_rate_ok"):
        monthly.run_month(warehouse, landing, "2024-01", strict, **OPTIONS)
    after = _snapshot(warehouse)
    changed = {table for table in TABLES if after[table] != before[table]}
    assert changed == {"int_trips__flagged", "int_trips__enriched"}

    # The next good run repairs it.
    monthly.run_month(warehouse, landing, "2024-01", fx.EVENT_PARAMS, **OPTIONS)
    assert _snapshot(warehouse) == before

    # A session without the catalog finds the tables again by their folder.
    reopened = Warehouse(spark, warehouse.root, warehouse.prefix + "again_")
    reopened.create()
    assert _snapshot(reopened) == before

    # Published names take plain SQL.
    top = spark.sql(
        f"SELECT z.zone_name, f.pickup_hour, count(*) AS n FROM {warehouse.name('fct_trips')} f "
        f"JOIN {warehouse.name('dim_zone')} z ON z.zone_key = f.pickup_zone_key "
        "GROUP BY 1, 2 ORDER BY n DESC LIMIT 10"
    )
    assert top.count() == 10
    comment = spark.catalog.getTable(warehouse.name("fct_trips")).description
    assert comment == "One row per valid trip"


def test_backfill_stops_at_the_first_failure(spark, warehouse, landing):
    # All pickups of the March file lie in January: nothing is valid.
    with pytest.raises(gates.GateFailed):
        monthly.backfill(warehouse, landing, ["2024-03", "2024-01"], fx.EVENT_PARAMS, **OPTIONS)
    months = {r[0] for r in warehouse.read("fct_trips").select("source_file_month").distinct().collect()}
    assert months == {JANUARY}
    # The stopped month is reported as soon as a later run publishes.
    monthly.run_month(warehouse, landing, "2024-02", fx.EVENT_PARAMS, **OPTIONS)
    files = {r[0] for r in warehouse.read("mart_data_quality").select("source_file").distinct().collect()}
    assert len(files) == 3
    with pytest.raises(ValueError):
        monthly.backfill(warehouse, landing, ["2024-02", "2024-2"], fx.EVENT_PARAMS, **OPTIONS)


def test_replacing_a_month_with_nothing_empties_it(spark, warehouse):
    flagged = flag_trips(stage_trips(fx.trips_from_events(spark, SF)), fx.EVENT_PARAMS)
    warehouse.append("int_trips__flagged", flagged)
    assert warehouse.read("int_trips__flagged").count() == 1050
    warehouse.replace_partition("int_trips__flagged", FEBRUARY, flagged.where("false"))
    left = warehouse.read("int_trips__flagged")
    assert left.where(F.col("source_file_month") == F.lit(FEBRUARY)).count() == 0
    assert left.count() == 1038
    warehouse.replace_partition(
        "int_trips__flagged", JANUARY, flagged.where(F.col("source_file_month") == F.lit(JANUARY))
    )
    assert warehouse.read("int_trips__flagged").count() == 1038


def test_rebuild_replaces_rows_and_columns(spark, warehouse):
    warehouse.rebuild("dim_vendor", spark.sql("SELECT 1 AS a"))
    warehouse.rebuild("dim_vendor", spark.sql("SELECT 2 AS b, 3 AS c"))
    assert [tuple(r) for r in warehouse.read("dim_vendor").collect()] == [(2, 3)]


def test_failed_replacement_keeps_the_month(spark, warehouse):
    flagged = flag_trips(stage_trips(fx.trips_from_events(spark, SF)), fx.EVENT_PARAMS)
    january = flagged.where(F.col("source_file_month") == F.lit(JANUARY))
    warehouse.replace_partition("int_trips__flagged", JANUARY, january)
    before = _content(warehouse, "int_trips__flagged")
    lost = F.when(F.col("fare_amount") > 50, F.raise_error(F.lit("lost"))).otherwise(F.lit("x"))
    with pytest.raises(Exception, match="lost"):
        warehouse.replace_partition("int_trips__flagged", JANUARY, january.withColumn("rejection_reason", lost))
    assert _content(warehouse, "int_trips__flagged") == before and len(before) == 1038
    # Replacing with nothing, twice, and filling again.
    for _ in range(2):
        warehouse.replace_partition("int_trips__flagged", JANUARY, january.where("false"))
        assert warehouse.read("int_trips__flagged").count() == 0
    warehouse.replace_partition("int_trips__flagged", JANUARY, january)
    assert _content(warehouse, "int_trips__flagged") == before


def test_failed_rebuild_keeps_the_previous_rows(spark, warehouse):
    for value in (1, 2, 3):
        warehouse.rebuild("dim_vendor", spark.sql(f"SELECT {value} AS a"))
    broken = spark.range(100).selectExpr("if(id = 77, cast(raise_error('lost') as int), 5) AS a")
    with pytest.raises(Exception, match="lost"):
        warehouse.rebuild("dim_vendor", broken)
    assert [r.a for r in warehouse.read("dim_vendor").collect()] == [3]


def test_create_is_repeatable(warehouse):
    warehouse.create()
    warehouse.create()
    assert warehouse.read("fct_trips").count() == 0
    with pytest.raises(ValueError):
        Warehouse(warehouse.spark, "/tmp/x", "Bad-Prefix")


def test_first_failure_of_parallel_jobs_is_raised():
    ran = []

    def fail():
        raise gates.GateFailed("no")

    with pytest.raises(gates.GateFailed):
        monthly.side_by_side(lambda: ran.append(1), fail, lambda: ran.append(2))
    assert sorted(ran) == [1, 2]


def test_months_outside_the_calendar_are_refused_before_loading(warehouse, landing):
    with pytest.raises(ValueError, match="outside the calendar"):
        monthly.backfill(warehouse, landing, ["2024-01", "2024-04"], fx.EVENT_PARAMS, **OPTIONS)
    with pytest.raises(ValueError, match="outside the calendar"):
        monthly.run_month(warehouse, landing, "2023-12", fx.EVENT_PARAMS, **OPTIONS)
    assert warehouse.read("yellow_tripdata").isEmpty()


def test_zones_are_loaded_once(spark, warehouse, landing):
    monthly.run_month(warehouse, landing, "2024-01", fx.EVENT_PARAMS, **OPTIONS)
    zones = _content(warehouse, "taxi_zone_lookup")
    warehouse.delete_path(f"{landing}/taxi_zone_lookup.csv")
    monthly.run_month(warehouse, landing, "2024-02", fx.EVENT_PARAMS, **OPTIONS)
    assert _content(warehouse, "taxi_zone_lookup") == zones


def test_readers_never_miss_a_table_that_is_rebuilt(spark, warehouse):
    from threading import Event, Thread

    warehouse.rebuild("dim_vendor", spark.range(3).selectExpr("id AS vendor_key"))
    seen, done = [], Event()

    def read():
        while not done.is_set():
            seen.append(spark.catalog.tableExists(warehouse.name("dim_vendor")))

    reader = Thread(target=read)
    reader.start()
    for n in (4, 5, 6):
        warehouse.rebuild("dim_vendor", spark.range(n).selectExpr("id AS vendor_key"))
    done.set()
    reader.join()
    assert seen and all(seen) and warehouse.read("dim_vendor").count() == 6
