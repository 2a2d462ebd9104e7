"""One-step publication, ledger, resumed backfill, drift, views."""

import uuid
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.test_monthly import OPTIONS, TABLES, _content, landed, landing  # noqa: F401 - fixtures
from tests.test_plans import plan
from tripmill import fixtures as fx
from tripmill.operators import analyses, gates, marts
from tripmill.operators.rules import flag_trips
from tripmill.operators.staging import stage_trips, stage_zones
from tripmill.operators.trips import enrich_trips
from tripmill.plans import ledger, monthly
from tripmill.plans.manifests import PublicationConflict
from tripmill.plans.warehouse import Publication, Warehouse
from tripmill.registry import _land_trips, events, zones
from tripmill.sources.landing import parts_by_schema
from tripmill.streaming.arrivals import empty_month, forget_month, ingest_month, reload_month

PUBLISHED = [t for t in TABLES if t.startswith(("fct", "dim", "mart"))]
STAMP = datetime(2025, 2, 1, 12, 0, 0)


def published(warehouse):
    return {table: _content(warehouse, table) for table in PUBLISHED}


def run(warehouse, landing, month, **changes):
    params = replace(fx.EVENT_PARAMS, **changes)
    monthly.run_month(warehouse, landing, month, params, **OPTIONS)


@pytest.fixture(scope="module")
def house(spark, landed, tmp_path_factory):  # noqa: F811
    """January and February published."""
    found = Warehouse(spark, str(tmp_path_factory.mktemp("house") / "warehouse"), f"t_{uuid.uuid4().hex}_")
    first = None
    for month in ("2024-01", "2024-02"):
        run(found, landed, month)
        first = first or found.manifests.latest()
    return found, first


def test_a_crash_between_any_two_tables_leaves_the_previous_month(spark, warehouse, landing, monkeypatch):  # noqa: F811
    run(warehouse, landing, "2024-01")
    before, version = published(warehouse), warehouse.manifests.latest().version
    plain = Publication.write
    # A partial, the last table of a run, and the commit itself.
    for broken in ("int_trips__demand", "mart_daily_revenue", "commit"):

        def fail(self, table, *args, **kwargs):
            if table == broken:
                raise RuntimeError(f"lost before {table}")
            plain(self, table, *args, **kwargs)

        with monkeypatch.context() as patch:
            patch.setattr(Publication, "write", fail)
            if broken == "commit":
                patch.setattr(type(warehouse.manifests), "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before commit")))
            with pytest.raises(RuntimeError, match="lost before"):
                run(warehouse, landing, "2024-02")
        assert published(warehouse) == before
        assert warehouse.ledger.last("yellow_tripdata_2024-02.parquet").state == ledger.STOPPED
        # So do the catalog's tables.
        assert spark.table(warehouse.name("fct_trips")).count() == len(before["fct_trips"])
    run(warehouse, landing, "2024-02")
    assert len(published(warehouse)["fct_trips"]) > len(before["fct_trips"])
    assert warehouse.manifests.latest().version > version


def test_a_crash_after_the_manifest_is_repaired_by_the_next_create(spark, warehouse, landing, monkeypatch):  # noqa: F811
    run(warehouse, landing, "2024-01")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "follow", lambda *a: None)
        run(warehouse, landing, "2024-02")
    whole = published(warehouse)
    assert spark.table(warehouse.name("fct_trips")).count() < len(whole["fct_trips"])
    again = Warehouse(spark, warehouse.root, warehouse.prefix)
    again.create()
    for table in PUBLISHED:
        assert sorted(map(str, spark.table(warehouse.name(table)).collect())) == whole[table]


def test_manifests_are_numbered_once_and_torn_ones_are_passed_over(spark, warehouse):
    rows = spark.range(3).selectExpr("id AS a")
    first, second = warehouse.publication(), warehouse.publication()
    first.write("dim_vendor", rows)
    second.write("dim_vendor", rows.limit(1))
    first.commit()
    with pytest.raises(PublicationConflict):
        second.commit()
    assert warehouse.read("dim_vendor").count() == 3
    version = warehouse.manifests.latest().version
    with open(f"{warehouse.root}/manifests/manifest-{version + 1:010d}.json", "w") as torn:
        torn.write('{"version": 99, "tables": {"dim_ve')
    assert warehouse.manifests.latest().version == version
    warehouse.rebuild("dim_vendor", rows.limit(2))
    assert warehouse.read("dim_vendor").count() == 2 and warehouse.manifests.latest().version == version + 2


def test_a_snapshot_keeps_its_moment_and_old_folders_go(spark, warehouse):
    warehouse.rebuild("dim_vendor", spark.range(4))
    old = warehouse.snapshot()
    folder = old.manifest.tables["dim_vendor"].folders[""]
    warehouse.rebuild("dim_vendor", spark.range(9))
    assert (old.read("dim_vendor").count(), warehouse.read("dim_vendor").count()) == (4, 9)
    for _ in range(3):
        warehouse.rebuild("dim_vendor", spark.range(2))
    assert not warehouse.path_exists(f"{warehouse.root}/{folder}") and warehouse.read("dim_vendor").count() == 2
    with pytest.raises(LookupError):
        warehouse.read("mart_data_quality")


def test_months_prune_and_partitions_come_and_go(spark, warehouse):
    fact = events(spark, SF).fact
    warehouse.append("fct_trips", fact)
    month = warehouse.read("fct_trips").where(F.col("source_file_month") == F.lit(date(2024, 1, 1)))
    assert "PartitionFilters: [isnotnull(source_file_month" in plan(month)
    warehouse.replace_partition("fct_trips", date(2024, 2, 1), fact.limit(5))
    assert warehouse.read("fct_trips").count() == fact.count() + 5 == spark.table(warehouse.name("fct_trips")).count()
    warehouse.drop_partition("fct_trips", date(2024, 1, 1))
    assert warehouse.read("fct_trips").count() == 5 == spark.table(warehouse.name("fct_trips")).count()
    with pytest.raises(ValueError, match="columns of fct_trips differ"):
        warehouse.replace_partition("fct_trips", date(2024, 3, 1), fact.drop("vendor_key"))


def test_unchanged_dimensions_stay(spark, house, landed):  # noqa: F811
    warehouse, first = house
    first, second = first.tables, warehouse.manifests.latest().tables
    assert {t for t in PUBLISHED if first[t].folders != second[t].folders} == {
        "fct_trips", "mart_daily_revenue", "mart_zone_hourly_demand", "mart_data_quality"
    }
    assert second["dim_vendor"].folders == second["vendor_codes"].folders
    longer = replace(fx.EVENT_PARAMS, end_month=date(2024, 6, 1))
    later = warehouse.publication()
    monthly.publish_dimensions(later, landed, longer, fx.ZONE_OPTIONS)
    assert later.read("dim_date").count() == 152 and warehouse.read("dim_date").count() == 91
    assert later._tables["dim_zone"] == second["dim_zone"] and later._tables["dim_date"] != second["dim_date"]
    later.abandon()
    assert warehouse.read("dim_zone").count() == 25


def test_gates_come_from_the_jobs_that_write(spark, house, landed, monkeypatch):  # noqa: F811
    """No gate has a job of its own; what is observed equals what the gates' queries find."""
    warehouse, _ = house
    monkeypatch.setattr(gates, "run_gate", lambda check: pytest.fail("a gate was run as a query"))
    run(warehouse, landed, "2024-01")
    day = date(2024, 1, 1)
    values = monthly.publish_intermediate(warehouse.publication(), "2024-01", fx.EVENT_PARAMS)
    distinct = gates.trips_are_distinct(warehouse.read("int_trips__enriched"), day).first().asDict()
    rate = gates.rejection_rate_is_low(warehouse.read("int_trips__flagged"), day, fx.EVENT_PARAMS).first().asDict()
    assert values == {**distinct, **rate}
    counts = marts.status_counts(warehouse.read("int_trips__flagged"))
    kept = warehouse.read("int_trips__status_counts").select(counts.columns)
    assert sorted(map(str, counts.collect())) == sorted(map(str, kept.collect()))


def test_kept_rows_are_counted_without_a_second_shuffle(spark, staged):
    flagged = flag_trips(staged({}, {}, {"fare_amount": 3.0}), fx.PipelineParams())
    kept = enrich_trips(flagged, "_kept")
    text = plan(kept, "simple")
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 2  # before and after it
    assert [r._kept for r in kept.collect()] == [1, 1]
    assert sorted(map(str, kept.drop("_kept").collect())) == sorted(map(str, enrich_trips(flagged).collect()))
    for metrics, passes in (({"rows": 0, "most": None}, False), ({"rows": 2, "most": 2}, False), ({"rows": 2, "most": 1}, True)):
        assert all(gates.observed_distinct(metrics).values()) == passes


def test_flagship_and_demand_come_from_partials(spark, house):
    warehouse, _ = house
    top = monthly.top_zone_hours(warehouse)
    assert "fct_trips" not in plan(top)
    fact, zone = warehouse.read("fct_trips"), warehouse.read("dim_zone")
    assert list(map(str, top.collect())) == list(map(str, analyses.top_zone_hours(fact, zone).collect()))
    # However many days: a row per zone, hour and weekend flag of a month.
    demand = warehouse.read("int_trips__demand")
    assert demand.count() == demand.select("pickup_zone_key", "pickup_hour", "is_weekend", "source_file_month").distinct().count()
    days = fact.groupBy("pickup_zone_key", "pickup_hour", "is_weekend").agg(F.countDistinct("pickup_date").alias("nb_days"))
    mart = warehouse.read("mart_zone_hourly_demand").select(*days.columns)
    assert mart.exceptAll(days).count() == days.exceptAll(mart).count() == 0


def test_days_of_far_years_are_counted(spark):
    """Days fall into bitmaps of 32,768; a zone may have trips in several, and before 1970."""
    days = ["1901-05-05", "1969-12-31", "1970-01-01", "2024-02-29", "2060-01-01", "2060-01-01", "2200-07-07"]
    rows = spark.createDataFrame([(1, date.fromisoformat(d), 8, False, 1.0) for d in days],
                                 "pickup_zone_key int, pickup_date date, pickup_hour int, is_weekend boolean, x double")
    names = [f"{n}_{k}" for n in ("total", "fare", "distance", "duration", "speed", "tip_rate") for k in ("sum", "n")]
    cells = rows.withColumns({"trips": F.lit(1), "source_file_month": F.lit(date(2024, 1, 1)), **{n: F.col("x") for n in names}})
    got = marts.zone_hourly_demand(cells, zones(spark, SF)).collect()
    assert len(got) == 1 and (got[0].nb_trips, got[0].nb_days) == (7, 6)


def test_the_ledger_tells_a_changed_file(spark, warehouse, landing):  # noqa: F811
    name, months = "yellow_tripdata_2024-01.parquet", fx.trips_from_events(spark, SF)
    rows = ingest_month(warehouse, landing, "2024-01", STAMP)
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == rows
    warehouse.delete_path(f"{landing}/{name}")
    _land_trips(months.where("payment_type < 4"), landing, "2024-01")
    # Its rows stay until they are asked for.
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == rows
    fewer = reload_month(warehouse, landing, "2024-01", STAMP)
    assert 0 < fewer < rows and warehouse.read("yellow_tripdata").count() == fewer
    empty_month(warehouse, "2024-01")
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == 0
    forget_month(warehouse, "2024-01")
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == fewer
    found = [(e.event, e.state, e.nb_rows) for e in warehouse.ledger.events().orderBy("event").collect()]
    states = ["loaded", "again", "changed", "forgotten", "loaded", "emptied", "again", "forgotten", "loaded"]
    assert found == list(zip(range(1, 10), states, [rows, rows, rows, 0, fewer, 0, 0, 0, fewer]))
    last = warehouse.ledger.last(name, ledger.LOADED)
    assert last.file_size > 0 and datetime.fromisoformat(last.file_time)
    assert Warehouse(spark, f"{warehouse.root}/none").ledger.events().count() == 0


def test_backfill_goes_on_where_it_stopped(spark, warehouse, landing):  # noqa: F811
    months = ["2024-01", "2024-02", "2024-03"]
    # All pickups of the March file lie in January.
    with pytest.raises(gates.GateFailed):
        monthly.backfill(warehouse, landing, months, fx.EVENT_PARAMS, resume=True, **OPTIONS)
    before = published(warehouse)
    good = fx.trips_from_events(spark, SF).withColumns(
        {c: F.expr(f"{c} + interval 60 days") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
        | {"_source_file": F.lit("yellow_tripdata_2024-03.parquet")}
    )
    warehouse.delete_path(f"{landing}/yellow_tripdata_2024-03.parquet")
    _land_trips(good, landing, "2024-03")
    assert monthly.backfill(warehouse, landing, months, fx.EVENT_PARAMS, resume=True, **OPTIONS) == ["2024-03"]
    assert {r[0].month for r in warehouse.read("fct_trips").select("source_file_month").distinct().collect()} == {1, 2, 3}
    assert len(published(warehouse)["mart_daily_revenue"]) > len(before["mart_daily_revenue"])
    # Nothing is left to do; other rules make all months outstanding; a longer calendar none.
    assert monthly.backfill(warehouse, landing, months, fx.EVENT_PARAMS, resume=True, **OPTIONS) == []
    longer = replace(fx.EVENT_PARAMS, end_month=date(2024, 7, 1))
    assert monthly.backfill(warehouse, landing, months, longer, resume=True, **OPTIONS) == []
    stricter = replace(fx.EVENT_PARAMS, max_trip_distance_miles=14)
    assert monthly._outstanding(warehouse, landing, months[0], stricter, OPTIONS)


def test_a_retyped_key_column_stops_the_month(spark, warehouse, landing):  # noqa: F811
    raw = fx.trips_from_events(spark, SF).withColumn("_source_file", F.lit("yellow_tripdata_2024-03.parquet"))
    _land_trips(raw, landing, "2024-03", vendorid=F.col("vendorid").cast("string"), extra_column=F.lit(1))
    with pytest.raises(gates.GateFailed, match="vendorid_retyped"):
        run(warehouse, landing, "2024-03")
    assert warehouse.read("yellow_tripdata").isEmpty()
    report = {(d.column_name, d.problem): d for d in gates.drift(parts_by_schema(spark, f"{landing}/yellow_tripdata_2024-03.parquet"))}
    assert report["vendorid", "retyped"].stops and report["vendorid", "retyped"].nb_rows == raw.count()
    assert not report["extra_column", "new"].stops
    # A wider or narrower whole number, or a whole amount, loses nothing; a missing key does.
    run(warehouse, landing, "2024-01")
    part = parts_by_schema(spark, f"{landing}/yellow_tripdata_2024-01.parquet")[0]
    narrow = spark.sql("SELECT 1S AS vendorid, 2 AS fare_amount, 1.5F AS total_amount, 2.5D AS pulocationid").schema
    stops = {d.column_name for d in gates.drift([part._replace(schema=narrow)]) if d.stops}
    assert stops == set(gates.KEY_COLUMNS) - {"vendorid", "fare_amount", "total_amount"}


def test_footers_are_read_in_tasks(spark, landing):  # noqa: F811
    path = f"{landing}/yellow_tripdata_2024-05.parquet"
    spark.range(10, numPartitions=4).selectExpr("id AS vendorid").write.parquet(path)
    spark.range(7, numPartitions=2).selectExpr("cast(id AS double) AS vendorid").write.mode("append").parquet(path)
    found = parts_by_schema(spark, path)
    assert sorted((p.nb_rows, len(p.paths), p.schema[0].dataType.simpleString()) for p in found) == [(7, 2, "double"), (10, 4, "bigint")]
    assert all(p.size > 0 and p.newest for p in found)
    assert parts_by_schema(spark, f"{landing}/yellow_tripdata_2024-01.parquet")[0].nb_rows > 0


def test_views_are_the_job_s_own_columns(spark, house):
    warehouse, other = house[0], spark.newSession()
    for view, table, staged in (("stg_tlc__yellow_trips", "yellow_tripdata", stage_trips), ("stg_tlc__taxi_zones", "taxi_zone_lookup", stage_zones)):
        seen, made = other.table(f"{warehouse.prefix}staging.{view}"), staged(warehouse.read(table))
        assert seen.dtypes == made.dtypes
        assert sorted(map(str, seen.collect())) == sorted(map(str, made.collect()))
