"""Staging, deduplication, derived measures, fact."""

from datetime import date, datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmill import fixtures as fx
from tripmill.contracts import (
    BUSINESS_KEY, ENRICHED_TRIPS, FACT_TRIPS, FLAGGED_TRIPS, RAW_TRIPS, STAGED_TRIPS, PipelineParams,
)
from tripmill.functions import key_values, round_rows, round_to
from tripmill.operators.rules import flag_trips
from tripmill.operators.staging import stage_trips, stage_zones
from tripmill.operators.trips import (
    build_fact, enrich_trips, keep_first_copy,
)

PARAMS = PipelineParams()


def _types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_staging_defaults_and_types(spark):
    raw = dict.fromkeys(RAW_TRIPS.names)
    raw |= {"_source_file": "yellow_tripdata_2025-03.parquet", "store_and_fwd_flag": "Y"}
    bare = {**raw, "_source_file": "no_month.parquet", "store_and_fwd_flag": None}
    frame = spark.createDataFrame([tuple(raw.values()), tuple(bare.values())], RAW_TRIPS)
    staged = stage_trips(frame)
    assert _types(staged.schema) == _types(STAGED_TRIPS)
    first, second = staged.collect()
    assert first.rate_code_key == 99
    assert (first.congestion_surcharge_amount, first.airport_fee_amount) == (0.0, 0.0)
    assert first.cbd_congestion_fee_amount == 0.0
    assert first.extra_amount is None and first.tip_amount is None
    assert first.is_store_and_forward is True and second.is_store_and_forward is None
    assert first.source_file_month == date(2025, 3, 1) and second.source_file_month is None


def test_staging_of_one_month_equals_the_filtered_whole(spark):
    raw = fx.trips_from_events(spark, SF)
    month = date(2024, 2, 1)
    whole = stage_trips(raw).where(F.col("source_file_month") == F.lit(month))
    one = stage_trips(raw, month)
    assert _types(one.schema) == _types(whole.schema)
    assert sorted(map(str, one.collect())) == sorted(map(str, whole.collect()))


def test_staging_keeps_every_row(spark):
    raw = fx.trips_from_events(spark, SF)
    assert stage_trips(raw).count() == raw.count() == 1050


def test_schemas_along_the_way(staged):
    flagged = flag_trips(staged({}), PARAMS)
    enriched = enrich_trips(flagged)
    assert _types(flagged.schema) == _types(FLAGGED_TRIPS)
    assert _types(enriched.schema) == _types(ENRICHED_TRIPS)
    assert _types(build_fact(enriched).schema) == _types(FACT_TRIPS)


def test_first_load_wins_and_null_keys_are_one_group(staged):
    trips = staged(
        {"loaded_at": datetime(2025, 2, 2), "passenger_count": 9},
        {"loaded_at": datetime(2025, 2, 1), "passenger_count": 3},
        {"vendor_key": None, "passenger_count": 5},
        {"vendor_key": None, "passenger_count": 4},
        {"fare_amount": 21.0},
    )
    kept = sorted(
        (str(r.vendor_key), r.fare_amount, r.passenger_count) for r in keep_first_copy(trips).collect()
    )
    assert kept == [("2", 20.0, 3), ("2", 21.0, 1), ("None", 20.0, 4)]


def test_one_trip_copied_thousands_of_times(spark, staged):
    copies = staged({}).crossJoin(spark.range(5000).select(F.col("id").alias("n")))
    copies = copies.withColumn("passenger_count", F.col("n").cast("int")).drop("n").repartition(8)
    kept = keep_first_copy(copies).collect()
    assert [r.passenger_count for r in kept] == [0]


def test_a_code_beyond_32_bits_is_null(spark):
    raw = dict.fromkeys(RAW_TRIPS.names)
    raw |= {"_source_file": "yellow_tripdata_2025-03.parquet", "pulocationid": 5_000_000_000, "dolocationid": 7}
    row = stage_trips(spark.createDataFrame([tuple(raw.values())], RAW_TRIPS)).first()
    assert row.pickup_zone_key is None and row.dropoff_zone_key == 7


def test_as_many_rows_as_keys(staged):
    """Copies and keys agree on amounts beyond the tenth decimal, on zeros, NULLs and what no decimal holds."""
    rows = flag_trips(
        staged(
            {"trip_distance_miles": 0.1 + 0.2}, {"trip_distance_miles": 0.3},
            {"fare_amount": 5.0}, {"fare_amount": 5.0 + 1e-12}, {"fare_amount": 5.0 + 1e-6},
            {"vendor_key": None, "fare_amount": 0.0}, {"vendor_key": None, "fare_amount": -0.0},
            {"total_amount": 1e25}, {"total_amount": 1e25}, {"total_amount": 2e25},
        ),
        PARAMS,
    )
    kept = enrich_trips(rows).collect()
    assert len(kept) == len({r.trip_sk for r in kept}) == 6


def test_derived_measures(staged):
    rows = enrich_trips(
        flag_trips(
            staged(
                {"pickup_at": datetime(2025, 1, 18, 23, 45), "dropoff_at": datetime(2025, 1, 19, 0, 9, 20),
                 "passenger_count": 1},
                {"payment_type_key": 2, "passenger_count": 2, "fare_amount": 20.5},
                {"fare_amount": 0.0, "passenger_count": 3},
            ),
            PARAMS,
        )
    ).collect()
    by = {r.passenger_count: r for r in rows}
    saturday = by[1]
    assert (saturday.pickup_date, saturday.pickup_date_key) == (date(2025, 1, 18), 20250118)
    assert (saturday.pickup_hour, saturday.pickup_day_of_week_iso, saturday.is_weekend) == (23, 6, True)
    assert (saturday.trip_duration_min, saturday.avg_speed_mph) == (24.33, 12.33)
    assert saturday.tip_rate_pct == 20.0
    # Cash and a zero fare have no tip rate.
    assert by[2].tip_rate_pct is None and by[3].tip_rate_pct is None


def test_surcharges_depend_on_the_vendor(staged):
    trips = staged(
        {"vendor_key": 1}, {"vendor_key": 2}, {"vendor_key": None}, {"vendor_key": 6, "extra_amount": None}
    )
    fact = build_fact(enrich_trips(flag_trips(trips, PARAMS))).collect()
    assert {r.vendor_key: r.surcharges_amount for r in fact} == {1: 2.5, 2: 5.75, None: 5.75, 6: None}


def test_trip_key_is_unique_and_stable(spark):
    flagged = flag_trips(stage_trips(fx.trips_from_events(spark, SF)), fx.EVENT_PARAMS)
    enriched = enrich_trips(flagged)
    once = enriched.select("trip_sk", *BUSINESS_KEY).collect()
    assert len({r.trip_sk for r in once}) == len(once) == 831
    again = enrich_trips(flagged.repartition(3)).select("trip_sk", *BUSINESS_KEY).collect()
    assert set(once) == set(again)


def test_trip_key_of_huge_amounts(staged):
    trips = staged({"total_amount": 1e30}, {"total_amount": 2e30})
    rows = enrich_trips(flag_trips(trips, PARAMS)).collect()
    assert len({r.trip_sk for r in rows}) == 2


def test_zone_staging(spark):
    raw = spark.createDataFrame(
        [Row(locationid=1, borough="EWR", zone="Newark Airport", service_zone="EWR",
             _source_file="taxi_zone_lookup.csv", _loaded_at=datetime(2025, 1, 1))]
    )
    row = stage_zones(raw).first()
    assert (row.zone_key, row.zone_name, row.borough) == (1, "Newark Airport", "EWR")


def test_next_event_is_found_across_minutes(spark):
    """The look-ahead of the event view equals a plain window over each user."""
    from pyspark.sql import Window

    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_id", "ts", "user_id", "cast(get_json_object(props, '$.k') as int) as k"
    )
    # Squeeze the month into a few minutes so that minutes hold several events.
    events = events.withColumn(
        "ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id % 977)")
    )
    per_user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = events.select(
        "*", F.lead("ts").over(per_user).alias("next_ts"), F.lead("k").over(per_user).alias("next_k")
    )
    ours = fx._with_next_event(events)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_amounts_group_as_their_ten_decimals(spark):
    """Keys in whole steps put together what decimals put together, however near to a step or to the limit."""
    near = [0.3, 0.1 + 0.2, 5.0, 5.0 + 1e-12, 5.0 + 4e-11, 5.0 + 6e-11, 5.0 + 1e-10, 9999.99999999999, 1e4, 10000.0001]
    apart = [0.0, -0.0, 0.00005, 1e-10, 4e-11, 123456.78, 123456.78 + 1e-11, 1e25, 2e25, float("nan"), float("inf"), None]
    amounts = [*near, *apart, *[-x for x in near], *[n / 7 for n in range(200)], *[n / 100 - 0.5 for n in range(200)]]
    rows = spark.createDataFrame([(2, x, 1.0, 1.0) for x in amounts], "vendor_key int, fare_amount double, total_amount double, trip_distance_miles double")
    rows = rows.withColumns({c: F.lit(None).cast("int") for c in BUSINESS_KEY if c not in rows.columns})
    fixed = F.col("fare_amount").try_cast("decimal(28,10)")
    by_decimal = rows.groupBy(fixed, F.when(fixed.isNull(), F.col("fare_amount"))).agg(F.count("*").alias("n"))
    by_key = rows.groupBy(*key_values()).agg(F.count("*").alias("n"), F.countDistinct(fixed).alias("different"))
    assert sorted(r.n for r in by_key.collect()) == sorted(r.n for r in by_decimal.collect())
    assert max(r.different for r in by_key.collect()) == 1


def test_most_amounts_need_no_decimal(staged):
    """A decimal is made from a double's text; ordinary amounts are compared as whole numbers, by one hash first."""
    trips = staged({}, {"fare_amount": 21.5}, {"fare_amount": -21.55})
    keys = trips.select(*[value.alias(f"k{i}") for i, value in enumerate(key_values())]).collect()
    whole = [(r.k5, r.k6, r.k7, r.k8) for r in keys]
    assert all(isinstance(w, int) and (d, x) == (None, None) and isinstance(f, int) for w, d, x, f in whole)
    plan = keep_first_copy(trips)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(_hash" in plan


def test_rows_are_rounded_as_decimals_are(spark):
    values = [0.005, 0.015, 1.005, 2.675, -0.005, -0.001, -1.005, 0.00499999999996, 0.0049999, 1e6, 999999.995, 1e25, None]
    values += [float("nan"), float("inf"), 0.1 + 0.2, *[n / 1000 for n in range(-300, 300)], *[n / 7 for n in range(300)]]
    rows = spark.createDataFrame([(x,) for x in values], "x double")
    both = rows.select(*[f(F.col("x"), 2).cast("string").alias(f.__name__) for f in (round_rows, round_to)])
    assert [r for r in both.collect() if r.round_rows != r.round_to] == []
