"""Boundaries of each rule, precedence and recounts."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import GOOD_TRIP, SF
from tripmill import fixtures as fx
from tripmill.contracts import PipelineParams
from tripmill.operators.rules import anomaly_counts, anomaly_histogram, flag_trips, rejection_rules
from tripmill.operators.staging import stage_trips

PARAMS = PipelineParams()
START = GOOD_TRIP["pickup_at"]
CASES = [
    ({}, None),
    ({"pickup_at": None}, "timestamp_null"),
    ({"dropoff_at": None}, "timestamp_null"),
    ({"dropoff_at": START}, "duration_non_positive"),
    ({"dropoff_at": START - timedelta(seconds=1)}, "duration_non_positive"),
    ({"dropoff_at": START + timedelta(minutes=180)}, None),
    ({"dropoff_at": START + timedelta(minutes=180, seconds=1)}, "duration_too_long"),
    ({"pickup_at": datetime(2025, 1, 31, 23, 59, 59), "dropoff_at": datetime(2025, 2, 1, 0, 10)}, None),
    (
        {"pickup_at": datetime(2025, 2, 1), "dropoff_at": datetime(2025, 2, 1, 0, 10)},
        "pickup_outside_file_month",
    ),
    ({"trip_distance_miles": 100.0}, None),
    ({"trip_distance_miles": 100.01}, "distance_out_of_range"),
    ({"trip_distance_miles": 0.0}, "distance_out_of_range"),
    ({"trip_distance_miles": None}, None),
    ({"fare_amount": 0.0}, None),
    ({"fare_amount": -0.01}, "amount_non_positive"),
    ({"fare_amount": None}, None),
    ({"total_amount": 0.0}, "amount_non_positive"),
    ({"total_amount": None}, None),
    ({"total_amount": 1e6}, None),
    ({"pickup_zone_key": None}, "zone_null"),
    ({"dropoff_zone_key": None}, "zone_null"),
    # The first broken rule wins.
    ({"dropoff_at": START + timedelta(hours=4), "trip_distance_miles": 0.0}, "duration_too_long"),
]


def test_each_boundary(staged):
    flagged = flag_trips(staged(*[{**c, "passenger_count": i} for i, (c, _) in enumerate(CASES)]), PARAMS)
    got = {r.passenger_count: r.rejection_reason for r in flagged.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_duration_counts_second_boundaries(staged):
    trip = {
        "pickup_at": datetime(2025, 1, 1, 0, 0, 0, 900000),
        "dropoff_at": datetime(2025, 1, 1, 0, 0, 2, 100000),
    }
    row = flag_trips(staged(trip), PARAMS).first()
    assert row.trip_duration_min == pytest.approx(2 / 60)


def test_optional_amount_rule_comes_last(staged):
    params = PipelineParams(max_total_amount=500)
    rows = flag_trips(
        staged({"total_amount": 501.0}, {"total_amount": 500.0}, {"total_amount": 501.0, "fare_amount": -1.0}),
        params,
    ).collect()
    assert [r.rejection_reason for r in rows] == ["amount_too_high", None, "amount_non_positive"]
    assert len(rejection_rules(PARAMS)) == 7


def test_recount_is_independent_of_order(staged):
    twice = {"dropoff_at": START + timedelta(hours=4), "trip_distance_miles": 0.0}
    trips = staged(twice, {}, {"fare_amount": -1.0}, {"pickup_at": None})
    counts = anomaly_counts(trips, PARAMS).first()
    assert (counts.nb_trips, counts.duration_too_long, counts.distance_out_of_range) == (4, 1, 1)
    assert counts.at_least_one == 3
    histogram = {r.nb_anomalies: r.nb_trips for r in anomaly_histogram(trips, PARAMS).collect()}
    # The missing timestamp is a NULL rule, left out of the histogram.
    assert histogram == {0: 2, 1: 1, 2: 1}


@pytest.mark.parametrize(
    "view, params, expected",
    [
        (
            fx.trips_from_events,
            fx.EVENT_PARAMS,
            {
                (date(2024, 1, 1), None): 875,
                (date(2024, 1, 1), "duration_too_long"): 97,
                (date(2024, 1, 1), "distance_out_of_range"): 40,
                (date(2024, 1, 1), "timestamp_null"): 16,
                (date(2024, 1, 1), "zone_null"): 6,
                (date(2024, 1, 1), "amount_non_positive"): 4,
                (date(2024, 2, 1), "pickup_outside_file_month"): 12,
            },
        ),
    ],
)
def test_known_counts(spark, view, params, expected):
    flagged = flag_trips(stage_trips(view(spark, SF)), params)
    rows = flagged.groupBy("source_file_month", "rejection_reason").count().collect()
    assert {(r[0], r[1]): r[2] for r in rows} == expected


def test_union_of_rules_equals_rejected(spark):
    staged = stage_trips(fx.trips_from_lineitem(spark, SF)).cache()
    flagged = flag_trips(staged, fx.LINEITEM_PARAMS)
    rejected = flagged.where(F.col("rejection_reason").isNotNull()).count()
    counts = anomaly_counts(staged, fx.LINEITEM_PARAMS).first()
    histogram = {
        r.nb_anomalies: r.nb_trips for r in anomaly_histogram(staged, fx.LINEITEM_PARAMS).collect()
    }
    assert counts.at_least_one == rejected == 6000 - 1211
    assert sum(n for k, n in histogram.items() if k) == rejected
    each = sum(counts[r.reason] for r in rejection_rules(fx.LINEITEM_PARAMS))
    assert each == sum(k * n for k, n in histogram.items())
    staged.unpersist()


def test_labels_do_not_depend_on_the_session_zone(spark, staged):
    # 2025-03-09 02:30 does not exist in New York.
    trips = staged(
        {
            "pickup_at": datetime(2025, 3, 9, 1, 50),
            "dropoff_at": datetime(2025, 3, 9, 2, 30),
            "source_file_month": date(2025, 3, 1),
        }
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = flag_trips(trips, PARAMS).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.trip_duration_min, row.rejection_reason) == (40.0, None)
