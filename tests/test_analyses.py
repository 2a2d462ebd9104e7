"""Q1, Q4-Q15, P19, P20, J5-J7, T1q-T4q."""

from datetime import datetime

import pytest

from tests.test_marts import _fact, _on
from tripmill.operators import analyses as an
from tripmill.operators import dimensions as dim


@pytest.fixture
def zones(spark):
    rows = [(10, "Ten", "Queens", "x"), (11, "Ten", "Queens", "x"), (20, "Twenty", "Bronx", "x"),
            (264, "Nowhere", "Unknown", "x")]
    return dim.dim_zone(
        spark.createDataFrame(rows, "zone_key int, zone_name string, borough string, service_zone string")
    )


def test_top_zone_hours_merges_zones_of_one_name(spark, staged, zones):
    fact = _fact(
        staged,
        _on(1, fare_amount=10.0, total_amount=12.0),
        _on(2, fare_amount=20.0, total_amount=22.0, pickup_zone_key=11, payment_type_key=2),
        _on(2, fare_amount=60.0, total_amount=62.0, pickup_zone_key=11, payment_type_key=0),
        _on(1, total_amount=500.01),
        _on(1, fare_amount=1.0, payment_type_key=3),
        _on(1, fare_amount=2.0, payment_type_key=None),
        _on(1, fare_amount=3.0, pickup_zone_key=264),
        _on(1, fare_amount=4.0, pickup_zone_key=999),
        _on(1, hour=9, pickup_zone_key=20, total_amount=500.0),
    )
    first, second = an.top_zone_hours(fact, zones).collect()
    assert (first.zone, first.borough, first.pickup_hour, first.nb_trips) == ("Ten", "Queens", 8, 3)
    # Three trips on two days round half up.
    assert first.trips_per_day == 2.0
    assert (first.avg_fare, first.median_fare, first.avg_total) == (30.0, 20.0, 32.0)
    assert (first.card_share_pct, first.avg_total_card, first.avg_total_cash) == (33.3, 12.0, 22.0)
    assert (second.zone, second.nb_trips, second.avg_total_cash) == ("Twenty", 1, None)
    assert [r.zone for r in an.top_zone_hours(fact, zones, k=1).collect()] == ["Ten"]


def test_outlier_study(spark, staged, zones):
    fact = _fact(
        staged,
        *[_on(d, fare_amount=float(d), total_amount=float(d), payment_type_key=3) for d in range(1, 8)],
        _on(9, total_amount=132555.0, payment_type_key=3),
        _on(9, total_amount=6.0, payment_type_key=1),
    )
    share = an.outlier_share(fact).first()
    assert (share.nb_outliers, share.share_pct) == (1, 11.111)
    top = an.top_outliers(fact, zones, "Ten", 8, 3).collect()
    assert [r.total_amount for r in top] == [132555.0, 7.0, 6.0, 5.0, 4.0]
    robust = an.robust_mean_and_median(fact, zones, "Ten", 8, 100000).first()
    assert (robust.avg_total_without_outliers, robust.median_total) == (4.25, 4.5)
    mix = an.payment_mix(fact, zones, dim.payment_types(spark), "Ten", 8).collect()
    assert [(r.payment_type_label, r.nb_trips) for r in mix] == [("No charge", 8), ("Credit card", 1)]


def test_outlier_share_of_nothing(spark, staged):
    share = an.outlier_share(_fact(staged, {}).where("false")).first()
    assert (share.nb_outliers, share.share_pct) == (0, None)


def test_payment_study(spark, staged):
    fact = _fact(
        staged,
        _on(1, tip_amount=3.0, fare_amount=10.0, trip_distance_miles=2.0),
        _on(2, tip_amount=0.0, fare_amount=20.0, trip_distance_miles=5.0),
        _on(3, payment_type_key=2, tip_amount=0.0, fare_amount=9.0, trip_distance_miles=3.0),
        _on(4, payment_type_key=77),
    )
    payments = dim.payment_types(spark)
    tips = {r.payment_type_label: r for r in an.tips_by_payment(fact, payments).collect()}
    assert set(tips) == {"Credit card", "Cash"}
    assert (tips["Credit card"].avg_tip, tips["Credit card"].tipped_share_pct) == (1.5, 50.0)
    fares = {r.payment_type_label: r.avg_fare for r in an.fare_by_payment(fact, payments).collect()}
    assert fares == {"Credit card": 15.0, "Cash": 9.0}
    medians = {r.payment_type_label: r for r in an.medians_by_payment(fact, payments).collect()}
    card = medians["Credit card"]
    assert (card.median_distance, card.median_fare, card.median_price_per_mile) == (3.5, 15.0, 4.5)
    assert (card.nb_trips, card.avg_fare) == (2, 15.0)


def test_usage_window_is_inclusive(spark):
    rows = [("a", datetime(2024, 1, 1), 1.0005, 1.0, 0.5), ("a", datetime(2024, 1, 1, 5), 2.0, 1.5, 0.5),
            ("b", datetime(2023, 12, 31, 23, 59, 59), 9.0, 9.0, 0.0)]
    usage = spark.createDataFrame(
        rows, "entity string, start_time timestamp_ntz, usage double, usage_compute double, usage_services double"
    )
    as_of = datetime(2024, 1, 31)
    assert [tuple(r)[::2] for r in an.usage_by_day(usage, as_of).collect()] == [("a", 3.001)]
    total = an.usage_totals(usage, as_of).collect()
    assert [(r.entity, r.usage_compute, r.active_hours) for r in total] == [("a", 2.5, 2)]


def test_counts_and_rates(spark, staged):
    from tripmill.contracts import PipelineParams
    from tripmill.operators.rules import flag_trips

    trips = staged({}, {"fare_amount": -1.0}, {"fare_amount": 2.0})
    counts = an.table_counts({"a": trips, "b": trips.limit(1)})
    assert {r.table_name: r.nb_rows for r in counts.collect()} == {"a": 3, "b": 1}
    rate = an.rejection_rate_by_month(flag_trips(trips, PipelineParams())).first()
    assert (rate.nb_trips, rate.nb_rejected, rate.rejection_rate_pct) == (3, 1, 33.33)


def test_plain_sample(spark, staged):
    assert staged({}, {}, {}).limit(2).count() == 2
