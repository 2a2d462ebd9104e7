"""Marts on hand-written facts."""

from datetime import date, datetime

from tripmill.contracts import PipelineParams
from tripmill.operators import dimensions as dim
from tripmill.operators import marts
from tripmill.operators.rules import flag_trips
from tripmill.operators.trips import build_fact, enrich_trips


def _fact(staged, *changes):
    return build_fact(enrich_trips(flag_trips(staged(*changes), PipelineParams())))


def _on(day, hour=8, **changes):
    return {
        "pickup_at": datetime(2025, 1, day, hour), "dropoff_at": datetime(2025, 1, day, hour, 30), **changes
    }


def test_daily_revenue_joins(spark, staged):
    fact = _fact(
        staged,
        _on(1, total_amount=10.0),
        _on(1, total_amount=20.0, extra_amount=None),
        _on(1, total_amount=5.0, payment_type_key=None),
        _on(1, total_amount=7.0, payment_type_key=42),
        _on(31, total_amount=99.0),
    )
    days = dim.calendar(spark, date(2025, 1, 1), date(2025, 2, 1)).where("full_date < DATE '2025-01-31'")
    rows = marts.daily_revenue(marts.trip_cells(fact), days, dim.payment_types(spark)).collect()
    by = {r.payment_type_label: r for r in rows}
    # The 31st is outside the calendar; an unknown code and a NULL code share the NULL label.
    assert set(by) == {"Credit card", None}
    card, unlabelled = by["Credit card"], by[None]
    assert (card.nb_trips, card.total_revenue, card.avg_revenue_per_trip) == (2, 30.0, 15.0)
    # One NULL surcharge is ignored by the sum.
    assert card.total_surcharges == 5.75
    assert (unlabelled.nb_trips, unlabelled.total_revenue) == (2, 12.0)


def test_demand_divides_by_active_days_and_keeps_unknown_zones(spark, staged):
    fact = _fact(
        staged,
        _on(6), _on(6, fare_amount=30.0), _on(8, fare_amount=40.0),
        _on(6, pickup_zone_key=77, fare_amount=None, payment_type_key=2),
    )
    zones = dim.dim_zone(
        spark.createDataFrame([(10, "Ten", "Queens", "x")],
                              "zone_key int, zone_name string, borough string, service_zone string")
    )
    rows = marts.zone_hourly_demand(marts.trip_cells(fact), zones).collect()
    by = {r.pickup_zone_key: r for r in rows}
    assert (by[10].nb_trips, by[10].nb_days, by[10].avg_trips_per_day) == (3, 2, 1.5)
    assert (by[10].avg_fare, by[10].pickup_zone_name) == (30.0, "Ten")
    # 29.75 a trip, half an hour each.
    assert by[10].revenue_per_hour_driven == 59.5
    assert (by[77].pickup_zone_name, by[77].avg_fare, by[77].avg_tip_rate_pct_card) == (None, None, None)


def test_quality_shares(spark, staged):
    flagged = flag_trips(
        staged({}, {"fare_amount": 1.0}, {"fare_amount": -1.0}, {"source_file": None}), PipelineParams()
    )
    rows = marts.data_quality(marts.status_counts(flagged)).collect()
    got = {(r.source_file, r.status): (r.nb_rows, r.nb_rows_total, r.pct_of_file) for r in rows}
    name = "yellow_tripdata_2025-01.parquet"
    assert got == {
        (name, "valid"): (2, 3, 66.667),
        (name, "amount_non_positive"): (1, 3, 33.333),
    }
