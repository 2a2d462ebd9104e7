"""Calendar, zones and code tables."""

from datetime import date

import pytest

from tripmill.operators import dimensions as dim


def test_calendar_bounds_and_names(spark):
    days = {r.full_date: r for r in dim.calendar(spark, date(2025, 1, 1), date(2025, 4, 1)).collect()}
    assert len(days) == 90 and min(days) == date(2025, 1, 1) and max(days) == date(2025, 3, 31)
    saturday = days[date(2025, 2, 1)]
    assert (saturday.date_key, saturday.quarter, saturday.month_name) == (20250201, 1, "Feb")
    assert (saturday.day_of_week_iso, saturday.day_name, saturday.is_weekend) == (6, "Sat", True)
    assert days[date(2025, 1, 5)].day_of_week_iso == 7 and days[date(2025, 1, 6)].is_weekend is False


def test_calendar_is_not_capped(spark):
    assert dim.calendar(spark, date(2020, 1, 1), date(2025, 1, 1)).count() == 1827


def test_calendar_refuses_an_empty_range(spark):
    with pytest.raises(ValueError):
        dim.calendar(spark, date(2025, 1, 1), date(2025, 1, 1))


def test_zone_flags_with_production_values(spark):
    rows = [
        (1, "Newark Airport", "EWR", "EWR"),
        (132, "JFK AIRPORT", "Queens", "Airports"),
        (43, "Central Park", "Manhattan", "Yellow Zone"),
        (2, None, "EWR", "EWR"),
        (3, None, "Queens", "Boro Zone"),
        (4, "Some airport", None, None),
        (264, None, "Unknown", None),
        (265, "Outside", "N/A", None),
    ]
    zones = spark.createDataFrame(rows, "zone_key int, zone_name string, borough string, service_zone string")
    flags = {r.zone_key: (r.is_airport, r.is_unknown_zone) for r in dim.dim_zone(zones).collect()}
    assert flags == {
        1: (True, False), 132: (True, False), 43: (False, False), 2: (True, False),
        3: (None, False), 4: (True, False), 264: (None, True), 265: (False, True),
    }


def test_code_tables(spark):
    payments = {r[0]: r[1] for r in dim.payment_types(spark).collect()}
    assert payments[1] == "Credit card" and sorted(payments) == [0, 1, 2, 3, 4, 5, 6]
    assert sorted(r[0] for r in dim.rate_codes(spark).collect()) == [1, 2, 3, 4, 5, 6, 99]
    assert {r[0]: r[1] for r in dim.vendors(spark).collect()}[1] == "Creative Mobile Technologies, LLC"
    assert [t.simpleString() for t in (f.dataType for f in dim.vendors(spark).schema)] == ["int", "string"]
