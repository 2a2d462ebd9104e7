"""Gates pass only when every value is true."""

from datetime import date, datetime

import pytest

from tripmill.contracts import PipelineParams
from tripmill.operators import gates
from tripmill.operators.rules import flag_trips
from tripmill.operators.trips import enrich_trips

JANUARY = date(2025, 1, 1)


@pytest.mark.parametrize("value", ["false", "cast(null as boolean)", "0", "0.0"])
def test_false_null_and_zero_fail(spark, value):
    with pytest.raises(gates.GateFailed, match="bad"):
        gates.run_gate(spark.sql(f"SELECT true AS good, {value} AS bad"))


def test_true_passes_and_no_row_fails(spark):
    gates.run_gate(spark.sql("SELECT true AS a, 3 AS b"))
    with pytest.raises(gates.GateFailed):
        gates.run_gate(spark.sql("SELECT true AS a WHERE false"))


def test_duplicates_and_empty_month(staged):
    enriched = enrich_trips(flag_trips(staged({}, {"fare_amount": 3.0}), PipelineParams()))
    gates.run_gate(gates.trips_are_distinct(enriched, JANUARY))
    with pytest.raises(gates.GateFailed, match="no_duplicates"):
        gates.run_gate(gates.trips_are_distinct(enriched.unionAll(enriched), JANUARY))
    with pytest.raises(gates.GateFailed, match="month_not_empty"):
        gates.run_gate(gates.trips_are_distinct(enriched, date(2025, 2, 1)))


def test_rejection_rate_is_strict(staged):
    bad = {"fare_amount": -1.0}
    flagged = flag_trips(staged({}, {}, {}, bad), PipelineParams())
    at_limit = PipelineParams(max_rejection_rate=0.25)
    with pytest.raises(gates.GateFailed):
        gates.run_gate(gates.rejection_rate_is_low(flagged, JANUARY, at_limit))
    gates.run_gate(gates.rejection_rate_is_low(flagged, JANUARY, PipelineParams(max_rejection_rate=0.2501)))
    # An empty month has no rate.
    with pytest.raises(gates.GateFailed, match="None"):
        gates.run_gate(gates.rejection_rate_is_low(flagged, date(2025, 2, 1), at_limit))


def test_loaded_month(spark):
    raw = spark.createDataFrame([("a.parquet", datetime(2025, 1, 1))], "_source_file string, _loaded_at timestamp_ntz")
    gates.run_gate(gates.month_is_loaded(raw, "a.parquet"))
    with pytest.raises(gates.GateFailed):
        gates.run_gate(gates.month_is_loaded(raw, "b.parquet"))
