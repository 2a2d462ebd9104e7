"""Exact medians against brute force."""

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.operators.medians import exact_medians

VALUES = st.one_of(
    st.none(),
    st.sampled_from([0.0, -0.0, 1.0, -1.0, 12.5, 1e-300, -1e300]),
    st.floats(allow_nan=False, allow_infinity=False, min_value=-1e6, max_value=1e6),
)
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), VALUES, VALUES), max_size=40)


def _brute(rows, column):
    groups = {}
    for row in rows:
        if row[column] is not None:
            groups.setdefault(row[0], []).append(row[column])
    return {key: statistics.median(values) for key, values in groups.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_matches_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, "g string, x double, y double")
    got = exact_medians(frame, ["g"], {"mx": F.col("x"), "my": F.col("y")}).collect()
    for name, column in (("mx", 1), ("my", 2)):
        expected = _brute(rows, column)
        found = {r.g: r[name] for r in got if r[name] is not None}
        assert found.keys() == expected.keys()
        for key, value in expected.items():
            assert math.isclose(found[key], value, rel_tol=1e-12, abs_tol=0.0) or found[key] == value


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 1001])
def test_one_dominant_group(spark, n):
    frame = spark.range(n).select((F.col("id") * 7919 % 1009 / 100).alias("v"))
    got = exact_medians(frame, [], {"m": F.col("v")}).first().m
    assert got == pytest.approx(statistics.median([i * 7919 % 1009 / 100 for i in range(n)]), rel=1e-12)


def test_heavy_repeats_and_rounding(spark):
    frame = spark.createDataFrame([("a", 1.005)] * 50 + [("a", 9.0)] * 49 + [("b", None)], "g string, v double")
    rows = exact_medians(frame, ["g"], {"m": F.col("v")}, digits=2).collect()
    assert [(r.g, r.m) for r in rows] == [("a", 1.01)]


def test_no_rows(spark):
    frame = spark.createDataFrame([], "g string, v double")
    assert exact_medians(frame, ["g"], {"m": F.col("v")}).collect() == []
    assert exact_medians(frame, [], {"m": F.col("v")}).first().m is None


def test_infinite_and_nan_sort_last(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (math.inf,), (3.0,), (math.nan,)], "v double")
    assert exact_medians(frame, [], {"m": F.col("v")}).first().m == 3.0
