"""Physical plans hold what the jobs rely on at scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmill import fixtures as fx
from tripmill.operators import analyses, dimensions
from tripmill.operators.rules import flag_trips
from tripmill.operators.staging import stage_trips
from tripmill.operators.trips import enrich_trips
from tripmill.registry import QUERIES, events, lines, zones



def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython",
                     "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_copies_are_dropped_before_the_shuffle(spark):
    lines_ = plan(events(spark, SF).enriched, "simple").splitlines()
    operators = [line.lstrip("+-:*() 0123456789").split(" ")[0] for line in lines_]
    limits = [i for i, name in enumerate(operators) if name == "WindowGroupLimit"]
    assert len(limits) == 2
    assert operators[limits[0]:limits[1] + 1] == ["WindowGroupLimit", "Sort", "Exchange", "WindowGroupLimit"]
    assert re.search(r"Exchange hashpartitioning\(_hash#\d+L, _key0#", lines_[limits[0] + 2])


def test_medians_never_hold_a_group(spark):
    text = plan(analyses.medians_by_payment(lines(spark, SF).fact, dimensions.payment_types(spark)))
    assert "percentile" not in text.lower() and "median(" not in text.lower()
    assert "ObjectHashAggregate" not in text and "collect_" not in text


def test_a_month_reads_only_its_file(spark, warehouse):
    warehouse.append("yellow_tripdata", fx.trips_from_events(spark, SF))
    staged = stage_trips(warehouse.read("yellow_tripdata"), date(2024, 2, 1))
    scan = plan(flag_trips(staged, fx.EVENT_PARAMS))
    filters = [line for line in scan.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 1 and "regexp_extract(_source_file" in filters[0]
    # The month is a constant of the plan, not work per row.
    assert scan.count("regexp") == filters[0].count("regexp")
    files = staged.inputFiles()
    assert files and all("2024-02" in f for f in files)


def test_fact_scans_prune_columns_and_push_filters(spark, warehouse):
    warehouse.append("fct_trips", events(spark, SF).fact)
    fact = warehouse.read("fct_trips")
    text = plan(analyses.tips_by_payment(fact, dimensions.payment_types(spark)))
    assert "ReadSchema: struct<payment_type_key:int,tip_amount:double>" in text
    text = plan(analyses.top_zone_hours(fact, zones(spark, SF)))
    assert "LessThanOrEqual(total_amount,500.0)" in text
    assert "trip_sk" not in text and "loaded_at" not in text


def test_dimensions_are_not_forced_into_a_broadcast(spark):
    """Without a size estimate below the threshold the joins fall back to sort-merge."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = analyses.tips_by_payment(events(spark, SF).fact, dimensions.payment_types(spark))
        text = plan(small)
        assert "BroadcastHashJoin" not in text and "BroadcastExchange" not in text
        assert small.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_medians_of_the_top_cells_shuffle_numbers(spark, warehouse):
    """Only trips of the ten cells are ranked, under the cell's number: names stay out of those shuffles."""
    warehouse.append("fct_trips", events(spark, SF).fact)
    text = plan(analyses.top_zone_hours(warehouse.read("fct_trips"), zones(spark, SF)), "simple")
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    ranked = [line for line in shuffles if "_m#" in line]
    assert ranked and all("cell#" in line and "zone#" not in line and "borough#" not in line for line in ranked)


def test_zone_names_join_after_aggregation(spark, warehouse):
    from tripmill.operators import marts

    demand = marts.zone_hourly_demand(marts.trip_cells(events(spark, SF).fact), zones(spark, SF))
    text = plan(demand, "simple")
    assert text.find("Join") < text.find("HashAggregate")


def test_enriched_filter_reaches_the_scan(spark, warehouse):
    flagged = events(spark, SF).flagged
    warehouse.append("int_trips__flagged", flagged)
    month = warehouse.read("int_trips__flagged").where(F.col("source_file_month") == F.lit(date(2024, 1, 1)))
    text = plan(enrich_trips(month))
    assert "PushedFilters: [IsNull(rejection_reason)]" in text
    assert any("source_file_month" in x for x in text.splitlines() if x.startswith("PartitionFilters"))
