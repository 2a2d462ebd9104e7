"""Rejection rules.

One ordered list feeds the label, the independent recount and the per-trip
histogram, so the three cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.contracts import PipelineParams
from tripmill.functions import seconds_between


class Rule(NamedTuple):
    reason: str
    broken: Column
    tests_null: bool = False


def rejection_rules(params: PipelineParams) -> list[Rule]:
    """Rules in order of precedence. A comparison with NULL does not break a rule."""
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    distance, fare, total = F.col("trip_distance_miles"), F.col("fare_amount"), F.col("total_amount")
    seconds = seconds_between(pickup, dropoff)
    rules = [
        Rule("timestamp_null", pickup.isNull() | dropoff.isNull(), tests_null=True),
        Rule("duration_non_positive", dropoff <= pickup),
        Rule("duration_too_long", seconds > params.max_trip_duration_min * 60),
        Rule("pickup_outside_file_month", F.trunc(pickup, "MM") != F.col("source_file_month")),
        Rule(
            "distance_out_of_range",
            (distance <= 0) | (distance > params.max_trip_distance_miles),
        ),
        Rule("amount_non_positive", (fare < 0) | (total <= 0)),
        Rule(
            "zone_null",
            F.col("pickup_zone_key").isNull() | F.col("dropoff_zone_key").isNull(),
            tests_null=True,
        ),
    ]
    if params.max_total_amount is not None:
        rules.append(Rule("amount_too_high", total > params.max_total_amount))
    return rules


def flag_trips(staged: DataFrame, params: PipelineParams) -> DataFrame:
    """Add the trip duration and the first broken rule; no row is dropped."""
    first, *others = rejection_rules(params)
    label = F.when(first.broken, first.reason)
    for rule in others:
        label = label.when(rule.broken, rule.reason)
    minutes = seconds_between(F.col("pickup_at"), F.col("dropoff_at")) / 60.0
    return staged.select(
        "*", minutes.alias("trip_duration_min"), label.alias("rejection_reason")
    )


def _holds(rule: Rule) -> Column:
    return F.coalesce(rule.broken, F.lit(False))


def anomaly_counts(staged: DataFrame, params: PipelineParams, by: Sequence[str] = ()) -> DataFrame:
    """Every rule counted on its own, plus trips breaking at least one."""
    rules = rejection_rules(params)
    any_broken = reduce(Column.__or__, [_holds(rule) for rule in rules])
    return staged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nb_trips"),
        *[F.count_if(rule.broken).alias(rule.reason) for rule in rules],
        F.count_if(any_broken).alias("at_least_one"),
    )


def anomaly_histogram(staged: DataFrame, params: PipelineParams) -> DataFrame:
    """How many trips break 0, 1, 2 … rules; the NULL rules are left out."""
    broken = [_holds(rule).cast("int") for rule in rejection_rules(params) if not rule.tests_null]
    return (
        staged.select(reduce(Column.__add__, broken).alias("nb_anomalies"))
        .groupBy("nb_anomalies")
        .agg(F.count(F.lit(1)).alias("nb_trips"))
        .orderBy("nb_anomalies")
    )
