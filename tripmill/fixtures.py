"""Trip-shaped views of the driver's tables, in the shape of loaded trips.

``trips_from_events`` has fine timestamps, NULLs, copies and two files;
``trips_from_lineitem`` has volume, 81 months and non-positive durations.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.contracts import RAW_TRIPS, RAW_ZONES, PipelineParams
from tripmill.functions import minute_number, ntz

EVENT_PARAMS = PipelineParams(
    max_trip_distance_miles=15,
    max_trip_duration_min=1440,
    start_month=date(2024, 1, 1),
    end_month=date(2024, 4, 1),
    max_rejection_rate=0.25,
)
LINEITEM_PARAMS = PipelineParams(
    max_trip_distance_miles=45,
    max_trip_duration_min=730 * 1440,
    start_month=date(1995, 1, 1),
    end_month=date(2002, 1, 1),
)
# The zone options that match something in the driver's nations.
ZONE_OPTIONS = {
    "airport_pattern": "%nation_1%",
    "airport_borough": "ASIA",
    "unknown_zones": (23, 24),
}
FIRST_LOAD = datetime(2024, 3, 1)
SECOND_LOAD = datetime(2024, 3, 2)
USAGE_AS_OF = datetime(2024, 2, 10)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_next_event(events: DataFrame) -> DataFrame:
    """Add ``next_ts`` and ``next_k`` of the user's following event.

    One user may own a third of all events, so no window holds a whole user. Events
    look ahead inside their minute; the last one of a minute takes the first event
    of the user's next busy minute, found among one row per user and minute.
    """
    keyed = events.withColumn("minute", minute_number(F.col("ts")))
    inside = Window.partitionBy("user_id", "minute").orderBy("ts", "event_id")
    across = Window.partitionBy("user_id").orderBy("minute")
    first_of_minute = keyed.groupBy("user_id", "minute").agg(
        F.min(F.struct("ts", "event_id", "k")).alias("first")
    )
    following = first_of_minute.select(
        F.col("user_id").alias("_user"), F.col("minute").alias("_minute"),
        F.lead("first").over(across).alias("later"),
    )
    looked_ahead = keyed.withColumn("near", F.lead(F.struct("ts", "event_id", "k")).over(inside))
    same_minute = looked_ahead.user_id.eqNullSafe(following._user) & (
        looked_ahead.minute == following._minute
    )
    joined = looked_ahead.join(following, same_minute, "left")
    following_event = F.coalesce("near", "later")
    return joined.select(
        *events.columns,
        following_event["ts"].alias("next_ts"),
        following_event["k"].alias("next_k"),
    )


def _as_raw(rows: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Select the loaded-trip columns from SQL expressions, cast to their contract."""
    return rows.selectExpr(
        *[
            f"cast({expressions[f.name]} as {f.dataType.simpleString()}) as `{f.name}`"
            for f in RAW_TRIPS.fields
        ]
    )


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        "cast(get_json_object(props, '$.k') as int) as k",
    )
    # Every twentieth trip arrives again with a later load.
    loads = f"""explode(filter(
        array(timestamp_ntz'{FIRST_LOAD}', if(event_id % 20 = 0, timestamp_ntz'{SECOND_LOAD}', null)),
        load -> load is not null))"""
    trips = _with_next_event(events).selectExpr(
        "*", "if(event_id % 7 = 1, 0.2D * value, 0D) as tip", f"{loads} as load"
    )
    return _as_raw(
        trips,
        {
            "vendorid": "decode(event_type, 'view', 1, 'click', 2, 'purchase', 6, 'signup', 7)",
            "tpep_pickup_datetime": "ts",
            "tpep_dropoff_datetime": "next_ts",
            "passenger_count": "nullif(event_id % 6, 0)",
            "trip_distance": "value / 10",
            "ratecodeid": "nullif(k % 8, 0)",
            "store_and_fwd_flag": "decode(event_id % 50, 0, 'Y', 1, null, 'N')",
            "pulocationid": "if(k = 99, null, k % 25)",
            "dolocationid": "next_k % 25",
            "payment_type": "event_id % 7",
            "fare_amount": "value - 0.5D",
            "extra": "0.25",
            "mta_tax": "0.5",
            "tip_amount": "tip",
            "tolls_amount": "0",
            "improvement_surcharge": "0.25",
            "total_amount": "value + 0.5D + tip",
            "congestion_surcharge": "if(event_id % 11 = 0, null, 2.5)",
            "airport_fee": "if(k % 25 = 1, 1.75, null)",
            "cbd_congestion_fee": "if(event_id % 13 = 0, null, 0.75)",
            "_source_file": "concat('yellow_tripdata_2024-', if(event_id % 97 = 0, '02', '01'), '.parquet')",
            "_loaded_at": "load",
        },
    )


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    def named(months_later: int) -> str:
        month = f"add_months(o_orderdate, {months_later})"
        return f"concat('yellow_tripdata_', substring(cast({month} as string), 1, 7), '.parquet')"

    # File names are made once per order, not once per line.
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate",
        "cast(substring(o_orderpriority, 1, 1) as int) as priority",
        f"{named(0)} as file_name", f"{named(1)} as next_file_name",
    )
    trips = lines.join(
        orders.join(customers, orders.o_custkey == customers.c_custkey),
        lines.l_orderkey == orders.o_orderkey,
    ).join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    return _as_raw(
        trips,
        {
            "vendorid": "l_suppkey % 8",
            "tpep_pickup_datetime": "o_orderdate",
            "tpep_dropoff_datetime": "l_shipdate",
            "passenger_count": "l_linenumber",
            "trip_distance": "l_quantity",
            "ratecodeid": "null",
            "store_and_fwd_flag": "'N'",
            "pulocationid": "c_nationkey",
            "dolocationid": "s_nationkey",
            "payment_type": "priority",
            "fare_amount": "l_extendedprice",
            "extra": "0",
            "mta_tax": "0",
            "tip_amount": "0",
            "tolls_amount": "0",
            "improvement_surcharge": "0",
            "total_amount": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
            "congestion_surcharge": "null",
            "airport_fee": "null",
            "cbd_congestion_fee": "null",
            "_source_file": "if(l_linenumber = 7, next_file_name, file_name)",
            "_loaded_at": f"timestamp_ntz'{FIRST_LOAD}'",
        },
    )


def zones_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as loaded zones, their region as the borough."""
    nations, regions = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    zones = nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
        F.lit("taxi_zone_lookup.csv").alias("_source_file"),
        ntz(FIRST_LOAD).alias("_loaded_at"),
    )
    return zones.select([F.col(f.name).cast(f.dataType) for f in RAW_ZONES.fields])


def usage_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metered usage, a quarter of it for services."""
    value = F.col("value")
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"),
        F.col("ts").alias("start_time"),
        value.alias("usage"),
        (value * 0.75).alias("usage_compute"),
        (value * 0.25).alias("usage_services"),
    )
