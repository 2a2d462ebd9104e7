"""Loading landed files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmill import fixtures as fx
from tripmill.contracts import RAW_TRIPS, check_month
from tripmill.operators import gates
from tripmill.plans import cli
from tripmill.sources import profile
from tripmill.sources.landing import read_trip_file, read_zone_file
from tripmill.streaming.arrivals import forget_month, ingest_month, ingest_zones

STAMP = datetime(2025, 2, 1, 12, 0, 0)


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "landing").mkdir()
    return str(tmp_path / "landing")


def _land(spark, landing, month, columns, rows):
    """A single Parquet file with exactly these columns."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(columns)})
    pq.write_table(table, f"{landing}/yellow_tripdata_{month}.parquet")


def _columns(passengers, fee, extra=()):
    import pyarrow as pa

    return [("VendorID", pa.int32()), ("tpep_pickup_datetime", pa.timestamp("us")),
            ("passenger_count", passengers), ("fare_amount", pa.float64()), (fee, pa.float64()), *extra]


@pytest.fixture
def three_months(spark, landing):
    import pyarrow as pa

    at = datetime(2025, 1, 5, 10, 30)
    _land(spark, landing, "2025-01", _columns(pa.int64(), "Airport_fee"), [(1, at, 2, 12.5, 1.75), (2, at, None, 3.0, None)])
    _land(spark, landing, "2025-02", _columns(pa.float64(), "airport_fee", [("surprise", pa.string())]),
          [(6, at, 1.5, 7.25, 0.0, "x")])
    _land(spark, landing, "2025-03", _columns(pa.int32(), "AIRPORT_FEE"), [(7, at, 3, 9.0, 1.25)] * 4)
    return landing


def test_drifting_files_load_once(spark, warehouse, three_months):
    assert ingest_month(warehouse, three_months, "2025-01", STAMP) == 2
    assert ingest_month(warehouse, three_months, "2025-02", STAMP) == 1
    # Loading again adds nothing and keeps the first load's time.
    later = datetime(2025, 9, 9)
    assert ingest_month(warehouse, three_months, "2025-01", later) == 2
    assert ingest_month(warehouse, three_months, "2025-02", later) == 1
    raw = warehouse.read("yellow_tripdata")
    assert raw.count() == 3 and {r[0] for r in raw.select("_loaded_at").collect()} == {STAMP}
    # A new file adds only itself.
    assert ingest_month(warehouse, three_months, "2025-03", later) == 4
    assert raw.sparkSession.table(warehouse.name("yellow_tripdata")).count() == 7


def test_columns_bind_by_name_and_whole_numbers_round(spark, warehouse, three_months):
    for month in ("2025-01", "2025-02"):
        ingest_month(warehouse, three_months, month, STAMP)
    raw = warehouse.read("yellow_tripdata")
    rows = {r.vendorid: r for r in raw.collect()}
    assert (rows[1].airport_fee, rows[1].fare_amount, rows[1].passenger_count) == (1.75, 12.5, 2)
    assert rows[6].passenger_count == 2 and rows[6].airport_fee == 0.0
    assert rows[1].cbd_congestion_fee is None and rows[2].passenger_count is None
    assert "surprise" not in raw.columns
    assert gates.contract_problems(raw) == []
    assert dict(raw.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert rows[1].tpep_pickup_datetime == datetime(2025, 1, 5, 10, 30)
    gates.run_gate(gates.amounts_keep_decimals(raw.select("*", F.col("fare_amount").alias("t"))
                                               .drop("total_amount").withColumnRenamed("t", "total_amount")))


def test_emptying_keeps_the_history_and_forgetting_clears_it(spark, warehouse, three_months):
    name = "yellow_tripdata_2025-01.parquet"
    ingest_month(warehouse, three_months, "2025-01", STAMP)
    warehouse.drop_partition("yellow_tripdata", name)
    assert ingest_month(warehouse, three_months, "2025-01", STAMP) == 0
    forget_month(warehouse, "2025-01")
    assert ingest_month(warehouse, three_months, "2025-01", STAMP) == 2


def test_folder_of_parts_counts_as_one_file(spark, warehouse, landing):
    rows = fx.trips_from_events(spark, SF).where(F.col("_source_file").contains("2024-01"))
    rows.drop("_source_file", "_loaded_at").repartition(3).write.parquet(
        f"{landing}/yellow_tripdata_2024-01.parquet"
    )
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == rows.count()
    assert ingest_month(warehouse, landing, "2024-01", STAMP) == rows.count()
    files = warehouse.read("yellow_tripdata").select("_source_file").distinct().collect()
    assert [r[0] for r in files] == ["yellow_tripdata_2024-01.parquet"]


def test_missing_file_and_bad_month(spark, warehouse, landing):
    with pytest.raises(FileNotFoundError, match="2025-07"):
        ingest_month(warehouse, landing, "2025-07")
    for text in ("2025-13", "2025-1", "202501", "2025-01-01", "", None):
        with pytest.raises(ValueError):
            check_month(text)


def test_two_columns_of_one_name_are_refused(spark, landing):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        spark.range(1).select(F.lit(1.0).alias("airport_fee"), F.lit(2.0).alias("Airport_fee")).write.parquet(
            f"{landing}/yellow_tripdata_2025-05.parquet"
        )
        with pytest.raises(ValueError, match="airport_fee"):
            read_trip_file(spark, f"{landing}/yellow_tripdata_2025-05.parquet", "yellow_tripdata_2025-05.parquet")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


ZONES = (
    'LocationID,Borough,Zone,service_zone\n'
    '1,"EWR","Newark, Airport","EWR"\n'
    '2,Queens,Jamaica Bay,Boro Zone\n'
    '3,Bronx,"The ""Hub""",Boro Zone\n'
)


def test_zone_csv(spark, warehouse, landing):
    path = f"{landing}/taxi_zone_lookup.csv"
    with open(path, "w") as out:
        out.write(ZONES)
    rows = {r.locationid: r for r in read_zone_file(spark, path, STAMP).collect()}
    assert (rows[1].zone, rows[1].borough) == ("Newark, Airport", "EWR")
    assert rows[3].zone == 'The "Hub"' and rows[2]._source_file == "taxi_zone_lookup.csv"
    assert ingest_zones(warehouse, landing, STAMP) == 3
    assert ingest_zones(warehouse, landing, STAMP) == 3
    check = gates.zones_are_complete(warehouse.read("taxi_zone_lookup"))
    with pytest.raises(gates.GateFailed, match="zone_count_ok"):
        gates.run_gate(check)
    gates.run_gate(gates.zones_are_complete(warehouse.read("taxi_zone_lookup"), expected=3))


def test_command_line(spark, tmp_path, three_months, capsys):
    options = ["--landing", three_months, "--warehouse", str(tmp_path / "house"), "--prefix", "cli_test_"]
    cli.main(["--month", "2025-03", *options])
    assert "yellow_tripdata_2025-03.parquet: 4 rows" in capsys.readouterr().out
    for bad in (["--month", "2025-03", "--zones"], []):
        with pytest.raises(SystemExit):
            cli.main([*bad, *options])
    with pytest.raises(ValueError):
        cli.main(["--month", "March", *options])


def test_profile(spark, three_months):
    path = f"{three_months}/yellow_tripdata_2025-01.parquet"
    found = profile.files(spark, path).first()
    assert found.file_name == "yellow_tripdata_2025-01.parquet" and found.nb_rows == 2
    assert found.file_size > 0 and found.file_modification_time is not None
    columns = {r.column_name: r for r in profile.columns(spark, path).collect()}
    assert columns["VendorID"][3:] == ("VendorID", "int", 2, 0, "1")
    assert columns["passenger_count"][4:] == ("bigint", 2, 1, "2") and columns["fare_amount"].example == "3.0"
    assert columns["VendorID"].file_size == found.file_size and columns["VendorID"].file_time == found.file_modification_time
    codes = profile.code_frequencies(spark.read.parquet(path), ["VendorID", "passenger_count"]).collect()
    assert ("passenger_count", None, 1) in [tuple(r) for r in codes]


def test_profile_anomalies(spark):
    raw = fx.trips_from_events(spark, SF)
    inside = profile.anomalies(raw, "2024-01").first()
    assert inside.outside_month == 0 and inside.first_pickup.month == 1
    assert profile.anomalies(raw, "2024-02").first().outside_month == raw.count()


def test_contract_check_reports_differences(spark):
    raw = spark.createDataFrame([], RAW_TRIPS)
    broken = raw.drop("extra").withColumn("fare_amount", F.col("fare_amount").cast("int"))
    assert gates.contract_problems(broken) == ["column fare_amount is int, not double", "missing column extra"]
    summary = gates.load_summary(fx.trips_from_events(spark, SF)).collect()
    assert {r.source_file[-15:-8]: r.nb_rows for r in summary} == {"2024-01": 1038, "2024-02": 12}
    assert {r.first_loaded_at for r in summary} == {fx.FIRST_LOAD}


def test_parts_of_one_month_may_drift(spark, landing):
    """Each part is read with its own schema: no value of a column that a sibling lacks is lost."""
    name = "yellow_tripdata_2025-06.parquet"
    spark.range(5).selectExpr("id AS VendorID", "cast(1.5 AS double) AS passenger_count").write.parquet(f"{landing}/{name}")
    spark.range(7).selectExpr("id AS vendorid", "2L AS passenger_count", "0.75D AS cbd_congestion_fee").write.mode(
        "append"
    ).parquet(f"{landing}/{name}")
    rows = read_trip_file(spark, f"{landing}/{name}", name, STAMP)
    got = rows.selectExpr("count(*)", "count(vendorid)", "count(cbd_congestion_fee)", "sum(passenger_count)").first()
    assert tuple(got) == (12, 12, 7, 5 * 2 + 7 * 2)
    assert rows.schema.names == RAW_TRIPS.names
