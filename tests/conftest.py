from __future__ import annotations

import sys
import uuid
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill.contracts import STAGED_TRIPS  # noqa: E402
from tripmill.plans.warehouse import Warehouse  # noqa: E402
from tripmill.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "warehouse"), f"t_{uuid.uuid4().hex}_")
    house.create()
    return house


GOOD_TRIP = {
    "vendor_key": 2,
    "rate_code_key": 1,
    "payment_type_key": 1,
    "pickup_zone_key": 10,
    "dropoff_zone_key": 20,
    "pickup_at": datetime(2025, 1, 15, 8, 0, 0),
    "dropoff_at": datetime(2025, 1, 15, 8, 30, 0),
    "passenger_count": 1,
    "trip_distance_miles": 5.0,
    "is_store_and_forward": False,
    "fare_amount": 20.0,
    "extra_amount": 1.0,
    "mta_tax_amount": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge_amount": 1.0,
    "congestion_surcharge_amount": 2.5,
    "airport_fee_amount": 0.0,
    "cbd_congestion_fee_amount": 0.75,
    "total_amount": 29.75,
    "source_file": "yellow_tripdata_2025-01.parquet",
    "source_file_month": date(2025, 1, 1),
    "loaded_at": datetime(2025, 2, 1),
}


@pytest.fixture
def staged(spark):
    """Staged trips: a valid trip per dict of changed columns."""

    def make(*changes):
        rows = [tuple({**GOOD_TRIP, **change}[c] for c in STAGED_TRIPS.names) for change in changes]
        return spark.createDataFrame(rows, STAGED_TRIPS)

    return make
