"""Load each landed file exactly once.

A stream over the month's path remembers in its checkpoint which files it has
seen; started again with ``availableNow`` it finds nothing new and adds nothing.
The stream carries paths only, as one fixed schema cannot read files whose column
types drift. The warehouse's ledger has the rest: size, time, rows and what became of it. Delivery to ``foreachBatch`` is at least once, so the batch replaces
the file's own partition instead of appending to it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmill.contracts import TRIP_FILE_NAME, ZONE_FILE_NAME, trip_file_name
from tripmill.plans import ledger
from tripmill.plans.warehouse import Warehouse
from tripmill.sources.landing import Parts, parts_by_schema, read_trip_file, read_zone_file, utc_now

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _arrived(warehouse: Warehouse, landing: str, file_name: str) -> None:
    if not warehouse.path_exists(f"{landing}/{file_name}"):
        raise FileNotFoundError(f"{file_name} has not arrived in {landing}")


def _load_once(warehouse: Warehouse, landing: str, file_name: str, load: Callable[[], None]) -> None:
    # The braces make the path a pattern: a stream may not name a single file.
    arrivals = (
        warehouse.spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .load(f"{landing}/{{{file_name}}}")
        .select("path")
    )

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            load()

    query = (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", warehouse.checkpoint(file_name))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _facts(parts: list[Parts]) -> dict[str, object]:
    """Size and time of a landed file, as the ledger keeps them."""
    return {"file_size": sum(p.size for p in parts), "file_time": max(p.newest for p in parts).isoformat()}


def ingest_month(
    warehouse: Warehouse,
    landing: str,
    month: str,
    loaded_at: datetime | None = None,
    parts: list[Parts] | None = None,
) -> int:
    """Load the month's file unless it was loaded before; return its loaded rows.

    The ledger records each call: ``loaded`` with the rows that the load wrote, ``again``, or ``changed`` if the file
    is no longer the one that was loaded. Its rows stay as they are until ``reload_month``.
    """
    spark, file_name = warehouse.spark, trip_file_name(month)
    landing, stamp = landing.rstrip("/"), loaded_at or utc_now()
    _arrived(warehouse, landing, file_name)
    parts = parts_by_schema(spark, f"{landing}/{file_name}") if parts is None else parts
    written: list[int] = []

    def load() -> None:
        seen = Observation()
        trips = read_trip_file(spark, f"{landing}/{file_name}", file_name, stamp, parts)
        trips = trips.observe(seen, F.count(F.lit(1)).alias("rows"))
        warehouse.replace_partition("yellow_tripdata", file_name, trips)
        written.append(seen.get["rows"])

    before = warehouse.ledger.last(file_name, ledger.LOADED, ledger.FORGOTTEN)
    if before is None or before.state == ledger.FORGOTTEN:
        _load_once(warehouse, landing, file_name, load)
    facts = _facts(parts)
    if written:
        warehouse.ledger.record(file_name, ledger.LOADED, nb_rows=written[-1], **facts)
        return written[-1]
    rows = _rows_there(warehouse, file_name)
    state = ledger.CHANGED if file_changed(warehouse, file_name, parts) else ledger.AGAIN
    warehouse.ledger.record(file_name, state, nb_rows=rows, **facts)
    return rows


def _rows_there(warehouse: Warehouse, file_name: str) -> int:
    """Rows of a loaded file: those that its load wrote, as long as its partition has files."""
    folder = f"{warehouse.path('yellow_tripdata')}/_source_file={file_name}"
    loaded = warehouse.ledger.last(file_name, ledger.LOADED)
    if loaded is None:
        # Loaded before there was a ledger.
        return warehouse.read("yellow_tripdata").where(F.col("_source_file") == file_name).count()
    return loaded.nb_rows or 0 if warehouse.file_names(folder) else 0


def file_changed(warehouse: Warehouse, file_name: str, parts: list[Parts]) -> bool:
    """Whether a landed file differs in size or time from the one that was loaded under its name."""
    loaded = warehouse.ledger.last(file_name, ledger.LOADED)
    facts = _facts(parts)
    return loaded is not None and (loaded.file_size, loaded.file_time) != (facts["file_size"], facts["file_time"])


def reload_month(warehouse: Warehouse, landing: str, month: str, loaded_at: datetime | None = None) -> int:
    """Replace a month's loaded rows by those of the file as it is now."""
    forget_month(warehouse, month)
    return ingest_month(warehouse, landing, month, loaded_at)


def ingest_zones(warehouse: Warehouse, landing: str, loaded_at: datetime | None = None) -> int:
    """Load the zone list unless it was loaded before; return the loaded zones."""
    landing, stamp = landing.rstrip("/"), loaded_at or utc_now()
    _arrived(warehouse, landing, ZONE_FILE_NAME)
    loads: list[int] = []

    def load() -> None:
        zones = read_zone_file(warehouse.spark, f"{landing}/{ZONE_FILE_NAME}", stamp)
        warehouse.replace_all("taxi_zone_lookup", zones)
        loads.append(1)

    _load_once(warehouse, landing, ZONE_FILE_NAME, load)
    rows = warehouse.read("taxi_zone_lookup").count()
    warehouse.ledger.record(ZONE_FILE_NAME, ledger.LOADED if loads else ledger.AGAIN, nb_rows=rows)
    return rows


def empty_month(warehouse: Warehouse, month: str) -> None:
    """Remove a month's rows but keep its load history: the file will not come back."""
    file_name = trip_file_name(month)
    warehouse.drop_partition("yellow_tripdata", file_name)
    warehouse.ledger.record(file_name, ledger.EMPTIED, nb_rows=0)


def forget_month(warehouse: Warehouse, month: str) -> None:
    """Remove a month's rows together with its load history, so it can load again.

    Emptying the partition alone keeps the history: the file would not come back.
    """
    file_name = TRIP_FILE_NAME.format(month=month)
    warehouse.drop_partition("yellow_tripdata", file_name)
    warehouse.delete_path(warehouse.checkpoint(file_name))
    warehouse.ledger.record(file_name, ledger.FORGOTTEN, nb_rows=0)
