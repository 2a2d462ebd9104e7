"""Landed trip and zone files, brought to the contract of the loaded tables."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.contracts import RAW_TRIPS, RAW_ZONES, TRIP_FILE_SCHEMA, ZONE_FILE_SCHEMA
from tripmill.functions import ntz


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _to_contract(name: str, source: T.DataType | None, target: T.DataType) -> Column:
    if source is None:
        return F.lit(None).cast(target)
    column = F.col(f"`{name}`")
    fractional = isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType))
    if fractional and isinstance(target, T.LongType):
        # Whole-number columns round a fraction; a plain cast would cut it off.
        column = F.round(column)
    return column.cast(target)


class Parts(NamedTuple):
    """Parts of a landed file that have one schema."""

    schema: T.StructType
    paths: list[str]
    nb_rows: int
    size: int
    newest: datetime


_FOOTER = "path string, length long, modified timestamp, kind string, nb_rows long"


def _footers(batches) -> Iterator:
    """Schema and rows of each file by its footer; read where the file's row of the listing is."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        kinds, rows = [], []
        for path in batch.column(0).to_pylist():
            store, name = fs.FileSystem.from_uri(_pyarrow_uri(path))
            footer = pq.read_metadata(name, filesystem=store)
            kinds.append(str(footer.schema.to_arrow_schema().remove_metadata()))
            rows.append(footer.num_rows)
        columns = [*batch.columns, pa.array(kinds, pa.string()), pa.array(rows, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "modified", "kind", "nb_rows"])


def _pyarrow_uri(path: str) -> str:
    scheme, rest = path.split(":", 1)
    return f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{'/' if scheme == 'file' else ''}{rest.lstrip('/')}".replace(" ", "%20")


def parts_by_schema(spark: SparkSession, path: str) -> list[Parts]:
    """The parts of a landed file or folder, together as their schemas are equal.

    Spark lists the files and its tasks read their footers; the driver opens one file for each distinct schema.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = (
        listed.select("path", "length", F.col("modificationTime").alias("modified"))
        .mapInArrow(_footers, _FOOTER)
        .groupBy("kind")
        .agg(
            F.sort_array(F.collect_list("path")).alias("paths"), F.sum("nb_rows").alias("nb_rows"),
            F.sum("length").alias("size"), F.max("modified").alias("newest"),
        )
        .orderBy("kind")
    )
    return [
        Parts(spark.read.parquet(row.paths[0]).schema, row.paths, row.nb_rows, row.size, row.newest) for row in found.collect()
    ]


def read_trip_file(
    spark: SparkSession, path: str, file_name: str, loaded_at: datetime | None = None, parts: list[Parts] | None = None
) -> DataFrame:
    """One month's file (or folder of parts) in the shape of the loaded trips.

    Every part is read with its own schema, so a column may come, go or change type between
    months and between the parts of one. Columns are found by name regardless of case;
    missing ones are NULL, unknown ones are left out.
    """
    groups = parts_by_schema(spark, path) if parts is None else parts
    if not groups:
        raise FileNotFoundError(f"{file_name} holds no files")
    # Parts of a single schema need no list of files.
    scans = [
        spark.read.schema(group.schema).parquet(*(group.paths if len(groups) > 1 else [path])) for group in groups
    ]
    stamp = ntz(loaded_at or utc_now())
    shaped = [
        _shaped(trips, file_name).select(
            "*", stamp.alias("_loaded_at"), F.lit(file_name).alias("_source_file")
        )
        for trips in scans
    ]
    return reduce(DataFrame.unionByName, shaped).select(RAW_TRIPS.names)


def _shaped(trips: DataFrame, file_name: str) -> DataFrame:
    found: dict[str, T.StructField] = {}
    for field in trips.schema.fields:
        if field.name.lower() in found:
            raise ValueError(f"{file_name} has two columns named {field.name.lower()}")
        found[field.name.lower()] = field
    columns = []
    for field in TRIP_FILE_SCHEMA.fields:
        source = found.get(field.name)
        column = _to_contract(
            source.name if source else field.name, source.dataType if source else None, field.dataType
        )
        columns.append(column.alias(field.name))
    return trips.select(*columns)


def read_zone_file(spark: SparkSession, path: str, loaded_at: datetime | None = None) -> DataFrame:
    """The zone list: one header line, optional quotes, columns by position."""
    return (
        spark.read.schema(ZONE_FILE_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
        .select(
            *ZONE_FILE_SCHEMA.names,
            F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("_source_file"),
            ntz(loaded_at or utc_now()).alias("_loaded_at"),
        )
        .select(RAW_ZONES.names)
    )
