"""The four layers of tables and how they are written.

Loaded, labelled and enriched trips are catalog tables whose partitions are replaced in place. What is built from
them (month partials, fact, dimensions, marts) is published: written to new folders and made visible by one
manifest, see ``manifests``. ``read`` and ``snapshot`` follow the manifest; the catalog's tables follow it
afterwards for plain SQL, and a stop between both is repaired by the next ``create``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.contracts import ENRICHED_TRIPS, FACT_TRIPS, FLAGGED_TRIPS, RAW_TRIPS, RAW_ZONES
from tripmill.operators.staging import stage_trips, stage_zones
from tripmill.plans.ledger import Ledger
from tripmill.plans.manifests import Entry, Manifest, Manifests

_LAYERS = ("raw", "staging", "intermediate", "marts")

# Table -> (layer, schema, partition column, comment) for tables that exist
# before they are filled. All others are created by their first rebuild.
_DECLARED: dict[str, tuple[str, T.StructType, str | None, str]] = {
    "yellow_tripdata": ("raw", RAW_TRIPS, "_source_file", "One row per row of a trip file"),
    "taxi_zone_lookup": ("raw", RAW_ZONES, None, "One row per zone"),
    "int_trips__flagged": (
        "intermediate",
        FLAGGED_TRIPS,
        "source_file_month",
        "Every loaded trip with its rejection reason, NULL for a valid trip",
    ),
    "int_trips__enriched": (
        "intermediate",
        ENRICHED_TRIPS,
        "source_file_month",
        "Valid distinct trips with duration, speed and tip rate",
    ),
}
# Published tables: layer, partition column, comment. Their columns come from the job that writes them.
_PUBLISHED: dict[str, tuple[str, str | None, str]] = {
    "payment_type_codes": ("staging", None, "Published payment codes"),
    "rate_code_codes": ("staging", None, "Published rate codes"),
    "vendor_codes": ("staging", None, "Published vendor codes"),
    "int_trips__status_counts": ("intermediate", "source_file_month", "Rows per file and status"),
    "int_trips__daily": ("intermediate", "source_file_month", "Sums per day and payment type"),
    "int_trips__demand": ("intermediate", "source_file_month", "Sums and day bitmaps per zone, hour and weekend flag"),
    "int_trips__collected": ("intermediate", "source_file_month", "Sums and day bitmaps of collected trips per zone and hour"),
    "int_trips__fare_counts": ("intermediate", "source_file_month", "Collected trips per zone, hour and fare"),
    "fct_trips": ("marts", "source_file_month", "One row per valid trip"),
    "dim_date": ("marts", None, "One row per day of the calendar"),
    "dim_zone": ("marts", None, "One row per zone"),
    "dim_payment_type": ("marts", None, "One row per payment type"),
    "dim_rate_code": ("marts", None, "One row per rate code"),
    "dim_vendor": ("marts", None, "One row per vendor"),
    "mart_daily_revenue": ("marts", None, "Revenue per day and payment type"),
    "mart_zone_hourly_demand": ("marts", None, "Demand per pickup zone, hour and weekend flag"),
    "mart_data_quality": ("marts", None, "Share of each status in its file"),
}
# Published tables that may be read before a run has written them.
_EMPTY = {"fct_trips": FACT_TRIPS}


# Staging views: the loaded table each shows, and how.
_STAGING_VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_tlc__yellow_trips": ("yellow_tripdata", stage_trips),
    "stg_tlc__taxi_zones": ("taxi_zone_lookup", stage_zones),
}


def column_texts(projected: DataFrame) -> list[str]:
    """The columns of a single projection as SQL, each with its name."""
    columns = projected._jdf.queryExecution().analyzed().projectList()
    return [columns.apply(i).sql() for i in range(columns.size())]


class Publication:
    """What a run writes, invisible until ``commit``."""

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse = warehouse
        self.base = warehouse.manifests.latest()
        self.run = f"run=r{uuid.uuid4().hex}"
        self._tables, self._lock = dict(self.base.tables), Lock()

    def write(self, table: str, rows: DataFrame, value: date | None = None, made_from: str = "") -> None:
        """A table, or one partition of it; without ``value`` a partitioned table gets all partitions that rows have."""
        layer, column, _ = _PUBLISHED[table]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        folder = f"{layer}/{table}/{self.run}"
        path = f"{self.warehouse.root}/{folder}"
        if column is None:
            rows.write.mode("overwrite").parquet(path)
            folders = {"": folder}
        elif value is not None:
            folders = {str(value): f"{folder}/{column}={value}"}
            rows.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={value}")
            schema = T.StructType([*[f for f in schema if f.name != column], T.StructField(column, T.DateType())])
        else:
            # A partition's rows go to few files, one too large for a task to several.
            rows.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
            names = [n for n in self.warehouse.file_names(path) if n.startswith(f"{column}=")]
            folders = {n.split("=", 1)[1]: f"{folder}/{n}" for n in names}
            schema = T.StructType([*[f for f in schema if f.name != column], schema[column]])
        with self._lock:
            known = self._tables.get(table)
            if column is not None and known:
                if known.schema != schema.json() and set(known.folders) - set(folders):
                    raise ValueError(f"the columns of {table} differ from those of its other months")
                folders = {**known.folders, **folders}
            self._tables[table] = Entry(schema.json(), column, folders, made_from)

    def write_if_new(self, table: str, made_from: str, rows) -> bool:
        """Write ``rows()`` unless the published table was made from the same; whether it was written."""
        known = self.base.tables.get(table)
        if known and known.made_from == made_from:
            return False
        self.write(table, rows(), made_from=made_from)
        return True

    def remove(self, table: str, value: str | date) -> None:
        with self._lock:
            known = self._tables[table]
            self._tables[table] = replace(known, folders={k: f for k, f in known.folders.items() if k != str(value)})

    def read(self, table: str) -> DataFrame:
        """A table as it will be."""
        return self.warehouse.frame(table, self._tables.get(table))

    def scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows written once for several tables of this run; they go at its commit."""
        path = f"{self.warehouse.root}/work/{self.run}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.warehouse.spark.read.schema(rows.schema).parquet(path)

    def share(self, table: str, other: str) -> None:
        """``table`` has the rows of ``other``: one folder serves both."""
        with self._lock:
            self._tables[table] = self._tables[other]

    def commit(self, only: str | None = None) -> Manifest:
        """Publish what was written, or one table of it; the rest can follow."""
        with self._lock:
            tables = self._tables if only is None else {**self.base.tables, only: self._tables[only]}
            self.base = self.warehouse.manifests.commit(self.base, dict(tables))
        if only is None:
            self.warehouse.delete_path(f"{self.warehouse.root}/work/{self.run}")
        self.warehouse.follow(self.base)
        return self.base

    def abandon(self) -> None:
        """Delete what was written and not published."""
        kept = self.base.folders()
        for table, entry in self._tables.items():
            mine = [f for f in entry.folders.values() if f"/{self.run}" in f]
            if mine and not kept.intersection(mine):
                self.warehouse.delete_path(f"{self.warehouse.path(table)}/{self.run}")
        self.warehouse.delete_path(f"{self.warehouse.root}/work/{self.run}")


class Warehouse:
    """Tables under ``root`` (shared storage), in databases ``<prefix>raw`` and so on."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        if not re.fullmatch(r"[a-z0-9_]*", prefix):
            raise ValueError("prefix may hold lower-case letters, digits and underscores")
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.manifests = Manifests(spark, f"{self.root}/manifests")
        self.ledger = Ledger(spark, f"{self.root}/load_ledger")
        self._followed: dict[str, Entry] = {}

    def layer_of(self, table: str) -> str:
        return _PUBLISHED[table][0] if table in _PUBLISHED else _DECLARED[table][0]

    def name(self, table: str) -> str:
        return f"{self.prefix}{self.layer_of(table)}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root}/{self.layer_of(table)}/{table}"

    def checkpoint(self, file_name: str) -> str:
        return f"{self.root}/load_history/{file_name}"

    def read(self, table: str) -> DataFrame:
        if table in _PUBLISHED:
            return self.frame(table, self.manifests.latest().tables.get(table))
        return self.spark.table(self.name(table))

    def snapshot(self) -> Snapshot:
        """The published tables of one moment, whatever runs publish meanwhile."""
        return Snapshot(self, self.manifests.latest())

    def frame(self, table: str, entry: Entry | None) -> DataFrame:
        """The rows of a published table's folders; a partition's folder is read only if its value is asked for."""
        if entry is None and table not in _EMPTY:
            raise LookupError(f"{table} has not been published")
        schema = T.StructType.fromJson(json.loads(entry.schema)) if entry else _EMPTY[table]
        if not entry or not entry.folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{folder}" for folder in entry.folders.values()]
        reader = self.spark.read.schema(schema)
        if entry.partition:
            reader = reader.option("basePath", self.path(table))
        return reader.parquet(*paths).select(schema.names)

    def _create_view(self, view: str, table: str, staged: Callable[[DataFrame], DataFrame]) -> None:
        """A lasting view whose text is that of the job's own column expressions."""
        columns = ", ".join(column_texts(staged(self.spark.createDataFrame([], _DECLARED[table][1]))))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.prefix}staging.{view} AS SELECT {columns} FROM {self.name(table)}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def publication(self) -> Publication:
        return Publication(self)

    def create(self) -> None:
        """Create databases and declared tables that are missing; safe to repeat."""
        for layer in _LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")
        for table, (_, schema, partition, comment) in _DECLARED.items():
            self._create_table(table, schema, partition, comment)
        for table, schema in _EMPTY.items():
            self._create_table(table, schema, *_PUBLISHED[table][1:])
        for view, (table, staged) in _STAGING_VIEWS.items():
            self._create_view(view, table, staged)
        self.follow(self.manifests.latest())

    def _create_table(
        self, table: str, schema: T.StructType, partition: str | None, comment: str, folder: str = ""
    ) -> None:
        if self.exists(table):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partitioned = f"PARTITIONED BY (`{partition}`)" if partition else ""
        # New files of a partition replace the old ones only once the job has ended well.
        options = "OPTIONS (partitionOverwriteMode 'dynamic')" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
            f"{partitioned} {options} LOCATION '{folder or self.path(table)}' COMMENT '{comment}'"
        )
        if partition and table in _DECLARED and self.path_exists(self.path(table)):
            # A session without a lasting catalog finds earlier months again.
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")

    def replace_partition(self, table: str, value: str | date, rows: DataFrame) -> None:
        """Swap one partition's rows; a failed job leaves the previous rows.

        The overwrite touches only partitions that receive rows. Without any rows the
        old files are still there afterwards, and the partition is dropped.
        """
        if table in _PUBLISHED:
            run = self.publication()
            run.write(table, rows, value)
            run.commit()
            return
        column = self._partition_column(table)
        folder = f"{self.path(table)}/{column}={value}"
        kept = [c for c in self.read(table).columns if c != column]
        before = self.file_names(folder)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(table)} "
            f"SELECT *, {self._literal(value)} AS `{column}` FROM {{rows}}",
            rows=rows.select(kept),
        )
        if before and self.file_names(folder) == before:
            self.drop_partition(table, value)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows of any number of partitions, used for a first bulk fill.

        Rebalancing gathers a partition's rows into few files and splits a partition
        that is too large for one task.
        """
        if table in _PUBLISHED:
            run = self.publication()
            run.write(table, rows)
            run.commit()
            return
        ordered = rows.select(self.read(table).columns)
        ordered.hint("rebalance", self._partition_column(table)).write.insertInto(self.name(table))

    def drop_partition(self, table: str, value: str | date) -> None:
        """Remove a partition and its rows."""
        if table in _PUBLISHED:
            run = self.publication()
            run.remove(table, value)
            run.commit()
            return
        column = self._partition_column(table)
        self.spark.sql(
            f"ALTER TABLE {self.name(table)} DROP IF EXISTS "
            f"PARTITION (`{column}` = {self._literal(value)})"
        )
        # The tables name their location, so the catalog leaves the files alone.
        self.delete_path(f"{self.path(table)}/{column}={value}")
        self.spark.catalog.refreshTable(self.name(table))

    def replace_all(self, table: str, rows: DataFrame) -> None:
        """Replace the rows of a declared table without partitions."""
        columns = self.read(table).columns
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(table)} SELECT * FROM {{rows}}", rows=rows.select(columns)
        )

    def rebuild(self, table: str, rows: DataFrame) -> None:
        """Replace a whole published table, its columns included; a failed job leaves the previous content."""
        run = self.publication()
        run.write(table, rows)
        run.commit()

    def follow(self, manifest: Manifest) -> None:
        """Let the catalog's tables show what the manifest names, and delete what no kept manifest names."""
        changed = [table for table, entry in manifest.tables.items() if self._followed.get(table) != entry]
        with ThreadPoolExecutor(max_workers=8) as pool:
            for done in [pool.submit(self._show, table, manifest.tables[table]) for table in changed]:
                done.result()
        for folder in self.manifests.expire():
            self.delete_path(f"{self.root}/{folder}")

    def _show(self, table: str, entry: Entry) -> None:
        name, comment = self.name(table), _PUBLISHED[table][2]
        schema = T.StructType.fromJson(json.loads(entry.schema))
        if self.exists(table) and self.spark.table(name).schema.simpleString() != schema.simpleString():
            self.spark.sql(f"DROP TABLE {name}")
        if entry.partition is None:
            folder = f"{self.root}/{entry.folders['']}"
            if self.exists(table):
                # Readers find either the old rows or the new ones, never a missing table.
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            else:
                self._create_table(table, schema, None, comment, folder)
        else:
            before = self._followed.get(table)
            self._create_table(table, schema, entry.partition, comment)
            for value, folder in entry.folders.items():
                if before and before.folders.get(value) == folder:
                    continue
                part, path = f"PARTITION (`{entry.partition}` = '{value}')", f"'{self.root}/{folder}'"
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION {path}")
                self.spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {path}")
            for value in set(before.folders if before else ()) - set(entry.folders):
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{entry.partition}` = '{value}')")
        self.spark.catalog.refreshTable(name)
        self._followed[table] = entry

    def _files(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path_exists(self, path: str) -> bool:
        hadoop_path, files = self._files(path)
        return files.exists(hadoop_path)

    def file_names(self, path: str) -> set[str]:
        if not self.path_exists(path):
            return set()
        hadoop_path, files = self._files(path)
        return {status.getPath().getName() for status in files.listStatus(hadoop_path)}

    def delete_path(self, path: str) -> None:
        hadoop_path, files = self._files(path)
        files.delete(hadoop_path, True)

    def _partition_column(self, table: str) -> str:
        return _DECLARED[table][2]

    @staticmethod
    def _literal(value: str | date) -> str:
        if isinstance(value, date):
            return f"DATE '{value.isoformat()}'"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Snapshot:
    """The published tables as one manifest names them."""

    def __init__(self, warehouse: Warehouse, manifest: Manifest) -> None:
        self.warehouse, self.manifest = warehouse, manifest

    def read(self, table: str) -> DataFrame:
        return self.warehouse.frame(table, self.manifest.tables.get(table))
