"""What happened to each landed file, event by event.

A stream's checkpoint knows paths only. The ledger beside it also has the file's size and time, the rows that the load wrote
and how the month went on, so a file that changed under its old name is noticed and a backfill knows where to go on.
An event is a small file of its own, numbered per landed file; a number is taken once, and nothing is ever rewritten.
"""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: States of a file and of its month.
LOADED, AGAIN, CHANGED, EMPTIED, FORGOTTEN = "loaded", "again", "changed", "emptied", "forgotten"
STOPPED, PUBLISHED = "stopped", "published"
SCHEMA = "file_name string, event int, state string, file_size bigint, file_time string, nb_rows bigint, note string, recorded_at string"
_NAME = re.compile(r"event-(\d{8})\.json")


class Event(NamedTuple):
    file_name: str
    event: int
    state: str
    file_size: int | None = None
    file_time: str | None = None
    nb_rows: int | None = None
    note: str | None = None
    recorded_at: str | None = None


class Ledger:
    """Events below a folder on shared storage, a sub-folder for each landed file."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, file_name: str) -> list[int]:
        hadoop_path, files = self._path(f"{self.folder}/{file_name}")
        if not files.exists(hadoop_path):
            return []
        names = [_NAME.fullmatch(status.getPath().getName()) for status in files.listStatus(hadoop_path)]
        return sorted(int(name[1]) for name in names if name)

    def _file(self, file_name: str, number: int) -> str:
        return f"{self.folder}/{file_name}/event-{number:08d}.json"

    def record(self, file_name: str, state: str, **facts: object) -> Event:
        number = max(self._numbers(file_name), default=0) + 1
        event = Event(file_name, number, state, **facts, recorded_at=datetime.now(timezone.utc).isoformat())
        hadoop_path, files = self._path(self._file(file_name, number))
        stream = files.create(hadoop_path, False)
        try:
            stream.write(bytearray(json.dumps(event._asdict()) + "\n", "utf-8"))
        finally:
            stream.close()
        return event

    def last(self, file_name: str, *states: str) -> Event | None:
        """The newest event of a file, or the newest in one of ``states``; one that a crash left incomplete is none."""
        for number in reversed(self._numbers(file_name)):
            hadoop_path, files = self._path(self._file(file_name, number))
            stream = files.open(hadoop_path)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                event = Event(**json.loads(text))
            except ValueError:
                continue
            if not states or event.state in states:
                return event
        return None

    def events(self) -> DataFrame:
        """All events as rows."""
        hadoop_path, files = self._path(self.folder)
        if not files.exists(hadoop_path):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(self.folder)
        return rows.where(F.col("event").isNotNull())
