"""Which folders make up the published tables.

A run writes new folders and then one manifest that names the folders of every table. The newest complete
manifest is the published state: all tables of a run appear together or, if the run stops anywhere before, not at
all. Manifests are numbered; a number is taken once, so of two runs that publish at the same time one fails.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

_NAME = re.compile(r"manifest-(\d{10})\.json")
#: Manifests kept, so that queries that began on an older one still find its folders.
KEPT = 3


class PublicationConflict(RuntimeError):
    """Another run has published since this one began."""


@dataclass(frozen=True)
class Entry:
    """A table: its schema (JSON), its partition column, a folder for each partition value (or for ``""``), and the
    fingerprint of what it was made from, if it need not be made again from the same."""

    schema: str
    partition: str | None = None
    folders: dict[str, str] = field(default_factory=dict)
    made_from: str = ""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    tables: dict[str, Entry] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for entry in self.tables.values() for folder in entry.folders.values()}


class Manifests:
    """The numbered manifests below a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        hadoop_path, files = self._path(self.folder)
        if not files.exists(hadoop_path):
            return []
        names = [_NAME.fullmatch(status.getPath().getName()) for status in files.listStatus(hadoop_path)]
        return sorted((int(name[1]) for name in names if name), reverse=True)

    def _file(self, version: int) -> str:
        return f"{self.folder}/manifest-{version:010d}.json"

    def read(self, version: int) -> Manifest | None:
        """None for a manifest that is missing or that a crash left incomplete."""
        hadoop_path, files = self._path(self._file(version))
        if not files.exists(hadoop_path):
            return None
        stream = files.open(hadoop_path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
            return Manifest(found["version"], {name: Entry(**entry) for name, entry in found["tables"].items()})
        except (ValueError, KeyError, TypeError):
            return None

    def latest(self) -> Manifest:
        for version in self._versions():
            found = self.read(version)
            if found is not None:
                return found
        return Manifest()

    def commit(self, base: Manifest, tables: dict[str, Entry]) -> Manifest:
        """Publish ``tables`` as the state that follows ``base``."""
        if self.latest().version != base.version:
            raise PublicationConflict(f"version {base.version} is no longer the newest")
        # A number that a crash left incomplete is used up.
        after = Manifest(max([base.version, *self._versions()]) + 1, tables)
        hadoop_path, files = self._path(self._file(after.version))
        try:
            stream = files.create(hadoop_path, False)
        except Exception as error:
            raise PublicationConflict(f"version {after.version} was taken meanwhile") from error
        try:
            stream.write(bytearray(json.dumps(asdict(after)), "utf-8"))
        finally:
            stream.close()
        return after

    def expire(self) -> list[str]:
        """Forget all but the newest manifests; folders that only they named."""
        versions = self._versions()
        kept = [m for m in map(self.read, versions[:KEPT]) if m]
        named: set[str] = set().union(*(m.folders() for m in kept)) if kept else set()
        gone: set[str] = set()
        for version in versions[KEPT:]:
            old = self.read(version)
            gone |= old.folders() if old else set()
            hadoop_path, files = self._path(self._file(version))
            files.delete(hadoop_path, False)
        return sorted(gone - named)
