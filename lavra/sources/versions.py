"""Tables that are replaced in one step: a folder of versions and a log of what is current.

    table/versions/<id>/...      data of each version, never changed once written
    table/published/000007-<id>  an empty file; the one of the highest number is current

A version is written and checked before it is published, and publishing creates one empty file.
That is a single operation on file systems and object stores alike, where replacing a pointer
file's content or renaming a folder is not: a reader sees the old version or the new one, and
a job that fails at any step leaves the old one current. Two jobs that publish at once cannot
take the same number; the later one is refused. Publishing an older version again rolls a
table back.

All files are reached through the Hadoop client of the session, so any store Spark reads will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from lavra.sources.sink import WriteResult, write_verified

VERSIONS = "versions"
PUBLISHED = "published"
DIGITS = 12


class PublishError(RuntimeError):
    """A version could not become current; the one before still is."""


@dataclass(frozen=True)
class Publication:
    """An entry of the log."""

    number: int
    version: str


class VersionedTable:
    """A table below one folder; reading gives the published version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _store(self):
        return self._path(PUBLISHED).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def log(self) -> list[Publication]:
        """Publications from the first to the current one."""
        store, folder = self._store(), self._path(PUBLISHED)
        if not store.exists(folder):
            return []
        names = [status.getPath().getName() for status in store.listStatus(folder)]
        entries = [name.partition("-") for name in names if name[:1].isdigit()]
        return sorted(
            (Publication(int(number), version) for number, _, version in entries),
            key=lambda entry: entry.number,
        )

    def current(self) -> str | None:
        """The published version, if there is one."""
        log = self.log()
        return log[-1].version if log else None

    def version_path(self, version: str) -> str:
        return f"{self.path}/{VERSIONS}/{version}"

    def read(self, version: str | None = None) -> DataFrame:
        """The published version, or another one that still exists."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        return self.spark.read.parquet(self.version_path(version))

    def write(
        self, df: DataFrame, label: str, partition_by: Sequence[str] = (), content: bool = False
    ) -> tuple[str, WriteResult, DataFrame]:
        """Write a version that nobody reads yet: its name, its counts, and a report on it.

        A table may be written from what is read of it.
        """
        version = uuid.uuid4().hex
        result, report = write_verified(df, self.version_path(version), label, partition_by, content)
        return version, result, report

    def publish(self, version: str) -> Publication:
        """Make a version the current one."""
        store = self._store()
        done = self._path(VERSIONS, version, "_SUCCESS")
        if not store.exists(done):
            raise PublishError(f"{self.version_path(version)} was not written to its end")
        log = self.log()
        entry = Publication(log[-1].number + 1 if log else 1, version)
        # A lock file of the number alone: the name of the entry also holds the version, so
        # two jobs would not clash on it.
        lock = self._path(PUBLISHED, f".{entry.number:0{DIGITS}}")
        try:
            store.create(lock, False).close()
        except Py4JJavaError as error:
            raise PublishError(f"{self.path}: another job publishes number {entry.number}") from error
        store.create(self._path(PUBLISHED, f"{entry.number:0{DIGITS}}-{version}"), False).close()
        return entry

    def replace(self, df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> WriteResult:
        """Write and publish in one go, without further gates."""
        version, result, _ = self.write(df, label, partition_by)
        self.publish(version)
        return result

    def drop_old(self, keep: int = 2) -> list[str]:
        """Delete all versions but the ``keep`` last published ones; never the current one.

        A reader of a deleted version fails, so keep as many as jobs may be reading. Versions
        that were never published, and may be about to be, stay: see ``drop_unpublished``.
        """
        log = self.log()
        kept = list(dict.fromkeys(entry.version for entry in reversed(log)))[: max(keep, 1)]
        old = [v for v in dict.fromkeys(entry.version for entry in log) if v not in kept]
        return self._drop(old)

    def drop_unpublished(self) -> list[str]:
        """Delete what failed jobs left; not to be used while a job writes to the table."""
        published = {entry.version for entry in self.log()}
        store, folder = self._store(), self._path(VERSIONS)
        if not store.exists(folder):
            return []
        found = [status.getPath().getName() for status in store.listStatus(folder)]
        return self._drop([name for name in found if name not in published])

    def _drop(self, versions: Sequence[str]) -> list[str]:
        store = self._store()
        return [v for v in versions if store.delete(self._path(VERSIONS, v), True)]


def publish_all(tables: Sequence[tuple[VersionedTable, str]]) -> None:
    """Publish versions of several tables, once all of them are known to be complete.

    There is no one step for several tables: where a later one fails, those already published
    are set back to what they were, and the error is raised.
    """
    for table, version in tables:
        if not table._store().exists(table._path(VERSIONS, version, "_SUCCESS")):
            raise PublishError(f"{table.version_path(version)} was not written to its end")
    done: list[tuple[VersionedTable, str | None]] = []
    try:
        for table, version in tables:
            before = table.current()
            table.publish(version)
            done.append((table, before))
    except Exception:
        for table, before in reversed(done):
            if before is not None:
                table.publish(before)
        raise
