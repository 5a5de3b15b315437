"""Parquet tables that are replaced all or nothing.

A folder holds numbered versions; a version counts once its marker (``_SUCCESS``) exists, and readers
take the newest one. Writing (``stage``) and publishing (``commit``) are two steps, so that checks can run on staged
rows. A job that dies leaves the previous state in place, and the next attempt overwrites its remains.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "month string, version string"
_MARKER = "_SUCCESS"


class PublishConflict(RuntimeError):
    """Somebody else published since the rows were staged."""


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    fs, path = _fs(spark, folder)
    fs.delete(path, True)


def _is_marked(spark: SparkSession, folder: str) -> bool:
    fs, path = _fs(spark, f"{folder}/{_MARKER}")
    return fs.exists(path)


def _mark(spark: SparkSession, folder: str) -> None:
    """Publish a staged version; of two publishers of one number the second fails."""
    fs, path = _fs(spark, f"{folder}/{_MARKER}")
    if not fs.createNewFile(path):
        raise PublishConflict(f"{folder} was published by another job")


def committed_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions under ``folder``, ascending."""
    numbers = [n for n in _children(spark, folder) if n.isdigit()]
    return sorted(int(n) for n in numbers if _is_marked(spark, f"{folder}/{n}"))


def _overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    """Write without a marker."""
    writer = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    )
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


class VersionedTable:
    """A table that is rebuilt in full."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._staged: int | None = None

    def read(self) -> DataFrame | None:
        """The newest version, or None before the first."""
        done = committed_versions(self.spark, self.root)
        return self.spark.read.parquet(f"{self.root}/{done[-1]}") if done else None

    def stage(self, df: DataFrame) -> DataFrame:
        """Write the next version, which readers do not see yet, and read it back."""
        done = committed_versions(self.spark, self.root)
        self._staged = (done[-1] if done else 0) + 1
        _overwrite(df, f"{self.root}/{self._staged}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{self._staged}")

    def commit(self) -> None:
        """Publish the staged version and drop those older than the last ``keep``."""
        _mark(self.spark, f"{self.root}/{self._staged}")
        self._staged = None
        for old in committed_versions(self.spark, self.root)[: -self.keep]:
            _delete(self.spark, f"{self.root}/{old}")

    def replace(self, df: DataFrame) -> DataFrame:
        """Stage and publish."""
        rows = self.stage(df)
        self.commit()
        return rows


@dataclass
class Staged:
    """Months of a table that are written but not published."""

    table: MonthlyTable
    generation: int
    version: str
    months: set[str]
    schema: T.StructType

    def read(self, only_months: set[str] | None = None) -> DataFrame:
        """The table as it will be, optionally some months only."""
        state = {**self.table.months(), **dict.fromkeys(self.months, self.version)}
        return self.table._rows(state, only_months, self.schema)

    def rows(self) -> DataFrame:
        """The staged months."""
        return self.read(self.months)

    def commit(self) -> None:
        self.table._publish(self)


class MonthlyTable:
    """A table whose months are replaced independently.

    A publish writes the touched months under a fresh version and then one small manifest
    (month -> version), which is itself a numbered version. Untouched months are
    never rewritten. ``month`` is the SQL expression of a row's month. ``schema`` has the columns that every
    row has; a publish may bring further ones, which are null in months that were written before.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        month: str = "date_format(date, 'yyyy-MM')",
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.base = schema
        self.month = month

    def _manifest(self, generation: int) -> dict[str, str]:
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/{generation}")
        return {r["month"]: r["version"] for r in rows.collect()}

    def months(self) -> dict[str, str]:
        """Month -> version of the current state; one entry per calendar month."""
        done = committed_versions(self.spark, f"{self.root}/manifest")
        return self._manifest(done[-1]) if done else {}

    @property
    def schema(self) -> T.StructType:
        """Columns of the current state: every publish writes all of them, so the newest one's files tell."""
        newest = max(self.months().items(), key=lambda x: (int(x[1].split("-")[0]), x[0]), default=None)
        if newest is None:
            return self.base
        stored = self.spark.read.parquet(f"{self.root}/data/version={newest[1]}/month={newest[0]}").schema
        known = set(self.base.fieldNames())
        return T.StructType([*self.base.fields, *(f for f in stored.fields if f.name not in known)])

    def _rows(self, state: dict[str, str], only_months: set[str] | None, schema: T.StructType) -> DataFrame:
        wanted = [
            f"{self.root}/data/version={v}/month={m}"
            for m, v in sorted(state.items())
            if only_months is None or m in only_months
        ]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def read(self, only_months: set[str] | None = None) -> DataFrame:
        """The current rows, optionally of some months only (others are not listed)."""
        return self._rows(self.months(), only_months, self.schema)

    def between(self, first, last) -> DataFrame:
        """The rows of the months from that of one date to that of another (either may be None); other months are not listed."""
        low, high = str(first)[:7] if first else "", str(last)[:7] if last else "~"
        return self.read({m for m in self.months() if low <= m <= high})

    def touched_months(self, batch: DataFrame) -> set[str]:
        """Months present in a batch (bounded by the calendar)."""
        return {r["m"] for r in batch.select(F.expr(self.month).alias("m")).distinct().collect()}

    def stage(self, rows: DataFrame, months: set[str]) -> Staged:
        """Write the rows of ``months``, which readers do not see yet."""
        done = committed_versions(self.spark, f"{self.root}/manifest")
        generation = (done[-1] if done else 0) + 1
        version = f"{generation}-{uuid.uuid4().hex[:8]}"
        # rebalance: adaptive execution splits a month that holds most rows, merges small ones
        placed = rows.withColumn("month", F.expr(self.month)).hint("rebalance", "month")
        _overwrite(placed, f"{self.root}/data/version={version}", "month")
        written = {c.removeprefix("month=") for c in _children(self.spark, f"{self.root}/data/version={version}") if c.startswith("month=")}
        return Staged(self, generation, version, months & written, rows.schema)

    def _publish(self, staged: Staged) -> None:
        state = {**self.months(), **dict.fromkeys(staged.months, staged.version)}
        folder = f"{self.root}/manifest/{staged.generation}"
        if committed_versions(self.spark, f"{self.root}/manifest")[-1:] >= [staged.generation]:
            raise PublishConflict(f"{folder} was published by another job")
        _overwrite(self.spark.createDataFrame(sorted(state.items()), _MANIFEST).coalesce(1), folder)
        _mark(self.spark, folder)

    def publish(self, rows: DataFrame, months: set[str]) -> None:
        """Replace ``months`` by ``rows`` and keep every other month as it is."""
        self.stage(rows, months).commit()

    def vacuum(self, keep: int = 2) -> int:
        """Delete month folders that none of the last ``keep`` manifests refers to."""
        done = committed_versions(self.spark, f"{self.root}/manifest")
        kept = {item for g in done[-keep:] for item in self._manifest(g).items()}
        dropped = 0
        for name in _children(self.spark, f"{self.root}/data"):
            version = name.removeprefix("version=")
            if not done or int(version.split("-")[0]) > done[-1]:
                continue  # may be staged by a job that is still at work
            for month in _children(self.spark, f"{self.root}/data/{name}"):
                if month.startswith("month=") and (month[6:], version) not in kept:
                    _delete(self.spark, f"{self.root}/data/{name}/{month}")
                    dropped += 1
        return dropped
