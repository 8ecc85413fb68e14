"""Tables in versions: each write makes a new version, and a log of versions says which one holds.

A version that was written but never entered in the log is never read, so a
failed or refused write leaves the table as it was.  The log has one row a
version and is appended to by a Spark write, on any file system.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version long, path string, note string"


class Conflict(RuntimeError):
    """Another writer entered a version after this one had read the table."""


class VersionedTable:
    """A table of one schema under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        spark.createDataFrame([], _LOG).write.mode("append").parquet(f"{self.root}/log")

    def latest(self) -> tuple[int, str | None, str]:
        """Number, path and note of the version that holds; (0, None, "") before the first."""
        log = self.spark.read.schema(_LOG).parquet(f"{self.root}/log")
        row = log.agg(F.max(F.struct("version", "path", "note")).alias("v")).first()
        return tuple(row["v"]) if row["v"] else (0, None, "")

    def read(self) -> DataFrame:
        """The version that holds, without rows before the first."""
        _, path, _ = self.latest()
        return self.spark.read.schema(self.schema).parquet(path) if path else self.spark.createDataFrame([], self.schema)

    def prepare(self, df: DataFrame) -> str:
        """Write a version that does not hold yet."""
        path = f"{self.root}/v-{uuid.uuid4().hex}"
        df.select(*self._names()).write.option("compression", "zstd").parquet(path)
        return path

    def enter(self, path: str, base: int, note: str = "") -> int:
        """Let a prepared version hold, unless another than ``base`` holds by now."""
        now, _, _ = self.latest()
        if now != base:
            raise Conflict(f"version {now} was entered after {base} had been read")
        self.spark.createDataFrame([(base + 1, path, note)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return base + 1

    def replace(self, df: DataFrame, base: int, note: str = "") -> int:
        return self.enter(self.prepare(df), base, note)

    def _names(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns
