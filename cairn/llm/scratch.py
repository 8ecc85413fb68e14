"""Intermediate tables in the folder that driver and executors share.

The folder is the one named by ``spark.checkpoint.dir``; only where that is
unset and the master is a local one (tests) a temporary folder is made, which
goes when the process ends.  Cutting a plan with a written table survives the
loss of executors, which ``localCheckpoint`` does not, and computes the plan
once, which ``checkpoint`` without a cache does not.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder, without a trailing slash; ValueError on a cluster that names none."""
    global _own_dir
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{_CHECKPOINT_DIR} must name a folder that driver and executors share")
    if _own_dir is None:
        folder = tempfile.mkdtemp(prefix="cairn-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_dir = "file://" + folder
    return _own_dir


class Scratch:
    """Names, writes, rereads and deletes the intermediate tables of one run."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/cairn-{label}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> str:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return path

    def read(self, path: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read back."""
        path = self.write(df, name)
        out = self.read(path, df.schema)
        out._cairn_path = path
        return out

    def drop(self, *tables: DataFrame | str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            where = table if isinstance(table, str) else table._cairn_path
            at = jvm.org.apache.hadoop.fs.Path(where)
            at.getFileSystem(conf).delete(at, True)
