"""Tables written to the folder that driver and executors share, and read back.

The folder is the one that ``spark.checkpoint.dir`` names.  Only where that is
unset and the master is a plain local one (tests) a temporary folder is made,
which goes when the process ends.  A written table is computed once and
survives the loss of executors.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """URI of the shared folder; ValueError on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if "folder" not in _own:
        _own["folder"] = tempfile.mkdtemp(prefix="cairn-")
        atexit.register(shutil.rmtree, _own["folder"], ignore_errors=True)
    return "file://" + _own["folder"]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/cairn-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
