"""Settings for the Python side of operators, and runs over sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of one Arrow batch handed to Python: bounds memory whatever the row size.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes and let Python workers import this library.

    A smaller bound that the session has stays.  Workers on other machines need
    the library installed there or sent with ``addPyFile``.
    """
    known = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < known <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *paths])


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
         for n, c in columns.items()],
        schema=schema,
    )


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys, and the row at which each run begins (and the end).

    The batches must be sorted by the integer columns ``keys``.  The last run of
    a batch is held back until a later batch shows where it ends.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [numbers(b.column(b.schema.get_field_index(k))) for k in keys]
        last = [c[-1] for c in cols]
        same = np.ones(b.num_rows, dtype=bool)
        for c, v in zip(cols, last):
            same &= c == v
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut == 0 and held and all(
            numbers(held[-1].column(held[-1].schema.get_field_index(k)))[-1] == v for k, v in zip(keys, last)
        ):
            held.append(b)
            continue
        ready = [*held, b.slice(0, cut)] if cut else held
        if ready:
            yield _with_runs(pa.Table.from_batches(ready), keys)
        held = [b.slice(cut)]
    if held:
        yield _with_runs(pa.Table.from_batches(held), keys)


def _with_runs(table: pa.Table, keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = table.combine_chunks()
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return table, np.append(np.flatnonzero(new), table.num_rows)
