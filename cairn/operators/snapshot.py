"""Snapshot differences, retirement, guards and merges of two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Previous rows from which a shrinking snapshot is refused, and the share that must remain.
GUARD_ROWS = 20
GUARD_SHARE = 0.5


class SnapshotRefused(ValueError):
    """A snapshot that is empty or much smaller than the one before."""


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], fingerprint: str, complete: bool = True) -> DataFrame:
    """``keys, change``: created, updated, unchanged or, only after a complete snapshot, retired."""
    o = old.select(*keys, F.col(fingerprint).alias("_old"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, F.col(fingerprint).alias("_new"), F.lit(True).alias("_in_new"))
    change = (
        F.when(F.col("_in_old").isNull(), "created")
        .when(F.col("_in_new").isNull(), "retired")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("updated"))
    found = o.join(n, keys, "full_outer").select(*keys, change.alias("change"))
    return found if complete else found.where("change <> 'retired'")


def guard_size(old_rows: int, new_rows: int, allow: bool = False, least: int = GUARD_ROWS) -> None:
    """Refuse an empty snapshot always, and one of under half the previous rows unless allowed."""
    if new_rows == 0:
        raise SnapshotRefused("the snapshot has no rows")
    if not allow and old_rows >= least and new_rows < GUARD_SHARE * old_rows:
        raise SnapshotRefused(f"the snapshot has {new_rows} rows, the previous one {old_rows}")


def changed_columns(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys in both states with the names of columns that differ, null-safe."""
    o = old.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    names = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in columns)))
    return new.join(o, keys).select(*keys, names.alias("changed")).where(F.size("changed") > 0)


def carry_point(new_lat: Column, new_lon: Column, old_lat: Column, old_lon: Column, moved: Column) -> Column:
    """A new point if given, else the old one unless the address moved."""
    point = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    none = F.lit(None).cast("double")
    return F.when(new_lat.isNotNull() & new_lon.isNotNull(), point(new_lat, new_lon)).when(
        ~moved, point(old_lat, old_lon)).otherwise(point(none, none))


def retire_missing(state: DataFrame, snapshot: DataFrame, keys: list[str], as_of: Column) -> DataFrame:
    """State rows with ``retired_at``: as_of for rows absent from the snapshot, null (revived) for present ones."""
    seen = snapshot.select(*keys).distinct().withColumn("_seen", F.lit(True))
    earlier = F.col("retired_at") if "retired_at" in state.columns else F.lit(None).cast("timestamp")
    return state.join(seen, keys, "left").withColumn(
        "retired_at", F.when(F.col("_seen").isNull(), F.coalesce(earlier, as_of))).drop("_seen")


def merge(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace by key: the upsert of a lakehouse table as one full outer join."""
    columns = [c for c in state.columns if c not in keys]
    c = changes.select(*keys, F.struct(*columns).alias("_new"))
    s = state.select(*keys, F.struct(*columns).alias("_old"))
    return s.join(c, keys, "full_outer").select(*keys, F.coalesce("_new", "_old").alias("_r")).select(*keys, "_r.*")


def append_new(ledger: DataFrame, rows: DataFrame, fingerprint: str) -> DataFrame:
    """Rows whose fingerprint the ledger does not hold yet, each once."""
    return rows.dropDuplicates([fingerprint]).join(ledger.select(fingerprint), fingerprint, "left_anti")
