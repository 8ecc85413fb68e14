"""Latest-per-key, ranked selection and as-of joins.

Latest rows are aggregates (``max`` of a struct), not windows: they combine
before the shuffle, so a key with very many rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str] | None = None) -> DataFrame:
    """For each key the row that is largest by ``order``; nulls are smallest.

    Of rows that are equal in ``order`` the one with the largest other values counts, maps aside.
    """
    values = values if values is not None else [c for c in df.columns if c not in {*keys, *order}]
    plain = [c for c in values if "map<" not in df.schema[c].dataType.simpleString()]
    row = F.struct(*order, *plain)
    best = (F.max(row) if plain == values else F.max_by(F.struct(*order, *values), row)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in [*order, *values]))


def first_of_ties(df: DataFrame, keys: list[str], order: str, position: str) -> DataFrame:
    """The latest row of each key; of equal times the one that stands first in the input."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.asc(position))
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")


def margin_top1(df: DataFrame, keys: list[str], score: str, tie: str, margin: float) -> DataFrame:
    """The best row of each key if it beats the second by ``margin`` (or has no second), with the lead."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    ranked = df.withColumn("_k", F.row_number().over(w)).withColumn("_next", F.lead(score).over(w))
    return ranked.where("_k = 1").where(F.col("_next").isNull() | (F.col(score) - F.col("_next") >= margin)).drop("_k")


def one_to_one(df: DataFrame, left: str, right: str, order: list[Column]) -> DataFrame:
    """Pairs that are the best of both their sides."""
    a = F.row_number().over(Window.partitionBy(left).orderBy(*order, right))
    b = F.row_number().over(Window.partitionBy(right).orderBy(*order, left))
    return df.withColumn("_a", a).withColumn("_b", b).where("_a = 1 AND _b = 1").drop("_a", "_b")


def one_owner(pairs: DataFrame, record: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Each record goes to its first-ranked anchor; the other pairs go to review."""
    ranked = pairs.withColumn("_k", F.row_number().over(Window.partitionBy(record).orderBy(*order)))
    return ranked.where("_k = 1").drop("_k"), ranked.where("_k > 1").drop("_k")


def changed_only(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs (null-safe) from that of the row before; the first row counts as changed."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_before", F.lag(value).over(w)).withColumn("_n", F.row_number().over(w))
    return marked.where((F.col("_n") == 1) | ~F.col("_before").eqNullSafe(F.col(value))).drop("_before", "_n")


def effective_intervals(policies: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Policy versions with the time at which the next one takes over (null for the last)."""
    return policies.withColumn("effective_until", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))


def join_effective(rows: DataFrame, policies: DataFrame, keys: list[str], at: str, start: str) -> DataFrame:
    """Each row with the policy version in force at its time, null before the first.

    An equi-join on the keys with a range residual over disjoint intervals: a row matches once at most.
    """
    versions = effective_intervals(policies, keys, start)
    p = versions.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in versions.columns if c not in keys))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    on += [F.col(start) <= F.col(at), F.col("effective_until").isNull() | (F.col(at) < F.col("effective_until"))]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return rows.join(p, cond, "left").drop(*(f"_{k}" for k in keys))


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, values: list[str], width: float | None = None) -> DataFrame:
    """The latest right row at or before each left row, by one union and one window (no range join).

    With a ``width`` (of numbers, or seconds of times) a key's rows are dealt by
    stretches of that length, so a key with very many rows is many tasks: the
    last known row of each stretch is carried to the later ones.
    """
    cols = left.columns
    asked = left.withColumn("_t", F.col(at)).withColumn("_side", F.lit(1))
    known = right.select(*keys, F.col(since).alias("_t"), F.lit(0).alias("_side"), F.struct(*values).alias("_r"))
    both = asked.unionByName(known, allowMissingColumns=True)
    if width is None:
        w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
        seen = both.withColumn("_seen", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    else:
        both = both.withColumn("_b", F.floor(F.col("_t").cast("double") / width))
        tails = both.groupBy(*keys, "_b").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_t"))).alias("_tail"))
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each stretch
        carried = tails.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_b").alias("_stretch"), F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
        within = Window.partitionBy(*keys, "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
        own = both.withColumn("_own", F.last("_r", ignorenulls=True).over(within)).where("_side = 1")
        same = F.col("_b").eqNullSafe(F.col("_stretch"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        seen = own.join(carried, same, "left").withColumn("_seen", F.coalesce("_own", "_carry"))
    return seen.select(*cols, *(F.col(f"_seen.{v}").alias(v) for v in values))
