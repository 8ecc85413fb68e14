"""Near-duplicate embeddings by random-hyperplane signs, exact cosines and components.

Every vector has a sign code in each of several tables.  Vectors that share a
code in a table are compared exactly; a pair that an earlier table has already
brought together is left to that table, so counts need no list of pairs.
Buckets leave their task as per-vector counts and a spanning forest of the
links, both linear in the bucket.  Equal vectors are compared once, with their
number as weight; a bucket beyond ``BLOCK`` vectors is compared in pairs of
blocks, each a unit of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime
from cairn.llm.components import connected_components
from cairn.llm.scratch import Scratch

THRESHOLD = 0.9
#: Chance that a pair exactly at the threshold shares a code in some table.
RECALL = 0.97
#: Vectors of one block of a bucket.
BLOCK = 1024
#: Vectors of one bucket, about: larger buckets need fewer tables and more comparisons, which are cheap beside shipped vectors.
BUCKET = 128
#: Bits of the longest code; the number of its table stands above them in a bucket's key.
MOST_BITS = 48
SEED = 20240607
_CODED = "vec_id long, dim int, same1 long, same2 long, vector binary, codes binary"


def table_plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a code, and number of tables, for n vectors: buckets stay small, recall at the threshold holds."""
    bits = min(MOST_BITS, max(4, math.ceil(math.log2(max(2, n) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _code_type(bits: int) -> str:
    return "<u2" if bits <= 16 else "<u4" if bits <= 32 else "<u8"


def _usable(lists: pa.Array) -> list[np.ndarray | None]:
    out = []
    for x in lists:
        v = None
        if x.is_valid and not x.values.null_count:
            v = x.values.to_numpy(zero_copy_only=False)
            v = v if len(v) and np.isfinite(v).all() and v.any() else None
        out.append(v)
    return out


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def coded(vectors: DataFrame, bits: int, tables: int, id_col: str = "vec_id", vector_col: str = "embedding",
          seed: int = SEED) -> DataFrame:
    """``vec_id, dim, same1, same2, vector, codes``: a 128-bit hash of the vector, its components, and a code for each table.

    Components stay floats or doubles; others become doubles.  Unusable vectors
    have null ``vector`` and ``codes``.
    """
    runtime.prepare(vectors.sparkSession)
    kind = vectors.schema[vector_col].dataType
    value = F.col(vector_col)
    if kind.elementType.typeName() not in ("float", "double"):
        value = value.cast("array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = np.left_shift(np.uint64(1), np.arange(bits, dtype=np.uint64))
        for b in batches:
            rows = _usable(b.column("v"))
            codes: list[bytes | None] = [None] * len(rows)
            for dim in {len(v) for v in rows if v is not None}:
                own = [i for i, v in enumerate(rows) if v is not None and len(v) == dim]
                if dim not in planes:
                    planes[dim] = np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, bits * tables))
                signs = (_units(np.stack([rows[i] for i in own])) @ planes[dim] > 0).reshape(len(own), tables, bits)
                c = (signs * powers).sum(axis=2).astype(_code_type(bits))
                for k, i in enumerate(own):
                    codes[i] = c[k].tobytes()
            raw = [None if v is None else v.tobytes() for v in rows]
            marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(r or b"") for r in raw), "<i8").reshape(len(raw), 2)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").cast(pa.int64()), pa.array([0 if v is None else len(v) for v in rows], pa.int32()),
                pa.array(marks[:, 0]), pa.array(marks[:, 1]), pa.array(raw, pa.binary()), pa.array(codes, pa.binary())],
                names=["vec_id", "dim", "same1", "same2", "vector", "codes"])

    return vectors.select(F.col(id_col).alias("vec_id"), value.alias("v")).mapInArrow(run, _CODED)


def _signatures(bits: int, tables: int):
    """Rows of one (table, code) for each vector and table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            c = np.frombuffer(b"".join(b.column("codes").to_pylist()), _code_type(bits)).reshape(b.num_rows, tables)
            key = c.astype(np.int64) + (np.arange(tables, dtype=np.int64) << MOST_BITS)
            yield pa.RecordBatch.from_arrays(
                [b.column("same1"), b.column("same2"), b.column("dim"), pa.array(list(key), pa.list_(pa.int64()))],
                names=["same1", "same2", "dim", "keys"])

    return run


def _components(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row number reached by each row and column of a bipartite adjacency (rows first)."""
    n, m = close.shape
    rows, cols = np.arange(n), np.full(m, n + m)
    while True:
        new_cols = np.minimum(cols, np.where(close, rows[:, None], n + m).min(axis=0))
        new_rows = np.minimum(rows, np.where(close, new_cols[None, :], n + m).min(axis=1))
        if (new_rows == rows).all() and (new_cols == cols).all():
            return rows, cols
        rows, cols = new_rows, new_cols


def _close(x: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which cosines reach the threshold; those that single precision does not decide are computed in double."""
    single = x.astype(np.float32)
    cosine = single[left] @ single[right].T
    margin = 2e-7 * x.shape[1] + 1e-5
    close = cosine >= threshold
    i, j = np.nonzero(np.abs(cosine - np.float32(threshold)) <= margin)
    for lo in range(0, len(i), 1 << 14):
        p, q = i[lo : lo + (1 << 14)], j[lo : lo + (1 << 14)]
        close[p, q] = np.einsum("ij,ij->i", x[left[p]], x[right[q]]) >= threshold
    return close


def _compare(bits: int, tables: int, threshold: float):
    """Exact comparison of units (buckets, or pairs of their blocks) into counts (a and b name the vector by its hash) and,
    with n = 0, forest edges (a and b are ids)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def unit(x: np.ndarray, codes: np.ndarray, left: np.ndarray, right: np.ndarray, table: int,
             within: bool) -> np.ndarray:
        close = _close(x, left, right, threshold)
        if within:
            close &= left[:, None] != right[None, :]
        for k in range(table if close.any() else 0):  # an earlier table has had this pair
            close &= codes[left, k][:, None] != codes[right, k][None, :]
        return close

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in runtime.sorted_runs(batches, ["key", "dim", "low", "high"]):
            ids, same1, same2, weight, key, dims, block, low, high = (
                t.column(c).to_numpy() for c in ("vec_id", "same1", "same2", "weight", "key", "dim", "block", "low", "high"))
            raw, raw_codes = t.column("vector").to_pylist(), t.column("codes").to_pylist()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s, e in zip(at[:-1], at[1:]):
                within = low[s] == high[s]
                left, right = np.flatnonzero(block[s:e] == low[s]), np.flatnonzero(block[s:e] == high[s])
                if e - s < 2 or not len(left) or not len(right):
                    continue
                kind = np.float64 if len(raw[s]) == 8 * dims[s] else np.float32
                x = _units(np.frombuffer(b"".join(raw[s:e]), kind).reshape(e - s, -1))
                codes = np.frombuffer(b"".join(raw_codes[s:e]), _code_type(bits)).reshape(e - s, tables)
                close = unit(x, codes, left, right, int(key[s]) >> MOST_BITS, within)
                if not close.any():
                    continue
                own, count = ids[s:e], np.zeros(e - s, np.int64)
                count[left] += close @ weight[s:e][right]
                if not within:
                    count[right] += weight[s:e][left] @ close
                hit = np.flatnonzero(count)
                out.append((same1[s:e][hit], same2[s:e][hit], count[hit]))
                root_l, root_r = _components(close)
                for members, root in ((left, root_l), (right, root_r)):
                    linked = root < len(left)
                    a, b = own[members[linked]], own[left[root[linked]]]
                    out.append((a[a != b], b[a != b], np.zeros((a != b).sum(), np.int64)))
            if out:
                a, b, n = (np.concatenate(c) for c in zip(*out))
                yield runtime.batch(schema, a=a, b=b, n=n)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Pairs are linked where they share a code in some table and their cosine, in
    double precision, is at least ``threshold``.  Null, empty and zero vectors
    and those with null, NaN or infinite components link with nothing; vectors
    of different lengths neither.  Equal vectors (ties) are linked with each
    other.  Rows that repeat an id are vectors of their own, with their own
    links, and share a component.  A row without id is returned with null
    component.  An empty table gives none; other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    bits, tables = table_plan(vectors.count(), threshold, recall)
    all_rows = scratch.cut(coded(vectors, bits, tables, id_col, vector_col), "coded")
    usable = all_rows.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    one = scratch.cut(usable.groupBy("same1", "same2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("dim").alias("dim"),
        F.first("vector").alias("vector"), F.first("codes").alias("codes")), "distinct")
    groups = one.select("same1", "same2", "rep", "weight")
    same = ["same1", "same2"]
    keys = one.select(*same, "dim", "codes").mapInArrow(
        _signatures(bits, tables), "same1 long, same2 long, dim int, keys array<long>").select(*same, "dim", F.explode("keys").alias("key"))
    sizes = keys.groupBy("key", "dim").count().where("count > 1").select(
        "key", "dim", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    placed = keys.join(sizes, ["key", "dim"]).withColumn(
        "block", F.pmod(F.xxhash64(*same, "key"), F.col("blocks")).cast("int"))
    units = placed.select(*same, "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        *same, "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = scratch.cut(
        units.join(one, same)
        .select("key", "dim", "low", "high", "block", F.col("rep").alias("vec_id"), *same, "weight", "vector", "codes")
        .repartition(runtime.partitions_for(spark), "key", "low", "high")
        .sortWithinPartitions("key", "dim", "low", "high")
        .mapInArrow(_compare(bits, tables, threshold), "a long, b long, n long"),
        "found")
    links = found.where("n > 0").groupBy(F.col("a").alias("same1"), F.col("b").alias("same2")).agg(F.sum("n").alias("others"))
    # an id with several vectors is one node
    several = usable.groupBy("vec_id").agg(F.min(F.struct(*same)).alias("x"), F.max(F.struct(*same)).alias("y")).where("x <> y").select("vec_id")
    of_one_id = usable.select("vec_id", *same).join(several, "vec_id", "left_semi").join(groups, same).select(
        F.col("rep").alias("src"), F.col("vec_id").alias("dst"))
    edges = found.where("n = 0").select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(of_one_id)
    classes = connected_components(edges, scratch)
    of_rep = groups.join(links, same, "left").join(
        classes.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        *same, (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    # what links with nothing has no mark to be joined by
    marks = [F.when(F.col("vec_id").isNotNull() & F.col("vector").isNotNull(), F.col(c)).alias(c) for c in same]
    return all_rows.select("vec_id", *marks).join(of_rep, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))
