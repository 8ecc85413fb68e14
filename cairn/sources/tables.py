"""Plain table scans: Parquet with the columns a query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table of a folder, cut to some columns (column pruning reaches the scan)."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by a key: a small compressed file can hide so many rows that the one task that scans it should not also do the work on them."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def in_box(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows in (west, south, east, north); the bounds are pushed down to the scan."""
    west, south, east, north = check_box(box)
    return df.where(f"{lon} BETWEEN {west} AND {east} AND {lat} BETWEEN {south} AND {north}")


def check_box(box: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
    """Four ordered degrees within range, or ValueError."""
    if len(box) != 4:
        raise ValueError("a box has four numbers")
    west, south, east, north = (float(x) for x in box)
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError("a box is west < east and south < north, in degrees")
    return west, south, east, north
