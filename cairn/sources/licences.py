"""Licence exports: zipped CSV with a preamble, fixed-width records, and their row mapper."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from cairn.functions.text import first_filled, join_filled, slug
from cairn.functions.values import parse_date
from cairn.operators.classify import classify_license

_ROWS = StructType([StructField("path", StringType()), StructField("fields", MapType(StringType(), StringType()))])
#: Rows of one batch that leave the CSV reader.
_BATCH = 2000


def read_zipped_csv(spark: SparkSession, path: str, header_tokens: tuple[str, ...]) -> DataFrame:
    """``path, fields``: rows of the largest ``.csv`` member of each zip file, by column name.

    Lines before the one that holds all header tokens are skipped; bad bytes are
    replaced.  One archive is one task (zip members cannot be split); rows leave
    it in batches.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    members = [m for m in z.infolist() if m.filename.lower().endswith(".csv")]
                    if not members:
                        continue
                    with z.open(max(members, key=lambda m: m.file_size)) as raw:
                        lines = io.TextIOWrapper(raw, "utf-8-sig", "replace", newline="")
                        header = next((x for x in lines if all(t.lower() in x.lower() for t in header_tokens)), None)
                        if header is None:
                            continue
                        names = next(csv.reader([header]))
                        rows: list[dict] = []
                        for r in csv.reader(lines):
                            rows.append(dict(zip(names, r)))
                            if len(rows) >= _BATCH:
                                yield pd.DataFrame({"path": name, "fields": rows})
                                rows = []
                        if rows:
                            yield pd.DataFrame({"path": name, "fields": rows})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, _ROWS)


def slice_fixed_width(lines: DataFrame, layout: list[tuple[str, int, int]], value: str = "value") -> DataFrame:
    """Columns cut from fixed places (name, start from 1, length) of a text column, trimmed; blanks are null."""
    return lines.select(*(F.nullif(F.trim(F.substring(F.col(value), start, length)), F.lit("")).alias(name)
                          for name, start, length in layout))


def canonical_headers(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores."""
    import re

    return df.toDF(*(re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c in df.columns))


def license_status(status: Column, kind: Column) -> Column:
    """open, closed or unknown from an exact list; an application is never open."""
    s = F.upper(F.trim(status))
    return (F.when(F.upper(F.trim(kind)).startswith("APP"), "unknown").when(s == "ACTIVE", "open")
            .when(s.isin("REVOKED", "CANCELLED", "CANCELED", "SURRENDERED", "EXPIRED", "INACTIVE"), "closed").otherwise("unknown"))


def map_licences(rows: DataFrame) -> DataFrame:
    """Source records of licence rows with canonical headers; rows without number, name, address or city are left out."""
    kind = classify_license(F.col("license_type"))
    mapped = rows.select(
        F.lit("ca_abc").alias("source"), first_filled(F.col("file_number")).alias("source_record_id"),
        first_filled(F.col("dba_name"), F.col("primary_name")).alias("name"),
        join_filled(F.col("premise_street_address_1"), F.col("premise_street_address_2")).alias("address"),
        first_filled(F.col("premise_city")).alias("city"), first_filled(F.col("premise_state")).alias("region"),
        first_filled(F.col("premise_zip")).alias("postal_code"),
        license_status(F.col("type_status"), F.col("license_or_application")).alias("source_status"),
        kind["type"].alias("primary_type"), kind["confidence"].alias("classification_confidence"), kind["eligible"].alias("eligible"),
        parse_date(F.col("type_original_issue_dates")).alias("issued"), parse_date(F.col("expiration_dates")).alias("expires"),
        F.col("license_type"))
    return mapped.where("source_record_id IS NOT NULL AND name IS NOT NULL AND address <> '' AND city IS NOT NULL")


def export_links(html: Column) -> Column:
    """Links of a page to data exports, CSV before others."""
    links = F.regexp_extract_all(html, F.lit(r"(?i)href\s*=\s*[\"']([^\"']+\.(?:csv|zip|txt|xlsx?))[\"']"), F.lit(1))
    is_csv = lambda x: F.lower(x).contains("csv")
    return F.concat(F.filter(links, is_csv), F.filter(links, lambda x: ~is_csv(x)))


def token_slugs(breadcrumbs: Column) -> Column:
    """Category tokens of breadcrumbs with ``>``, ``/`` or ``›`` between labels."""
    parts = F.flatten(F.transform(breadcrumbs, lambda b: F.split(b, "[>/›]")))
    return F.array_distinct(F.filter(F.transform(parts, slug), lambda t: t != ""))
