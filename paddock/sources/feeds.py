"""Typed readers of the raw feeds (CSV with header, header-less CSV folders,
JSON lines, nested JSON lines, multi-line JSON files and folders), always with
an explicit schema (no inference pass over the data).

Unparsable values in typed columns become NULL (the reader's PERMISSIVE mode),
e.g. a ``\\N`` marker in an INT column.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from paddock.schemas import RAW_SCHEMAS

# File (or folder) name and layout of each feed in a delivery folder.
FEED_FILES = {
    "circuits": "circuits.csv",
    "races": "races.csv",
    "constructors": "constructors.json",
    "drivers": "drivers.json",
    "results": "results.json",
    "pit_stops": "pit_stops.json",
    "lap_times": "lap_times",
    "qualifying": "qualifying",
}
FEED_FORMATS = {
    "circuits": "csv_header",
    "races": "csv_header",
    "constructors": "json_lines",
    "drivers": "json_lines",
    "results": "json_lines",
    "pit_stops": "json_multiline",
    "lap_times": "csv_noheader",
    "qualifying": "json_multiline",
}


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """CSV file or folder of CSV files with an explicit (positional) schema."""
    return spark.read.option("header", header).schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """JSON lines (splittable) or multi-line JSON (one task per file)."""
    return spark.read.option("multiLine", multiline).schema(schema).json(path)


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Schema-inferring JSON read (an extra pass over the data; off by default)."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def dated_path(raw_root: str, file_date: str | None, name: str) -> str:
    """``raw_root/<file_date>/<feed file>``: one delivery folder, never a glob of all dates."""
    parts = [raw_root] + ([file_date] if file_date else []) + [FEED_FILES[name]]
    return os.path.join(*parts)


def read_feed(spark: SparkSession, raw_root: str, name: str,
              file_date: str | None = None) -> DataFrame:
    """Read one raw feed (of one delivery folder) with its declared schema."""
    path = dated_path(raw_root, file_date, name)
    schema = RAW_SCHEMAS[name]
    fmt = FEED_FORMATS[name]
    if fmt == "csv_header":
        return read_csv(spark, path, schema, header=True)
    if fmt == "csv_noheader":
        return read_csv(spark, path, schema, header=False)
    return read_json(spark, path, schema, multiline=(fmt == "json_multiline"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
