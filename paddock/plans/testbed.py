"""Processed-layer frames derived from the test tables, without files.

The raw feeds of ``paddock.sources.testtables`` go through the same conform
steps as the ingestion jobs, lazily, so that Catalyst plans each query from
the Parquet test tables end to end (pruned columns, pushed filters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.plans.ingest import CONFORM
from paddock.sources.testtables import BATCHES, DATA_SOURCE, raw_feed

# Parameters of the queries on the test tables (thresholds
# scaled to the test data; the source analyses use 10 / 11, 50 and 100;
# BUCKETS is the race-bucket count of the bucketed merge layout).
TOP_N = 5
DRIVER_MIN = 22
TEAM_MIN = 430
DRIVER_WINDOW_MIN = 10
TEAM_WINDOW_MIN = 200
WINDOW1 = (1998, 2001)
WINDOW2 = (1995, 1997)
TOP_DRIVERS = 10
TOP_TEAMS = 5
BUCKETS = 8
LOAD_TS = "2021-03-21 06:00:00"
FILE_DATES = [b[0] for b in BATCHES]


def batch_stamp(file_date: str) -> str:
    return f"{file_date} 06:00:00"


def processed(spark: SparkSession, sf_dir: str, names=("circuits", "races", "constructors",
                                                        "drivers", "results")) -> dict[str, DataFrame]:
    """Full-load processed tables (no file_date)."""
    tables: dict = {}
    return {n: CONFORM[n](raw_feed(spark, sf_dir, n, tables=tables), DATA_SOURCE, None, LOAD_TS)
            for n in names}


def processed_batches(spark: SparkSession, sf_dir: str, name: str = "results") -> DataFrame:
    """A fact as the union of its delivery batches, each stamped with its file_date."""
    out, tables = None, {}
    for d in FILE_DATES:
        df = CONFORM[name](raw_feed(spark, sf_dir, name, d, tables=tables), DATA_SOURCE, d,
                           batch_stamp(d))
        out = df if out is None else out.unionByName(df)
    return out
