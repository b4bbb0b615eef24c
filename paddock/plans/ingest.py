"""Ingestion of the eight raw feeds into the processed layer.

``conform_<feed>`` are pure DataFrame -> DataFrame steps (select, rename,
audit columns, struct flattening, timestamp parsing) that Catalyst collapses
into one projection over the scan. ``ingest`` adds reading and writing, in
full mode (overwrite) or incremental mode (one delivery folder, deterministic
dedupe, keyed upsert).

Fact tables are partitioned by ``race_year`` (taken from the processed races
by a join) rather than by ``race_id``: a season is a coarse, prunable folder,
where one folder per race would mean thousands of tiny files.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.conform import (add_audit_columns, dedupe_by_key, flatten_struct,
                                       race_timestamp, rename_columns)
from paddock.schemas import RENAMES
from paddock.sinks.writes import overwrite_parquet, upsert
from paddock.sources.feeds import read_feed

Stamp = str | _dt.datetime | None


def conform_circuits(raw: DataFrame, data_source: str, file_date: str | None = None,
                     load_ts: Stamp = None) -> DataFrame:
    df = raw.select("circuitId", "circuitRef", "name", "location", "country", "lat", "lng", "alt")
    df = rename_columns(df, RENAMES["circuits"])
    return add_audit_columns(df, data_source, file_date, load_ts)


def conform_races(raw: DataFrame, data_source: str, file_date: str | None = None,
                  load_ts: Stamp = None) -> DataFrame:
    df = raw.withColumn("race_timestamp", race_timestamp("date", "time"))
    df = add_audit_columns(df, data_source, file_date, load_ts)
    cols = [F.col("raceId").alias("race_id"), F.col("year").alias("race_year"), "round",
            F.col("circuitId").alias("circuit_id"), "name", "ingestion_date", "data_source",
            "race_timestamp"]
    if file_date is not None:
        cols.append("file_date")
    return df.select(*cols)


def conform_constructors(raw: DataFrame, data_source: str, file_date: str | None = None,
                         load_ts: Stamp = None) -> DataFrame:
    df = rename_columns(raw.drop("url"), RENAMES["constructors"])
    return add_audit_columns(df, data_source, file_date, load_ts)


def conform_drivers(raw: DataFrame, data_source: str, file_date: str | None = None,
                    load_ts: Stamp = None) -> DataFrame:
    df = add_audit_columns(raw, None, None, load_ts)
    df = rename_columns(df, RENAMES["drivers"])
    df = flatten_struct(df, "name", ["forename", "surname"], " ")
    df = add_audit_columns(df, data_source, file_date, None, ts_column="")
    return df.drop("url")


def conform_results(raw: DataFrame, data_source: str, file_date: str | None = None,
                    load_ts: Stamp = None) -> DataFrame:
    df = rename_columns(raw, RENAMES["results"])
    df = add_audit_columns(df, data_source, file_date, load_ts)
    return df.drop("statusId")


def _conform_timing(name: str):
    def conform(raw: DataFrame, data_source: str, file_date: str | None = None,
                load_ts: Stamp = None) -> DataFrame:
        df = add_audit_columns(raw, None, None, load_ts)
        df = rename_columns(df, RENAMES[name])
        return add_audit_columns(df, data_source, file_date, None, ts_column="")
    conform.__name__ = f"conform_{name}"
    return conform


conform_pit_stops = _conform_timing("pit_stops")
conform_lap_times = _conform_timing("lap_times")
conform_qualifying = _conform_timing("qualifying")

CONFORM = {
    "circuits": conform_circuits,
    "races": conform_races,
    "constructors": conform_constructors,
    "drivers": conform_drivers,
    "results": conform_results,
    "pit_stops": conform_pit_stops,
    "lap_times": conform_lap_times,
    "qualifying": conform_qualifying,
}

# Merge keys of the incrementally loaded facts, and the
# business key results are deduplicated on before merging.
MERGE_KEYS = {
    "results": ["result_id", "race_id"],
    "pit_stops": ["race_id", "driver_id", "stop"],
    "lap_times": ["race_id", "driver_id", "lap"],
    "qualifying": ["qualify_id", "race_id"],
}
DEDUPE_KEYS = {
    "results": ["race_id", "driver_id"],
}
FACTS = tuple(MERGE_KEYS)
# The part of every merge key that decides the season: a row moves only with its race.
SEASON_KEY = ["race_id"]
PERIOD = "race_year"
BUCKET = "race_bucket"
# Race buckets a season of the incremental jobs' tables: choose as many as bring a folder, which
# a one-race delivery rewrites whole, to a few GB (a season of 14 TB: about 4,000); 0 for small
# tables, one folder a season.
DEFAULT_BUCKETS = 8


def partition_columns(buckets: int = 0) -> list[str]:
    """Season, plus a race bucket when ``buckets`` > 0.

    The bucket (``pmod(race_id, buckets)``) is a function of the merge key, so
    a matched row never changes folder. A merge rewrites whole partition
    folders, so with buckets a one-race delivery rewrites about 1/``buckets``
    of a season instead of all of it; season pruning is unchanged.
    """
    return [PERIOD, BUCKET] if buckets else [PERIOD]


def bucket_columns(buckets: int = 0) -> list[str]:
    """The partition columns that are functions of every merge key."""
    return [BUCKET] if buckets else []


def with_bucket(df: DataFrame, buckets: int = 0) -> DataFrame:
    if not buckets:
        return df
    return df.withColumn(BUCKET, F.pmod(F.col("race_id"), F.lit(buckets)).cast("int"))


def with_period(fact: DataFrame, races: DataFrame, period_col: str = PERIOD,
                buckets: int = 0) -> DataFrame:
    """Attach the race's season (and bucket) to fact rows (left join: no fact
    row is lost)."""
    return with_bucket(fact.join(races.select("race_id", period_col), "race_id", "left"),
                       buckets)


def prepare_incremental(fact: DataFrame, name: str, races: DataFrame,
                        buckets: int = 0) -> DataFrame:
    """Batch rows ready to merge: deterministic dedupe on the business key,
    then on the merge key, plus the partition columns.

    Every key and the join with the races hold ``race_id``, so the rows are shuffled once,
    by race, and not for each step again. A race is small by nature (its field)."""
    out = fact.repartition("race_id")
    if name in DEDUPE_KEYS:
        out = dedupe_by_key(out, DEDUPE_KEYS[name])
    out = dedupe_by_key(out, MERGE_KEYS[name])
    return with_period(out, races, buckets=buckets)


def ingest(spark: SparkSession, raw_root: str, processed_root: str, name: str,
           data_source: str = "", file_date: str | None = None,
           load_ts: Stamp = None, incremental: bool = False, buckets: int = 0) -> str:
    """Read one feed (of one delivery folder), conform it and write it.

    Full mode overwrites ``processed_root/<name>``; facts are partitioned by
    season (and race bucket, see ``partition_columns``). Incremental mode
    stamps ``file_date`` and upserts facts on their merge keys; dimensions are
    always fully reloaded.
    """
    raw = read_feed(spark, raw_root, name, file_date)
    df = CONFORM[name](raw, data_source, file_date, load_ts)
    path = os.path.join(processed_root, name)
    if name in FACTS:
        races = spark.read.parquet(os.path.join(processed_root, "races"))
        parts = partition_columns(buckets)
        if incremental:
            prepared = prepare_incremental(df, name, races, buckets)
            # unique by construction: deduplicated on the merge key
            return upsert(spark, prepared, path, MERGE_KEYS[name], parts, check_unique=False,
                          located_by=bucket_columns(buckets), moved_by=SEASON_KEY)
        # the join with the races has dealt the rows out: they are not shuffled again by season
        return overwrite_parquet(with_period(df, races, buckets=buckets), path, partition_by=parts,
                                 cluster_by=MERGE_KEYS[name], rebalance=False)
    if name == "races":
        return overwrite_parquet(df, path, partition_by=[PERIOD], rebalance=False)
    return overwrite_parquet(df, path)


INGEST_ORDER = ["circuits", "races", "constructors", "drivers", "results",
                "pit_stops", "lap_times", "qualifying"]


def ingest_all(spark: SparkSession, raw_root: str, processed_root: str,
               data_source: str = "", file_date: str | None = None,
               load_ts: Stamp = None, incremental: bool = False,
               buckets: int = 0) -> DataFrame:
    """Run the eight ingestions in order; returns (table, n) row counts read back."""
    for name in INGEST_ORDER:
        ingest(spark, raw_root, processed_root, name, data_source, file_date, load_ts,
               incremental, buckets)
    counts = None
    for name in INGEST_ORDER:
        c = (spark.read.parquet(os.path.join(processed_root, name))
             .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
        counts = c if counts is None else counts.unionByName(c)
    return counts
