"""Presentation-layer jobs: race results, standings and scored results, in
full-load form (overwrite) and incremental form (one delivery batch merged
into the existing tables)."""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.operators.standings import (affected_periods, constructor_standings,
                                         driver_standings, rows_of_periods)
from paddock.operators.star import calculated_results, race_results
from paddock.plans.ingest import (BUCKET, SEASON_KEY, bucket_columns, partition_columns,
                                  with_bucket)
from paddock.sinks.writes import (kept, overwrite_parquet, overwrite_partitions, partition_filter,
                                  selective_upsert, upsert)

Stamp = str | _dt.datetime | None
PERIOD = "race_year"
DIMENSIONS = ("circuits", "races", "constructors", "drivers")

# Merge keys of the presentation tables.
RACE_RESULTS_KEYS = ["driver_name", "race_id"]
DRIVER_STANDINGS_KEYS = ["driver_name", "race_year"]
CONSTRUCTOR_STANDINGS_KEYS = ["team", "race_year"]
CALCULATED_KEYS = ["driver_id", "race_id"]
CALCULATED_UPDATE = ["position", "points", "calculated_points"]
CALCULATED_SCHEMA = ("race_year INT, team_name STRING, driver_id BIGINT, driver_name STRING, "
                     "race_id BIGINT, position INT, points INT, calculated_points INT, "
                     "created_date TIMESTAMP_NTZ, updated_date TIMESTAMP_NTZ")


def processed_tables(spark: SparkSession, processed_root: str,
                     names=DIMENSIONS + ("results",)) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(os.path.join(processed_root, n)) for n in names}


def star_inputs(t: dict[str, DataFrame]) -> tuple:
    return t["results"], t["races"], t["circuits"], t["drivers"], t["constructors"]


# --- full load ------------------------------------------------------------

def build_race_results(spark: SparkSession, processed_root: str, presentation_root: str,
                       load_ts: Stamp = None) -> str:
    t = processed_tables(spark, processed_root)
    df = race_results(*star_inputs(t), load_ts=load_ts, stored=True)
    return overwrite_parquet(df, os.path.join(presentation_root, "race_results"),
                             partition_by=[PERIOD], rebalance=False)


def build_standings(spark: SparkSession, presentation_root: str) -> tuple[str, str]:
    rr = spark.read.parquet(os.path.join(presentation_root, "race_results"))
    d = os.path.join(presentation_root, "driver_standings")
    c = os.path.join(presentation_root, "constructor_standings")
    with kept(spark, d) as keep:
        overwrite_parquet(driver_standings(rr, with_team=True, keep=keep), d)
    with kept(spark, c) as keep:
        overwrite_parquet(constructor_standings(rr, keep=keep), c)
    return d, c


def build_calculated_results(spark: SparkSession, processed_root: str, presentation_root: str,
                             top_n: int = 10) -> str:
    t = processed_tables(spark, processed_root, ("races", "constructors", "drivers", "results"))
    df = calculated_results(t["results"], t["races"], t["drivers"], t["constructors"], top_n,
                            stored=True)
    return overwrite_parquet(df, os.path.join(presentation_root, "calculated_race_results"))


# --- incremental ----------------------------------------------------------

def batch_results(results: DataFrame, file_date: str, buckets: int = 0,
                  partitions: list | None = None) -> DataFrame:
    """Rows of one delivery in the processed results.

    ``partitions`` (the delivery's season[/bucket] values, see
    ``plans.incremental.delivery_partitions``) becomes a partition filter, so
    only the folders the delivery wrote are read; ``file_date`` then selects
    its rows inside them. Without it every partition is scanned.
    """
    if partitions is not None:
        cond = partition_filter(partition_columns(buckets), partitions)
        if cond is not None:
            results = results.filter(cond)
    return results.filter(F.col("file_date") == F.lit(file_date))


def race_results_batch(spark: SparkSession, processed_root: str, file_date: str,
                       load_ts: Stamp = None, buckets: int = 0,
                       partitions: list | None = None) -> DataFrame:
    """The race results of one delivery (lazy), ready to merge."""
    t = processed_tables(spark, processed_root)
    batch = batch_results(t["results"], file_date, buckets, partitions)
    return with_bucket(race_results(batch, t["races"], t["circuits"], t["drivers"],
                                    t["constructors"], load_ts=load_ts, incremental=True,
                                    stored=True),
                       buckets)


def race_results_incremental(spark: SparkSession, processed_root: str,
                             presentation_root: str, file_date: str,
                             load_ts: Stamp = None, buckets: int = 0,
                             partitions: list | None = None,
                             touched: list | None = None) -> str:
    """Merge the race results of one batch (update all on driver_name, race_id).
    ``touched`` is filled with the partitions written, those that rows left included."""
    df = race_results_batch(spark, processed_root, file_date, load_ts, buckets, partitions)
    parts = partition_columns(buckets)
    return upsert(spark, df, os.path.join(presentation_root, "race_results"),
                  RACE_RESULTS_KEYS, parts, located_by=bucket_columns(buckets), touched=touched,
                  moved_by=SEASON_KEY)


def standings_incremental(spark: SparkSession, presentation_root: str, file_date: str,
                          which: str = "driver", seasons: list | None = None,
                          mode: str = "merge") -> str:
    """Recompute the standings of every season the batch touched, from all race
    results of those seasons, and merge them.

    ``seasons`` (from the delivery) is applied as a partition filter; without
    it the touched seasons are found with a semi join on the batch's rows
    (dynamic partition pruning on the season folders).

    ``mode="merge"`` upserts on the standings key (as the source does);
    ``mode="replace"`` overwrites the recomputed seasons' folders, which is
    exact because every season is recomputed whole, and cheaper (no staging,
    key check or anti join).
    """
    rr = spark.read.parquet(os.path.join(presentation_root, "race_results"))
    if seasons is not None:
        seasons = rr.filter(partition_filter(PERIOD, [(v,) for v in seasons]))
    else:
        seasons = rows_of_periods(rr, affected_periods(rr, file_date))
    path = os.path.join(presentation_root, f"{which}_standings")
    with kept(spark, path) as keep:
        if which == "driver":
            df, keys = driver_standings(seasons, with_team=False, keep=keep), DRIVER_STANDINGS_KEYS
        else:
            df, keys = constructor_standings(seasons, keep=keep), CONSTRUCTOR_STANDINGS_KEYS
        if mode == "replace":
            return overwrite_partitions(df, path, PERIOD, cluster_by=keys)
        return upsert(spark, df, path, keys, PERIOD)


def calculated_results_incremental(spark: SparkSession, processed_root: str,
                                   presentation_root: str, file_date: str,
                                   stamp: Stamp = None, top_n: int = 10,
                                   buckets: int = 0, partitions: list | None = None) -> str:
    """Selective merge of one batch's scored results on (driver_id, race_id)."""
    t = processed_tables(spark, processed_root, ("races", "constructors", "drivers", "results"))
    batch = batch_results(t["results"], file_date, buckets, partitions)
    src = with_bucket(calculated_results(batch, t["races"], t["drivers"],
                                         t["constructors"], top_n, incremental=True,
                                         file_date=file_date, stored=True), buckets)
    parts = partition_columns(buckets)
    schema = CALCULATED_SCHEMA + (f", {BUCKET} INT" if buckets else "")
    return selective_upsert(spark, src, os.path.join(presentation_root,
                                                     "calculated_race_results"),
                            CALCULATED_KEYS, CALCULATED_UPDATE, parts, schema, stamp=stamp,
                            located_by=bucket_columns(buckets), moved_by=SEASON_KEY)


PRESENTATION_TABLES = ("race_results", "driver_standings", "constructor_standings",
                       "calculated_race_results")
PARTITIONED = ("races", "results", "pit_stops", "lap_times", "qualifying", "race_results",
               "driver_standings", "constructor_standings", "calculated_race_results")


def register_layers(spark: SparkSession, layers: dict, processed_db: str | None,
                    presentation_db: str | None, incremental: bool = False) -> None:
    """Register the written folders as catalog tables (one copy of the data)."""
    from paddock.plans.ingest import INGEST_ORDER
    from paddock.sinks.writes import register_layer
    partitioned = PARTITIONED if incremental else \
        tuple(n for n in PARTITIONED if n not in ("driver_standings", "constructor_standings",
                                                  "calculated_race_results"))
    if processed_db:
        present = [n for n in INGEST_ORDER if _exists(spark, layers["processed"], n)]
        register_layer(spark, processed_db, layers["processed"], present, partitioned)
    if presentation_db:
        present = [n for n in PRESENTATION_TABLES if _exists(spark, layers["presentation"], n)]
        register_layer(spark, presentation_db, layers["presentation"], present, partitioned)


def _exists(spark: SparkSession, root: str, name: str) -> bool:
    from paddock.sinks.writes import read_or_empty
    return read_or_empty(spark, os.path.join(root, name)) is not None


def run_full_load(spark: SparkSession, raw_root: str, root: str, data_source: str = "",
                  load_ts: Stamp = None, top_n: int = 10, processed_db: str | None = None,
                  presentation_db: str | None = None) -> dict:
    """Full load: ingest all eight feeds, then race results, both standings and
    the scored results, each written once and read back by the next step.
    With database names, every folder is also registered as a catalog table."""
    from paddock.plans.ingest import ingest_all
    processed = os.path.join(root, "processed")
    pres = os.path.join(root, "presentation")
    ingest_all(spark, raw_root, processed, data_source, None, load_ts)
    build_race_results(spark, processed, pres, load_ts)
    build_standings(spark, pres)
    build_calculated_results(spark, processed, pres, top_n)
    layers = {"processed": processed, "presentation": pres}
    register_layers(spark, layers, processed_db, presentation_db)
    return layers
