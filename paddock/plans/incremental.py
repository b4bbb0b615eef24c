"""The incremental history: delivery folders processed in date order.

Each batch: dimensions fully reloaded, facts of that folder merged, then the
presentation tables merged from the batch (race results), from the seasons it
touched (standings) and from its top finishes (scored results). Every step
reads its inputs back from storage, so lineage never spans batches.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from paddock.plans.ingest import (DEFAULT_BUCKETS, INGEST_ORDER, ingest, partition_columns,
                                  with_period)
from paddock.plans.presentation import (calculated_results_incremental,
                                        race_results_incremental, register_layers,
                                        standings_incremental)
from paddock.sources.feeds import read_feed

Stamp = str | _dt.datetime | None
PRESENTATION_STEPS = ("race_results", "driver_standings", "constructor_standings",
                      "calculated_race_results")


def run_batch(spark: SparkSession, raw_root: str, processed_root: str,
              presentation_root: str, file_date: str, data_source: str = "",
              stamp: Stamp = None, top_n: int = 10,
              feeds: Sequence[str] = INGEST_ORDER,
              presentation: Sequence[str] = PRESENTATION_STEPS, buckets: int = DEFAULT_BUCKETS,
              standings_mode: str = "merge") -> None:
    for name in feeds:
        ingest(spark, raw_root, processed_root, name, data_source, file_date, stamp,
               incremental=True, buckets=buckets)
    steps = set(presentation)
    if not steps:
        return
    parts = delivery_partitions(spark, raw_root, processed_root, file_date, "results", buckets)
    touched = list(parts)   # and the partitions that corrected rows left
    if steps & {"race_results", "driver_standings", "constructor_standings"}:
        race_results_incremental(spark, processed_root, presentation_root, file_date, stamp,
                                 buckets, parts, touched)
    seasons = sorted({t[0] for t in touched}, key=str)
    if "driver_standings" in steps:
        standings_incremental(spark, presentation_root, file_date, "driver", seasons,
                              standings_mode)
    if "constructor_standings" in steps:
        standings_incremental(spark, presentation_root, file_date, "constructor", seasons,
                              standings_mode)
    if "calculated_race_results" in steps:
        calculated_results_incremental(spark, processed_root, presentation_root, file_date,
                                       stamp, top_n, buckets, parts)


def delivery_partitions(spark: SparkSession, raw_root: str, processed_root: str,
                        file_date: str, name: str = "results", buckets: int = 0) -> list:
    """The (season[, race bucket]) partitions one delivery of a fact writes to.

    Read from the delivery itself (small by nature: about one race) and the
    races table, so the later steps of the batch can read only those folders
    of tables partitioned by season instead of scanning every partition for
    ``file_date``. One value tuple per partition folder.
    """
    races_ids = read_feed(spark, raw_root, name, file_date).select(
        F.col("raceId").alias("race_id")).distinct()
    races = spark.read.parquet(os.path.join(processed_root, "races"))
    parts = partition_columns(buckets)
    rows = with_period(races_ids, races, buckets=buckets).select(*parts).distinct().collect()
    return [tuple(r[c] for c in parts) for r in rows]


def run_history(spark: SparkSession, raw_root: str, root: str,
                file_dates: Sequence[str], data_source: str = "",
                stamps: Sequence[Stamp] | None = None, top_n: int = 10,
                feeds: Sequence[str] = INGEST_ORDER,
                presentation: Sequence[str] = PRESENTATION_STEPS,
                processed_db: str | None = None, presentation_db: str | None = None,
                buckets: int = DEFAULT_BUCKETS, standings_mode: str = "merge") -> dict:
    """Process ``file_dates`` in order; returns the layer folders. With database
    names, the folders are registered (and refreshed) as tables after each batch."""
    processed = os.path.join(root, "processed")
    pres = os.path.join(root, "presentation")
    layers = {"processed": processed, "presentation": pres}
    for i, d in enumerate(file_dates):
        run_batch(spark, raw_root, processed, pres, d, data_source,
                  stamps[i] if stamps else None, top_n, feeds, presentation, buckets,
                  standings_mode)
        if processed_db or presentation_db:
            register_layers(spark, layers, processed_db, presentation_db, incremental=True)
    return layers
