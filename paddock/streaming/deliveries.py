"""Incremental ingestion of delivery folders as a Structured Streaming job.

A file stream over ``raw_root/*/<feed file>`` picks up every new delivery
folder once; ``file_date`` is taken from the folder name of each file. Each
micro-batch is merged with ``foreachBatch``: its delivery dates (a handful of
values) are applied in date order, each through the same conform ->
deterministic dedupe -> keyed upsert steps as the batch job. The streaming
checkpoint (under the shared checkpoint location) records which files were
merged, so a restarted or failed run resumes without re-merging or skipping a
delivery. ``availableNow`` processes what has arrived and stops.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.plans.ingest import (CONFORM, DEFAULT_BUCKETS, FACTS, MERGE_KEYS, SEASON_KEY,
                                  bucket_columns, partition_columns, prepare_incremental)
from paddock.schemas import RAW_SCHEMAS
from paddock.sinks.writes import read_or_empty, upsert
from paddock.sources.feeds import FEED_FILES, FEED_FORMATS

Stamp = str | _dt.datetime | None
DATE_IN_PATH = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/"


FILES_PER_TRIGGER = 200   # bounds a micro-batch, and with it the delivery dates in it


def delivery_stream(spark: SparkSession, raw_root: str, name: str,
                    files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Streaming rows of one feed across delivery folders, with ``file_date``; a backlog
    is read in micro-batches of at most ``files_per_trigger`` files, oldest first."""
    fmt = FEED_FORMATS[name]
    reader = (spark.readStream.schema(RAW_SCHEMAS[name])
              .option("maxFilesPerTrigger", files_per_trigger))
    pattern = os.path.join(raw_root, "*", FEED_FILES[name])
    if fmt.startswith("csv"):
        df = reader.option("header", fmt == "csv_header").csv(pattern)
    else:
        df = reader.option("multiLine", fmt == "json_multiline").json(pattern)
    return df.withColumn("file_date",
                         F.regexp_extract(F.col("_metadata.file_path"), DATE_IN_PATH, 1))


def ingest_deliveries(spark: SparkSession, raw_root: str, processed_root: str, name: str,
                      checkpoint: str, data_source: str = "",
                      stamp_for: Callable[[str], Stamp] | None = None,
                      files_per_trigger: int = FILES_PER_TRIGGER,
                      buckets: int = DEFAULT_BUCKETS) -> None:
    """Merge every not-yet-seen delivery of fact ``name`` into the processed table."""
    if name not in FACTS:
        raise ValueError(f"{name} is not an incrementally merged fact")
    target = os.path.join(processed_root, name)
    races_path = os.path.join(processed_root, "races")

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # at most one a file
            dates = [r[0] for r in batch.select("file_date").distinct().orderBy("file_date").collect()]
            races = spark.read.parquet(races_path)
            for d in dates:
                raw = batch.filter(F.col("file_date") == d).drop("file_date")
                df = CONFORM[name](raw, data_source, d, stamp_for(d) if stamp_for else None)
                parts = partition_columns(buckets)
                source = prepare_incremental(df, name, races, buckets)
                known = read_or_empty(spark, target)
                if known is not None:   # a late arrival never replaces a newer delivery's row
                    newer = known.filter(F.col("file_date") > d).select(*MERGE_KEYS[name])
                    source = source.join(newer, MERGE_KEYS[name], "left_anti")
                upsert(spark, source, target, MERGE_KEYS[name], parts, check_unique=False,
                       located_by=bucket_columns(buckets), moved_by=SEASON_KEY)
        finally:
            batch.unpersist()

    q = (delivery_stream(spark, raw_root, name, files_per_trigger).writeStream
         .foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
