"""Registered queries that go through storage: typed scans of raw files, raw
DDL tables, sinks, ingestion jobs, partition overwrite, upserts and the
incremental history. Each call writes into a fresh folder under the session's
shared ``spark.checkpoint.dir`` and returns a DataFrame read back from it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from paddock.functions.conform import partition_column_last
from paddock.operators.star import calculated_results, race_results
from paddock.plans import testbed as tb
from paddock.plans.incremental import run_history
from paddock.plans.ingest import (BUCKET, CONFORM, DEFAULT_BUCKETS, MERGE_KEYS, PERIOD, bucket_columns, conform_races,
                                  ingest, ingest_all, partition_columns, prepare_incremental,
                                  with_period)
from paddock.plans.presentation import (CALCULATED_KEYS, CALCULATED_SCHEMA,
                                        CALCULATED_UPDATE)
from paddock.plans.registry import QUERIES, query
from paddock.schemas import RAW_SCHEMAS
from paddock.session import work_dir
from paddock.sinks import writes as sink
from paddock.sources import feeds
from paddock.sources.ddl import create_raw_feed_table
from paddock.sources.testtables import (DATA_SOURCE, load_tables, raw_feed, stage_deliveries,
                                        write_deliveries, write_feed, write_raw_folder)


def _feed_file(spark, sf_dir, name):
    """Write one raw feed under a fresh folder; returns (root, path)."""
    root = work_dir(spark, "raw")
    path = feeds.dated_path(root, None, name)
    write_feed(raw_feed(spark, sf_dir, name), name, path)
    return root, path


def _db(spark, tag):
    name = f"paddock_{tag}_{uuid.uuid4().hex[:8]}"
    sink.create_database(spark, name, work_dir(spark, "db", name))
    return name


# --- scans ----------------------------------------------------------------------

@query
def scan_csv_header(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "races")
    return feeds.read_csv(spark, path, RAW_SCHEMAS["races"], header=True)


@query
def scan_csv_folder(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "lap_times")
    return feeds.read_csv(spark, path, RAW_SCHEMAS["lap_times"], header=False)


@query
def scan_json_lines(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "results")
    return feeds.read_json(spark, path, RAW_SCHEMAS["results"])


@query
def scan_json_ddl_schema(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "constructors")
    return feeds.read_json(spark, path, RAW_SCHEMAS["constructors"])


@query
def scan_json_nested(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "drivers")
    df = feeds.read_json(spark, path, RAW_SCHEMAS["drivers"])
    return df.select("driverId", "driverRef", "number", "code",
                     F.col("name.forename").alias("forename"),
                     F.col("name.surname").alias("surname"), "dob", "nationality", "url")


@query
def scan_json_multiline(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "pit_stops")
    return feeds.read_json(spark, path, RAW_SCHEMAS["pit_stops"], multiline=True)


@query
def scan_json_multiline_folder(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "qualifying")
    return feeds.read_json(spark, path, RAW_SCHEMAS["qualifying"], multiline=True)


@query
def scan_json_inferred(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "results")
    return feeds.read_json_inferred(spark, path)


def _marked_part(spark, sf_dir):
    """part with its size replaced by the ``\\N`` marker where p_size % 5 = 0."""
    p = load_tables(spark, sf_dir, ["part"])["part"]
    size = F.when(F.col("p_size") % 5 == 0, F.lit("\\N")).otherwise(F.col("p_size").cast("string"))
    return p.select("p_partkey", "p_name", size.alias("p_size"))


PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_size INT"


@query
def scan_permissive_nulls(spark, sf_dir):
    path = os.path.join(work_dir(spark, "raw"), "part.csv")
    _marked_part(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return feeds.read_csv(spark, path, PART_SCHEMA, header=True)


@query
def scan_permissive_nulls_json(spark, sf_dir):
    path = os.path.join(work_dir(spark, "raw"), "part.json")
    m = _marked_part(spark, sf_dir)
    # JSON lines with the size as a number, or the marker as a JSON string
    line = F.regexp_replace(F.to_json(F.struct("p_partkey", "p_name", "p_size")),
                            r'"p_size":"([0-9]+)"', r'"p_size":$1')
    m.select(line.alias("value")).write.mode("overwrite").text(path)
    return feeds.read_json(spark, path, PART_SCHEMA)


@query
def scan_parquet(spark, sf_dir):
    """The given Parquet table, as it lies."""
    return feeds.read_parquet(spark, os.path.join(sf_dir, "lineitem.parquet"))


@query
def scan_catalog_table(spark, sf_dir):
    """A catalog table over the given Parquet, without a copy."""
    db = _db(spark, "scan")
    sink.register_table(spark, f"{db}.orders", os.path.join(sf_dir, "orders.parquet"))
    return feeds.read_table(spark, f"{db}.orders")


@query
def scan_dated_batch(spark, sf_dir):
    root = work_dir(spark, "raw")
    write_deliveries(spark, sf_dir, root, tb.FILE_DATES, ["results"])
    return feeds.read_feed(spark, root, "results", tb.FILE_DATES[1])


@query
def race_timestamp(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "races")
    races = conform_races(feeds.read_feed(spark, os.path.dirname(path), "races"), DATA_SOURCE,
                          None, tb.LOAD_TS)
    return races.select("race_id", "race_timestamp")


# --- raw DDL tables -----------------------------------------------------------------

@query
def ddl_raw_csv_table(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "races")
    return create_raw_feed_table(spark, _db(spark, "raw"), "races", path)


@query
def ddl_raw_csv_folder_table(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "lap_times")
    return create_raw_feed_table(spark, _db(spark, "raw"), "lap_times", path)


@query
def ddl_raw_json_table(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "results")
    return create_raw_feed_table(spark, _db(spark, "raw"), "results", path)


@query
def ddl_raw_json_struct_table(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "drivers")
    df = create_raw_feed_table(spark, _db(spark, "raw"), "drivers", path)
    return df.select("driverId", "driverRef", "number", "code",
                     F.col("name.forename").alias("forename"),
                     F.col("name.surname").alias("surname"), "dob", "nationality", "url")


@query
def ddl_raw_json_multiline_table(spark, sf_dir):
    _, path = _feed_file(spark, sf_dir, "qualifying")
    return create_raw_feed_table(spark, _db(spark, "raw"), "qualifying", path)


# --- projections on conformed feeds --------------------------------------------------

def _conformed(spark, sf_dir, name):
    return CONFORM[name](raw_feed(spark, sf_dir, name), DATA_SOURCE, None, tb.LOAD_TS)


@query
def project_select(spark, sf_dir):
    return _conformed(spark, sf_dir, "races")


@query
def project_rename(spark, sf_dir):
    return _conformed(spark, sf_dir, "results")


@query
def project_drop(spark, sf_dir):
    return _conformed(spark, sf_dir, "constructors")


@query
def audit_columns(spark, sf_dir):
    return CONFORM["circuits"](raw_feed(spark, sf_dir, "circuits"), DATA_SOURCE,
                               tb.FILE_DATES[0], tb.LOAD_TS)


@query
def struct_flatten(spark, sf_dir):
    return _conformed(spark, sf_dir, "drivers")


@query
def project_partition_last(spark, sf_dir):
    return partition_column_last(_conformed(spark, sf_dir, "results"), "race_id")


# --- sinks -------------------------------------------------------------------------

def _results_with_year(spark, sf_dir):
    t = tb.processed(spark, sf_dir, ("races", "results"))
    return with_period(t["results"], t["races"])


@query
def sink_parquet_overwrite(spark, sf_dir):
    path = os.path.join(work_dir(spark, "lake"), "race_results")
    rr = race_results(*[tb.processed(spark, sf_dir)[n] for n in
                        ("results", "races", "circuits", "drivers", "constructors")],
                      load_ts=tb.LOAD_TS)
    sink.overwrite_parquet(rr.filter(F.col("position") == 1), path)
    sink.overwrite_parquet(rr, path)
    return spark.read.parquet(path)


@query
def sink_partitioned(spark, sf_dir):
    path = os.path.join(work_dir(spark, "lake"), "results")
    sink.overwrite_parquet(_results_with_year(spark, sf_dir), path, partition_by=[PERIOD],
                           cluster_by=["race_id"])
    return spark.read.parquet(path)


@query
def sink_save_as_table(spark, sf_dir):
    db = _db(spark, "sink")
    sink.save_as_table(_results_with_year(spark, sf_dir), f"{db}.results", partition_by=[PERIOD])
    return spark.table(f"{db}.results")


def _calc(spark, sf_dir):
    t = tb.processed(spark, sf_dir, ("races", "constructors", "drivers", "results"))
    return calculated_results(t["results"], t["races"], t["drivers"], t["constructors"],
                              top_n=tb.TOP_N)


@query
def sink_ctas(spark, sf_dir):
    db = _db(spark, "ctas")
    sink.ctas(spark, f"{db}.calculated_race_results", _calc(spark, sf_dir))
    return spark.table(f"{db}.calculated_race_results")


@query
def ddl_create_if_missing(spark, sf_dir):
    db = _db(spark, "ddl")
    table = f"{db}.calculated_race_results"
    sink.create_table_if_missing(spark, table, CALCULATED_SCHEMA, partition_by=[PERIOD])
    t = tb.processed(spark, sf_dir, ("races", "constructors", "drivers", "results"))
    src = calculated_results(t["results"], t["races"], t["drivers"], t["constructors"],
                             top_n=tb.TOP_N, incremental=True)
    src = src.withColumns({"created_date": F.lit(tb.LOAD_TS).cast("timestamp_ntz"),
                           "updated_date": F.lit(None).cast("timestamp_ntz")})
    src.select(*spark.table(table).columns).write.insertInto(table)
    sink.create_table_if_missing(spark, table, CALCULATED_SCHEMA, partition_by=[PERIOD])
    return spark.table(table)


@query
def partition_overwrite(spark, sf_dir):
    path = os.path.join(work_dir(spark, "lake"), "results")
    base = _results_with_year(spark, sf_dir)
    sink.overwrite_parquet(base, path, partition_by=[PERIOD], cluster_by=["race_id"])
    changed = (spark.read.parquet(path).filter(F.col(PERIOD) == 2000)
               .withColumn("points", (F.col("points") + 10).cast("float")))
    sink.overwrite_partitions(changed, path, PERIOD, cluster_by=["race_id"])
    return spark.read.parquet(path)


@query
def partition_overwrite_table(spark, sf_dir):
    db = _db(spark, "part")
    table = f"{db}.results"
    sink.overwrite_table_partitions(spark, _results_with_year(spark, sf_dir), table, PERIOD)
    changed = (spark.table(table).filter(F.col(PERIOD) == 2000)
               .withColumn("points", (F.col("points") + 10).cast("float")))
    sink.overwrite_table_partitions(spark, changed, table, PERIOD)
    return spark.table(table)


@query
def partition_drop_reload(spark, sf_dir):
    db = _db(spark, "part")
    table = f"{db}.results"
    sink.save_as_table(_results_with_year(spark, sf_dir), table, partition_by=[PERIOD])
    changed = (spark.table(table).filter(F.col(PERIOD) == 2000)
               .withColumn("points", (F.col("points") + 10).cast("float"))).checkpoint()
    sink.drop_partitions_and_append(spark, changed, table, PERIOD)
    return spark.table(table)


# --- upserts -----------------------------------------------------------------------

LATE_RACES = "race_id % 3 = 0"      # races that the late-dimension query learns of later
MOVED_RACES = "race_id % 2 = 0"     # races that the moved-season queries date a year later
NAMELESS = "driver_id % 10 = 0"     # results whose key the NULL-key query leaves empty


def _moved(races):
    return races.withColumn(PERIOD, F.when(F.expr(MOVED_RACES), F.col(PERIOD) + 1)
                            .otherwise(F.col(PERIOD)).cast("int"))


def _batch_source(spark, sf_dir, file_date, races, buckets=0, delivered=None):
    raw = raw_feed(spark, sf_dir, "results", file_date, delivered=delivered)
    df = CONFORM["results"](raw, DATA_SOURCE, file_date, tb.batch_stamp(file_date))
    return prepare_incremental(df, "results", races, buckets)


def _upsert_batches(spark, sf_dir, dates, buckets=0):
    path = os.path.join(work_dir(spark, "lake"), "results")
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    parts = partition_columns(buckets)
    delivered, _ = stage_deliveries(spark, sf_dir, dates)
    for d in dates:
        # the batch source is deduplicated on the merge key, so no extra check pass
        sink.upsert(spark, _batch_source(spark, sf_dir, d, races, buckets, delivered), path,
                    MERGE_KEYS["results"], parts, check_unique=False,
                    located_by=bucket_columns(buckets))
    return spark.read.parquet(path)


@query
def upsert_first_load(spark, sf_dir):
    return _upsert_batches(spark, sf_dir, tb.FILE_DATES[:1])


@query
def upsert_merge(spark, sf_dir):
    return _upsert_batches(spark, sf_dir, tb.FILE_DATES)


@query
def upsert_idempotent(spark, sf_dir):
    return _upsert_batches(spark, sf_dir, tb.FILE_DATES + tb.FILE_DATES[-1:])


@query
def upsert_merge_bucketed(spark, sf_dir):
    """The three-batch merge with (season, race bucket) partitions."""
    return _upsert_batches(spark, sf_dir, tb.FILE_DATES, buckets=tb.BUCKETS)


@query
def upsert_table(spark, sf_dir):
    db = _db(spark, "merge")
    table = f"{db}.results"
    location = os.path.join(work_dir(spark, "lake"), "results")
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    delivered, _ = stage_deliveries(spark, sf_dir, tb.FILE_DATES)
    for d in tb.FILE_DATES:
        sink.upsert_table(spark, _batch_source(spark, sf_dir, d, races, delivered=delivered), table, location,
                          MERGE_KEYS["results"], PERIOD)
    return spark.table(table)


def _merge_twice(spark, sf_dir, first_races, second_races, change=lambda df: df):
    """The first delivery merged twice, with other races (or types) the second time."""
    path = os.path.join(work_dir(spark, "lake"), "results")
    d = tb.FILE_DATES[0]
    delivered, _ = stage_deliveries(spark, sf_dir, [d])
    for races, then in ((first_races, lambda df: df), (second_races, change)):
        sink.upsert(spark, then(_batch_source(spark, sf_dir, d, races, delivered=delivered)), path,
                    MERGE_KEYS["results"], PERIOD)
    return spark.read.parquet(path)


@query
def upsert_late_dimension(spark, sf_dir):
    """Facts whose race is not loaded yet: delivered again with it, they move to their season."""
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    return _merge_twice(spark, sf_dir, races.filter(f"NOT ({LATE_RACES})"), races)


@query
def upsert_moved_season(spark, sf_dir):
    """Races dated a year later when their results come again: rows move, none doubles."""
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    return _merge_twice(spark, sf_dir, races, _moved(races))


@query
def upsert_widened_type(spark, sf_dir):
    """A source with wider types than the target is cast to the target's."""
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    return _merge_twice(spark, sf_dir, races, races, lambda df: df.withColumns(
        {"laps": F.col("laps").cast("bigint"), "points": F.col("points").cast("double"),
         PERIOD: F.col(PERIOD).cast("bigint")}))


@query
def upsert_null_keys(spark, sf_dir):
    """A key with a NULL part matches nothing: such rows are inserted at every delivery."""
    path = os.path.join(work_dir(spark, "lake"), "named")
    races = tb.processed(spark, sf_dir, ("races",))["races"]
    source = _batch_source(spark, sf_dir, tb.FILE_DATES[0], races).select(
        F.when(~F.expr(NAMELESS), F.col("driver_id")).alias("driver_id"), "race_id", "points",
        "position", PERIOD)
    for _ in range(2):
        sink.upsert(spark, source, path, ["driver_id", "race_id"], PERIOD)
    return spark.read.parquet(path)


@query
def upsert_selective(spark, sf_dir):
    path = os.path.join(work_dir(spark, "lake"), "calculated_race_results")
    t = tb.processed(spark, sf_dir, ("races", "constructors", "drivers"))
    for d in tb.FILE_DATES:
        results = _batch_source(spark, sf_dir, d, t["races"])
        src = calculated_results(results, t["races"], t["drivers"], t["constructors"],
                                 top_n=tb.TOP_N, incremental=True, file_date=d)
        sink.selective_upsert(spark, src, path, CALCULATED_KEYS, CALCULATED_UPDATE,
                              PERIOD, CALCULATED_SCHEMA, stamp=tb.batch_stamp(d))
    return spark.read.parquet(path)


@query
def upsert_selective_moved_season(spark, sf_dir):
    """Scored results delivered again with another season: the season is no updated column,
    so matched rows stay in theirs and none doubles."""
    path = os.path.join(work_dir(spark, "lake"), "calculated_race_results")
    t = tb.processed(spark, sf_dir, ("races", "constructors", "drivers"))
    d = tb.FILE_DATES[0]
    for races, stamp in ((t["races"], tb.FILE_DATES[0]), (_moved(t["races"]), tb.FILE_DATES[1])):
        src = calculated_results(_batch_source(spark, sf_dir, d, t["races"]), races, t["drivers"],
                                 t["constructors"], top_n=tb.TOP_N, incremental=True, file_date=d)
        sink.selective_upsert(spark, src, path, CALCULATED_KEYS, CALCULATED_UPDATE, PERIOD,
                              CALCULATED_SCHEMA, stamp=tb.batch_stamp(stamp))
    return spark.read.parquet(path)


# --- ingestion jobs -------------------------------------------------------------------

def _ingest_one(spark, sf_dir, name):
    raw_root = work_dir(spark, "raw")
    processed = work_dir(spark, "processed")
    names = [name] if name not in MERGE_KEYS else ["races", name]
    write_raw_folder(spark, sf_dir, raw_root, None, names)
    for n in names:
        ingest(spark, raw_root, processed, n, DATA_SOURCE, None, tb.LOAD_TS)
    return spark.read.parquet(os.path.join(processed, name))


def _make_ingest(name):
    def fn(spark, sf_dir):
        return _ingest_one(spark, sf_dir, name)
    fn.__name__ = f"ingest_{name}"
    return fn


for _name in ("circuits", "races", "constructors", "drivers", "results", "pit_stops",
              "lap_times", "qualifying"):
    QUERIES[f"ingest_{_name}"] = _make_ingest(_name)


@query
def ingest_results_incremental(spark, sf_dir):
    raw_root = work_dir(spark, "raw")
    write_deliveries(spark, sf_dir, raw_root, tb.FILE_DATES, ["races", "results"])
    layers = run_history(spark, raw_root, work_dir(spark, "lake"), tb.FILE_DATES, DATA_SOURCE,
                         [tb.batch_stamp(d) for d in tb.FILE_DATES], tb.TOP_N,
                         feeds=["races", "results"], presentation=())
    return spark.read.parquet(os.path.join(layers["processed"], "results")).drop(BUCKET)


@query
def run_ingestion_all(spark, sf_dir):
    raw_root = work_dir(spark, "raw")
    write_raw_folder(spark, sf_dir, raw_root)
    return ingest_all(spark, raw_root, work_dir(spark, "processed"), DATA_SOURCE, None,
                      tb.LOAD_TS)


@query
def run_ingestion_all_incremental(spark, sf_dir):
    """All eight ingestions of one delivery, facts merged into empty tables."""
    raw_root, d = work_dir(spark, "raw"), tb.FILE_DATES[0]
    write_deliveries(spark, sf_dir, raw_root, [d])
    return ingest_all(spark, raw_root, work_dir(spark, "processed"), DATA_SOURCE, d,
                      tb.batch_stamp(d), incremental=True)


@query
def reset_layers(spark, sf_dir):
    """Layers with old tables, reset and loaded afresh: only the new load is there."""
    dbs = {_db(spark, "processed"): None, _db(spark, "presentation"): None}
    frames = tb.processed(spark, sf_dir, ("circuits", "constructors"))
    for db in dbs:
        dbs[db] = work_dir(spark, "db", db)
        sink.save_as_table(frames["constructors"], f"{db}.constructors")
    sink.reset_databases(spark, dbs)
    first = next(iter(dbs))
    sink.save_as_table(frames["circuits"], f"{first}.circuits")
    left = sum(len(spark.catalog.listTables(db)) for db in dbs)
    return spark.table(f"{first}.circuits").withColumn("n_tables", F.lit(left).cast("long"))


@query
def affected_years_pruned(spark, sf_dir):
    """All rows of the seasons a delivery touched, from a table partitioned by season: the
    semi join prunes its folders at run time."""
    from paddock.operators.standings import affected_periods, rows_of_periods
    from paddock.plans.registry import _batch_race_results
    path = os.path.join(work_dir(spark, "lake"), "race_results")
    sink.overwrite_parquet(_batch_race_results(spark, sf_dir), path, partition_by=[PERIOD])
    rr = spark.read.parquet(path)
    return rows_of_periods(rr, affected_periods(rr, tb.FILE_DATES[1]))


# --- incremental history ---------------------------------------------------------------

def _history_feeds(steps):
    feeds_needed = ["circuits", "races", "constructors", "drivers", "results"]
    if steps == ("calculated_race_results",):
        feeds_needed.remove("circuits")
    return feeds_needed


def _presentation(name, buckets=None):
    """The whole three-batch history, with the presentation steps ``name`` needs.

    ``prepare`` writes the delivery folders (test-data preparation); ``run``
    is the incremental job itself (the bench times it separately).
    """
    steps = (name,)

    def prepare(spark, sf_dir):
        raw_root = work_dir(spark, "raw")
        write_deliveries(spark, sf_dir, raw_root, tb.FILE_DATES, _history_feeds(steps))
        return raw_root

    def run(spark, raw_root):
        layers = run_history(spark, raw_root, work_dir(spark, "lake"), tb.FILE_DATES,
                             DATA_SOURCE, [tb.batch_stamp(d) for d in tb.FILE_DATES], tb.TOP_N,
                             feeds=_history_feeds(steps), presentation=steps,
                             buckets=DEFAULT_BUCKETS if buckets is None else buckets)
        out = spark.read.parquet(os.path.join(layers["presentation"], name))
        return out.drop(BUCKET) if buckets is None else out

    def fn(spark, sf_dir):
        return run(spark, prepare(spark, sf_dir))
    fn.prepare, fn.run = prepare, run
    return fn


QUERIES["race_results_incremental"] = _presentation("race_results")
QUERIES["driver_standings_incremental"] = _presentation("driver_standings")
QUERIES["constructor_standings_incremental"] = _presentation("constructor_standings")
QUERIES["calculated_results_incremental"] = _presentation("calculated_race_results")
QUERIES["race_results_incremental_bucketed"] = _presentation("race_results", tb.BUCKETS)
QUERIES["calculated_results_incremental_bucketed"] = _presentation("calculated_race_results",
                                                                   tb.BUCKETS)


# --- streaming form of the incremental load ----------------------------------------------

def _stream_prepare(spark, sf_dir):
    raw_root = work_dir(spark, "raw")
    write_deliveries(spark, sf_dir, raw_root, tb.FILE_DATES, ["races", "results"])
    return raw_root


def _stream_run(spark, raw_root):
    from paddock.streaming.deliveries import ingest_deliveries
    lake = work_dir(spark, "lake")
    processed = os.path.join(lake, "processed")
    ingest(spark, raw_root, processed, "races", DATA_SOURCE, tb.FILE_DATES[-1],
           tb.batch_stamp(tb.FILE_DATES[-1]), incremental=True)
    ingest_deliveries(spark, raw_root, processed, "results", os.path.join(lake, "_checkpoint"),
                      DATA_SOURCE, tb.batch_stamp)
    return spark.read.parquet(os.path.join(processed, "results")).drop(BUCKET)


@query
def stream_results_incremental(spark, sf_dir):
    return _stream_run(spark, _stream_prepare(spark, sf_dir))


stream_results_incremental.prepare = _stream_prepare
stream_results_incremental.run = _stream_run


# --- full load through storage ------------------------------------------------------------

def _full_load(name):
    def prepare(spark, sf_dir):
        raw_root = work_dir(spark, "raw")
        write_raw_folder(spark, sf_dir, raw_root)
        return raw_root

    def run(spark, raw_root):
        from paddock.plans.presentation import run_full_load
        layers = run_full_load(spark, raw_root, work_dir(spark, "lake"), DATA_SOURCE,
                               tb.LOAD_TS, tb.TOP_N)
        return spark.read.parquet(os.path.join(layers["presentation"], name))

    def fn(spark, sf_dir):
        return run(spark, prepare(spark, sf_dir))
    fn.prepare, fn.run = prepare, run
    return fn


for _name in ("race_results", "driver_standings", "constructor_standings",
              "calculated_race_results"):
    QUERIES[f"full_load_{_name}"] = _full_load(_name)


# --- incremental ingestion of the timing facts ----------------------------------------------

def _incremental_fact(name):
    def prepare(spark, sf_dir):
        raw_root = work_dir(spark, "raw")
        write_deliveries(spark, sf_dir, raw_root, tb.FILE_DATES, ["races", name])
        return raw_root

    def run(spark, raw_root):
        layers = run_history(spark, raw_root, work_dir(spark, "lake"), tb.FILE_DATES,
                             DATA_SOURCE, [tb.batch_stamp(d) for d in tb.FILE_DATES], tb.TOP_N,
                             feeds=["races", name], presentation=())
        return spark.read.parquet(os.path.join(layers["processed"], name)).drop(BUCKET)

    def fn(spark, sf_dir):
        return run(spark, prepare(spark, sf_dir))
    fn.prepare, fn.run = prepare, run
    return fn


for _name in ("pit_stops", "lap_times", "qualifying"):
    QUERIES[f"ingest_{_name}_incremental"] = _incremental_fact(_name)


# --- analyses on the stored scored-results table (as the source runs them) ------------------

def _stored_analysis(kind):
    from paddock.operators import dominance as dom

    def prepare(spark, sf_dir):
        raw_root = work_dir(spark, "raw")
        write_raw_folder(spark, sf_dir, raw_root)
        return raw_root

    def run(spark, raw_root):
        from paddock.plans.presentation import run_full_load
        layers = run_full_load(spark, raw_root, work_dir(spark, "lake"), DATA_SOURCE,
                               tb.LOAD_TS, tb.TOP_N)
        scored = spark.read.parquet(os.path.join(layers["presentation"],
                                                 "calculated_race_results"))
        top = dom.ranked_dominance(scored, "driver_name", tb.DRIVER_MIN, tb.TOP_DRIVERS,
                                   "driver_rank")
        if kind == "top":
            return top
        return dom.yearly_profile(scored, top, "driver_name", "join")

    def fn(spark, sf_dir):
        return run(spark, prepare(spark, sf_dir))
    fn.prepare, fn.run = prepare, run
    return fn


QUERIES["full_load_top10_drivers"] = _stored_analysis("top")
QUERIES["full_load_dominant_drivers_by_year"] = _stored_analysis("by_year")
