"""The eight raw feeds derived from the TPC-H-like test tables.

Role mapping (test table -> feed):

* circuits      <- nation (+ region for the country)
* races         <- orders (+ customer for the circuit); year = year(o_orderdate);
                   every 7th order has no start time (``\\N``)
* constructors  <- supplier (+ nation for the nationality)
* drivers       <- part; name = {forename, surname}; the surname carries
                   ``#<partkey>`` so full names are unique
* results       <- lineitem; result_id = orderkey * 1e6 + partkey,
                   position = linenumber, points = quantity
* pit_stops, lap_times, qualifying <- lineitem columns

Each feed is one SQL template over ``{table}`` placeholders written in the
subset of SQL that Spark and DuckDB share, so the Spark side (via
``spark.sql(template, table=DataFrame)``) and the DuckDB oracle derive the
same rows. Templates project and filter only; every row of the source tables
is kept.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import freed_shuffles, work_dir
from paddock.sinks.writes import CODEC, PAGES, _delete_folders
from paddock.sources.feeds import FEED_FILES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Delivery folders of the incremental history and the order-date
# ranges they carry (half-open), plus the late correction re-delivered in the
# last batch (results of the second batch whose driver_id % 10 = 0, one more point).
BATCHES = [
    ("2021-03-21", None, "2000-07-01"),
    ("2021-03-28", "2000-07-01", "2001-03-01"),
    ("2021-04-18", "2001-03-01", None),
]
DATA_SOURCE = "Ergast API"

_BACKSLASH_N = "chr(92) || 'N'"

RAW_SQL = {
    "circuits": """
SELECT CAST(n.n_nationkey AS BIGINT) AS circuitId,
       lower(n.n_name) AS circuitRef,
       n.n_name || ' Circuit' AS name,
       n.n_name AS location,
       r.r_name AS country,
       CAST(n.n_nationkey AS DOUBLE) * 2.5 - 30.0 AS lat,
       CAST(n.n_regionkey AS DOUBLE) * 30.0 - 60.0 AS lng,
       CAST(n.n_nationkey * 10 AS INT) AS alt,
       'http://example.org/circuits/' || CAST(n.n_nationkey AS STRING) AS url
  FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "races": f"""
SELECT o.o_orderkey AS raceId,
       CAST(year(o.o_orderdate) AS INT) AS year,
       CAST(month(o.o_orderdate) AS INT) AS round,
       CAST(c.c_nationkey AS BIGINT) AS circuitId,
       o.o_orderpriority || ' Grand Prix' AS name,
       CAST(o.o_orderdate AS DATE) AS date,
       CASE WHEN o.o_orderkey % 7 = 0 THEN {_BACKSLASH_N}
            ELSE lpad(CAST(o.o_orderkey % 24 AS STRING), 2, '0') || ':'
                 || lpad(CAST(o.o_orderkey % 60 AS STRING), 2, '0') || ':00' END AS time,
       'http://example.org/races/' || CAST(o.o_orderkey AS STRING) AS url
  FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey""",
    "constructors": """
SELECT s.s_suppkey AS constructorId,
       lower(s.s_name) AS constructorRef,
       s.s_name AS name,
       n.n_name AS nationality,
       'http://example.org/constructors/' || CAST(s.s_suppkey AS STRING) AS url
  FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    "drivers": """
SELECT p.p_partkey AS driverId,
       replace(p.p_name, ' ', '_') || '_' || CAST(p.p_partkey AS STRING) AS driverRef,
       CAST(p.p_size AS INT) AS number,
       upper(substr(p.p_name, 1, 3)) AS code,
       split_part(p.p_name, ' ', 1) AS name_forename,
       split_part(p.p_name, ' ', 2) || '#' || CAST(p.p_partkey AS STRING) AS name_surname,
       make_date(CAST(1950 + p.p_partkey % 50 AS INT), CAST(1 + p.p_partkey % 12 AS INT),
                 CAST(1 + p.p_partkey % 28 AS INT)) AS dob,
       p.p_brand AS nationality,
       'http://example.org/drivers/' || CAST(p.p_partkey AS STRING) AS url
  FROM {part} p""",
    "results": """
SELECT l.l_orderkey * 1000000 + l.l_partkey AS resultId,
       l.l_orderkey AS raceId,
       l.l_partkey AS driverId,
       l.l_suppkey AS constructorId,
       CAST(l.l_suppkey % 100 AS INT) AS number,
       CAST(l.l_linenumber AS INT) AS grid,
       CAST(l.l_linenumber AS INT) AS position,
       CAST(l.l_linenumber AS STRING) AS positionText,
       CAST(l.l_linenumber AS INT) AS positionOrder,
       CAST(l.l_quantity + {bonus} AS FLOAT) AS points,
       CAST(l.l_quantity AS INT) + 40 AS laps,
       '1:' || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') || '.'
            || lpad(CAST(l.l_orderkey % 1000 AS STRING), 3, '0') AS time,
       CAST(5000000 + l.l_partkey AS INT) AS milliseconds,
       CAST(l.l_linenumber + 40 AS INT) AS fastestLap,
       CAST(l.l_linenumber AS INT) AS rank,
       '1:' || lpad(CAST(l.l_suppkey % 60 AS STRING), 2, '0') || '.'
            || lpad(CAST(l.l_partkey % 1000 AS STRING), 3, '0') AS fastestLapTime,
       CAST(200 + l.l_linenumber AS FLOAT) AS fastestLapSpeed,
       l.l_returnflag AS statusId
  FROM {lineitem} l""",
    "pit_stops": """
SELECT l.l_orderkey AS raceId,
       l.l_partkey AS driverId,
       CAST(l.l_linenumber AS STRING) AS stop,
       CAST(l.l_quantity AS INT) AS lap,
       lpad(CAST(12 + l.l_linenumber AS STRING), 2, '0') || ':'
            || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') || ':00' AS time,
       CAST(20 + l.l_linenumber AS STRING) || '.' || lpad(CAST(l.l_partkey % 1000 AS STRING), 3, '0') AS duration,
       CAST((20 + l.l_linenumber) * 1000 + l.l_partkey % 1000 AS INT) AS milliseconds
  FROM {lineitem} l""",
    "lap_times": """
SELECT l.l_orderkey AS raceId,
       l.l_partkey AS driverId,
       CAST(l.l_linenumber AS INT) AS lap,
       CAST(l.l_linenumber AS INT) AS position,
       '1:' || lpad(CAST(l.l_suppkey % 60 AS STRING), 2, '0') || '.'
            || lpad(CAST(l.l_orderkey % 1000 AS STRING), 3, '0') AS time,
       CAST(60000 + l.l_suppkey * 100 + l.l_linenumber AS INT) AS milliseconds
  FROM {lineitem} l""",
    "qualifying": """
SELECT l.l_orderkey * 1000000 + l.l_partkey AS qualifyId,
       l.l_orderkey AS raceId,
       l.l_partkey AS driverId,
       l.l_suppkey AS constructorId,
       CAST(l.l_suppkey % 100 AS INT) AS number,
       CAST(l.l_linenumber AS INT) AS position,
       '1:' || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') || '.100' AS q1,
       CASE WHEN l.l_linenumber <= 5 THEN '1:' || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') || '.050' END AS q2,
       CASE WHEN l.l_linenumber <= 3 THEN '1:' || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') || '.010' END AS q3
  FROM {lineitem} l""",
}

FACTS = ("results", "pit_stops", "lap_times", "qualifying")


def _batch_filter(start: str | None, end: str | None) -> str:
    preds = []
    if start:
        preds.append(f"o.o_orderdate >= DATE '{start}'")
    if end:
        preds.append(f"o.o_orderdate < DATE '{end}'")
    return " AND ".join(preds) or "TRUE"


def batch_bounds(file_date: str) -> tuple[str | None, str | None, int]:
    for i, (d, start, end) in enumerate(BATCHES):
        if d == file_date:
            return start, end, i
    raise KeyError(file_date)


def feed_sql(name: str, file_date: str | None = None) -> str:
    """Template of one raw feed; for facts, restricted to one delivery batch.

    The last batch also re-delivers part of the previous batch with one more
    point (results) as a late correction.
    """
    body = RAW_SQL[name]
    if name == "results":
        body_now = body.replace("{bonus}", "0")
    else:
        body_now = body
    if name not in FACTS or file_date is None:
        return body_now
    start, end, idx = batch_bounds(file_date)
    scoped = (f"SELECT f.* FROM ({body_now}) f JOIN {{orders}} o ON f.raceId = o.o_orderkey "
              f"WHERE {_batch_filter(start, end)}")
    if idx == len(BATCHES) - 1 and idx > 0:
        _, pstart, pend = BATCHES[idx - 1]
        prev = body.replace("{bonus}", "1") if name == "results" else body
        redo = (f"SELECT f.* FROM ({prev}) f JOIN {{orders}} o ON f.raceId = o.o_orderkey "
                f"WHERE {_batch_filter(pstart, pend)} AND f.driverId % 10 = 0")
        scoped = f"{scoped}\nUNION ALL\n{redo}"
    return scoped


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in names}


def stage_deliveries(spark: SparkSession, sf_dir: str, file_dates) -> tuple[DataFrame, str]:
    """The lineitem rows of the deliveries ``file_dates`` (and of the one the last re-delivers
    from), joined with their orders once and stored by ``delivery`` (its number), with the
    folder they lie in.

    Holds only the columns that the fact templates read. Every feed of every delivery then
    reads its own rows, where the join of ``feed_sql`` would shuffle all of lineitem for each.
    """
    wanted = {batch_bounds(d)[2] for d in file_dates}
    if len(BATCHES) - 1 in wanted:
        wanted.add(len(BATCHES) - 2)
    cols = sorted(set(re.findall(r"\bl\.(\w+)", " ".join(RAW_SQL[n] for n in FACTS))))
    number = " ".join(f"WHEN {_batch_filter(*BATCHES[i][1:])} THEN {i}" for i in sorted(wanted))
    t = load_tables(spark, sf_dir, ["orders", "lineitem"])
    orders = (t["orders"].alias("o").selectExpr("o_orderkey", f"CASE {number} END AS delivery")
              .filter("delivery IS NOT NULL"))
    rows = (t["lineitem"].select(*cols)
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey"))
    path = work_dir(spark, "deliveries")
    with freed_shuffles(spark):
        rows.write.options(**PAGES).partitionBy("delivery").parquet(path, compression=CODEC)
    return spark.read.schema(rows.schema).parquet(path), path


def _delivered_feed(spark: SparkSession, delivered: DataFrame, name: str,
                    file_date: str) -> DataFrame:
    """What ``feed_sql(name, file_date)`` gives, from the stored deliveries."""
    idx = batch_bounds(file_date)[2]

    def rows(i: int, bonus: int) -> DataFrame:
        return spark.sql(RAW_SQL[name].replace("{bonus}", str(bonus)),
                         lineitem=delivered.filter(F.col("delivery") == i))

    df = rows(idx, 0)
    if idx == len(BATCHES) - 1 and idx > 0:
        df = df.unionByName(rows(idx - 1, 1).filter("driverId % 10 = 0"))
    return df


def raw_feed(spark: SparkSession, sf_dir: str, name: str,
             file_date: str | None = None,
             tables: dict[str, DataFrame] | None = None,
             delivered: DataFrame | None = None) -> DataFrame:
    """A raw feed as a Spark DataFrame with the raw column names.

    drivers gets its nested ``name`` struct; other feeds are flat. Only the
    test tables the template uses are read (``tables`` may carry them already);
    facts of a delivery are read from ``delivered`` (``stage_deliveries``) if it is given.
    """
    if delivered is not None and name in FACTS and file_date is not None:
        return _delivered_feed(spark, delivered, name, file_date)
    sql = feed_sql(name, file_date)
    needed = [t for t in TABLES if "{" + t + "}" in sql]
    tables = tables if tables is not None else {}
    missing = [t for t in needed if t not in tables]
    tables.update(load_tables(spark, sf_dir, missing))
    df = spark.sql(sql, **{t: tables[t] for t in needed})
    if name == "drivers":
        df = df.select("driverId", "driverRef", "number", "code",
                       F.struct(F.col("name_forename").alias("forename"),
                                F.col("name_surname").alias("surname")).alias("name"),
                       "dob", "nationality", "url")
    return df


def oracle_feed(name: str, file_date: str | None = None) -> str:
    """The same feed as DuckDB SQL over the pre-registered test-table views."""
    return feed_sql(name, file_date).format(**{t: t for t in TABLES})


# --- writers of raw files ---------------------------------------------------

ROWS_PER_FILE = 50_000          # of a multi-line JSON file, which one task parses whole
ROWS_PER_PACKED = 2_000_000     # of a compressed CSV or JSON-lines file, which is not split either


def _packed(writer, rows_per_file: int = ROWS_PER_PACKED):
    """Deliveries are gzip files of a bounded number of rows: their text repeats itself, and
    what it takes on disk is a multiple of every table derived from it."""
    return writer.mode("overwrite").option("compression", "gzip") \
                 .option("maxRecordsPerFile", rows_per_file)


def _json_array_files(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write rows as multi-line JSON files (one JSON array each) of at most
    ``rows_per_file`` rows.

    A multi-line JSON file is parsed whole by one task, so their number follows the
    row count. Each task streams its rows, a line each, where they are: brackets open and
    close an array every ``rows_per_file`` lines, where the writer begins a new file.
    Nothing is shuffled or counted and only the current batch is held.
    """
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("j"))

    def wrap(batches):
        import pandas as pd
        n, held = 0, None     # the last line waits: it may be the one that closes the array
        for b in batches:
            out = []
            for v in b["j"].tolist():
                if held is not None:
                    out.append(held + ("]" if n % rows_per_file == 0 else ""))
                held = ("[" if n % rows_per_file == 0 else ",") + v
                n += 1
            yield pd.DataFrame({"value": out}, dtype="object")
        if held is not None:
            yield pd.DataFrame({"value": [held + "]"]})

    _packed(lines.mapInPandas(wrap, "value string").write, rows_per_file).text(path)


def write_feed(df: DataFrame, name: str, path: str) -> str:
    """Write one raw feed in its native format at ``path``."""
    with freed_shuffles(df.sparkSession):
        if name in ("circuits", "races"):
            _packed(df.write).option("header", True).csv(path)
        elif name == "lap_times":
            _packed(df.write).option("header", False).csv(path)
        elif name in ("pit_stops", "qualifying"):
            _json_array_files(df, path)
        else:
            _packed(df.write).json(path)
    return path


def write_raw_folder(spark: SparkSession, sf_dir: str, root: str,
                     file_date: str | None = None, names=None,
                     delivered: DataFrame | None = None) -> str:
    """Write every feed (or ``names``) into ``root`` (``root/<file_date>`` when
    a batch is given); dimensions are full copies in every batch."""
    folder = os.path.join(root, file_date) if file_date else root
    for name in names or FEED_FILES:
        df = raw_feed(spark, sf_dir, name, file_date if name in FACTS else None,
                      delivered=delivered)
        write_feed(df, name, os.path.join(folder, FEED_FILES[name]))
    return folder


def write_deliveries(spark: SparkSession, sf_dir: str, root: str, file_dates,
                     names=None) -> str:
    """Write the delivery folders ``root/<file_date>``; the facts' rows are joined once for
    all of them, and what was stored for that is deleted when they are written."""
    delivered, path = stage_deliveries(spark, sf_dir, file_dates)
    for d in file_dates:
        write_raw_folder(spark, sf_dir, root, d, names, delivered)
    _delete_folders(spark, [path])
    return root
