"""Star joins of the results fact with its dimensions.

Dimensions are projected to the columns the output needs *before* joining, so
column pruning reaches every Parquet scan and no name is ambiguous. No join
hints are given: Spark broadcasts a side only when its (static or runtime, via
AQE) size is under ``autoBroadcastJoinThreshold`` and otherwise falls back to
a sort-merge join, with AQE splitting skewed keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.conform import timestamp_literal

# Fixed value: output columns of the race results presentation table.
RACE_RESULT_COLUMNS = [
    "race_year", "race_name", "race_date", "circuit_location", "driver_name",
    "driver_number", "driver_nationality", "team", "grid", "fastest_lap",
    "race_time", "points", "position",
]


def _races(races: DataFrame) -> DataFrame:
    return races.select("race_id", "race_year", F.col("name").alias("race_name"),
                        F.col("race_timestamp").alias("race_date"), "circuit_id")


def _circuits(circuits: DataFrame) -> DataFrame:
    return circuits.select("circuit_id", F.col("location").alias("circuit_location"))


def race_circuits(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """Races with the location of their circuit (inner join on circuit_id)."""
    return (_races(races).join(_circuits(circuits), "circuit_id", "inner")
             .select("race_id", "race_year", "race_name", "race_date", "circuit_location"))


def race_results(results: DataFrame, races: DataFrame, circuits: DataFrame,
                 drivers: DataFrame, constructors: DataFrame,
                 load_ts: str | _dt.datetime | None = None,
                 incremental: bool = False, stored: bool = False) -> DataFrame:
    """One row per result with race, circuit, driver and team attributes.

    ``stored``: the dimensions are read from their tables, so Spark knows their sizes before it
    plans. Circuits and teams, few by nature, then come last: where they are broadcast their
    names are in no shuffle.

    ``incremental=True`` keeps ``race_id`` (merge key) and the fact's
    ``file_date`` (batch marker) in the output.
    """
    fact_cols = ["race_id", "driver_id", "constructor_id", "grid", "fastest_lap",
                 F.col("time").alias("race_time"), "points", "position"]
    if incremental:
        fact_cols.append("file_date")
    fact = results.select(*fact_cols)
    drv = drivers.select("driver_id", F.col("number").alias("driver_number"),
                         F.col("name").alias("driver_name"),
                         F.col("nationality").alias("driver_nationality"))
    team = constructors.select("constructor_id", F.col("name").alias("team"))
    # what a join shuffles carries the attributes of the joins before it
    if stored:
        joined = (fact.join(_races(races), "race_id")
                      .join(drv, "driver_id")
                      .join(_circuits(circuits), "circuit_id")
                      .join(team, "constructor_id"))
    else:   # the widest attributes last
        joined = (fact.join(team, "constructor_id")
                      .join(drv, "driver_id")
                      .join(race_circuits(races, circuits), "race_id"))
    cols = list(RACE_RESULT_COLUMNS)
    if incremental:
        cols = ["race_id"] + cols + ["file_date"]
    return joined.select(*cols).withColumn("created_date", timestamp_literal(load_ts))


def calculated_results(results: DataFrame, races: DataFrame, drivers: DataFrame,
                       constructors: DataFrame, top_n: int = 10,
                       incremental: bool = False, file_date: str | None = None,
                       stored: bool = False) -> DataFrame:
    """Top-``top_n`` finishes scored ``top_n + 1 - position``.

    The full form returns (race_year, team_name, driver_name, position, points,
    calculated_points); the incremental form adds the merge keys driver_id and
    race_id, stores points as INT, and restricts the fact to one ``file_date``.
    The position (and batch) predicates are pushed into the results scan. ``stored`` as in
    ``race_results``: the teams are joined last.
    """
    fact = results.filter(F.col("position") <= F.lit(top_n))
    if file_date is not None:
        fact = fact.filter(F.col("file_date") == F.lit(file_date))
    fact = fact.select("race_id", "driver_id", "constructor_id", "position", "points")
    drv = drivers.select("driver_id", F.col("name").alias("driver_name"))
    team = constructors.select("constructor_id", F.col("name").alias("team_name"))
    yr = races.select("race_id", "race_year")
    joined = fact.join(yr, "race_id")
    if stored:
        joined = joined.join(drv, "driver_id").join(team, "constructor_id")
    else:
        joined = joined.join(team, "constructor_id").join(drv, "driver_id")
    calc = (F.lit(top_n + 1) - F.col("position")).alias("calculated_points")
    if incremental:
        return joined.select("race_year", "team_name", "driver_id", "driver_name", "race_id",
                             "position", F.col("points").cast("int").alias("points"), calc)
    return joined.select("race_year", "team_name", "driver_name", "position", "points", calc)
