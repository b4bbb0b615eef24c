"""Raw file schemas of the eight source feeds.

Fixed values: column names, order and types of each raw feed as declared by
the source data. Key columns (``...Id``) are BIGINT rather than INT so that
fact keys cannot overflow at scale; every other type is as declared.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, FloatType, IntegerType,
                               LongType, StringType, StructField, StructType)

# Raw feed layouts.
CIRCUITS = StructType([
    StructField("circuitId", LongType()),
    StructField("circuitRef", StringType()),
    StructField("name", StringType()),
    StructField("location", StringType()),
    StructField("country", StringType()),
    StructField("lat", DoubleType()),
    StructField("lng", DoubleType()),
    StructField("alt", IntegerType()),
    StructField("url", StringType()),
])

RACES = StructType([
    StructField("raceId", LongType()),
    StructField("year", IntegerType()),
    StructField("round", IntegerType()),
    StructField("circuitId", LongType()),
    StructField("name", StringType()),
    StructField("date", DateType()),
    StructField("time", StringType()),
    StructField("url", StringType()),
])

# The constructors feed is declared as a DDL string.
CONSTRUCTORS_DDL = ("constructorId BIGINT, constructorRef STRING, name STRING, "
                    "nationality STRING, url STRING")

DRIVER_NAME = StructType([
    StructField("forename", StringType()),
    StructField("surname", StringType()),
])

DRIVERS = StructType([
    StructField("driverId", LongType()),
    StructField("driverRef", StringType()),
    StructField("number", IntegerType()),
    StructField("code", StringType()),
    StructField("name", DRIVER_NAME),
    StructField("dob", DateType()),
    StructField("nationality", StringType()),
    StructField("url", StringType()),
])

RESULTS = StructType([
    StructField("resultId", LongType()),
    StructField("raceId", LongType()),
    StructField("driverId", LongType()),
    StructField("constructorId", LongType()),
    StructField("number", IntegerType()),
    StructField("grid", IntegerType()),
    StructField("position", IntegerType()),
    StructField("positionText", StringType()),
    StructField("positionOrder", IntegerType()),
    StructField("points", FloatType()),
    StructField("laps", IntegerType()),
    StructField("time", StringType()),
    StructField("milliseconds", IntegerType()),
    StructField("fastestLap", IntegerType()),
    StructField("rank", IntegerType()),
    StructField("fastestLapTime", StringType()),
    StructField("fastestLapSpeed", FloatType()),
    StructField("statusId", StringType()),
])

PIT_STOPS = StructType([
    StructField("raceId", LongType()),
    StructField("driverId", LongType()),
    StructField("stop", StringType()),
    StructField("lap", IntegerType()),
    StructField("time", StringType()),
    StructField("duration", StringType()),
    StructField("milliseconds", IntegerType()),
])

LAP_TIMES = StructType([
    StructField("raceId", LongType()),
    StructField("driverId", LongType()),
    StructField("lap", IntegerType()),
    StructField("position", IntegerType()),
    StructField("time", StringType()),
    StructField("milliseconds", IntegerType()),
])

QUALIFYING = StructType([
    StructField("qualifyId", LongType()),
    StructField("raceId", LongType()),
    StructField("driverId", LongType()),
    StructField("constructorId", LongType()),
    StructField("number", IntegerType()),
    StructField("position", IntegerType()),
    StructField("q1", StringType()),
    StructField("q2", StringType()),
    StructField("q3", StringType()),
])

# camelCase -> snake_case renames applied at ingestion.
RENAMES = {
    "circuits": {"circuitId": "circuit_id", "circuitRef": "circuit_ref",
                 "lat": "latitude", "lng": "longitude", "alt": "altitude"},
    "constructors": {"constructorId": "constructor_id", "constructorRef": "constructor_ref"},
    "drivers": {"driverId": "driver_id", "driverRef": "driver_ref"},
    "results": {"resultId": "result_id", "raceId": "race_id", "driverId": "driver_id",
                "constructorId": "constructor_id", "positionText": "position_text",
                "positionOrder": "position_order", "fastestLap": "fastest_lap",
                "fastestLapTime": "fastest_lap_time", "fastestLapSpeed": "fastest_lap_speed"},
    "pit_stops": {"driverId": "driver_id", "raceId": "race_id"},
    "lap_times": {"driverId": "driver_id", "raceId": "race_id"},
    "qualifying": {"qualifyId": "qualify_id", "driverId": "driver_id", "raceId": "race_id",
                   "constructorId": "constructor_id"},
}

RAW_SCHEMAS = {
    "circuits": CIRCUITS,
    "races": RACES,
    "constructors": CONSTRUCTORS_DDL,
    "drivers": DRIVERS,
    "results": RESULTS,
    "pit_stops": PIT_STOPS,
    "lap_times": LAP_TIMES,
    "qualifying": QUALIFYING,
}


def to_ddl(schema) -> str:
    """Column list of a schema as SQL DDL (``a INT, b STRUCT<x: STRING>``)."""
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
