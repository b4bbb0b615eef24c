import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from paddock.functions.conform import (add_audit_columns, audit_duplicate_keys, dedupe_by_key,
                                       flatten_struct, partition_column_last, race_timestamp,
                                       rename_columns)


def test_rename_is_strict(spark):
    df = spark.createDataFrame([(1, 2)], "raceId int, driverId int")
    out = rename_columns(df, {"raceId": "race_id"})
    assert out.columns == ["race_id", "driverId"]
    with pytest.raises(ValueError):
        rename_columns(df, {"missing": "x"})


def test_race_timestamp_tolerates_missing_time(spark):
    df = spark.createDataFrame(
        [("2020-03-01", "10:05:00"), ("2020-03-02", "\\N"), (None, "10:00:00"),
         ("2020-03-03", "25:00:00"), ("2021-03-28", "02:30:00")],
        "date string, time string").withColumn("date", F.col("date").cast("date"))
    rows = df.select(race_timestamp().alias("ts")).collect()
    assert str(rows[0].ts) == "2020-03-01 10:05:00"
    assert rows[1].ts is None and rows[2].ts is None and rows[3].ts is None
    # a wall-clock time that does not exist in a DST zone is kept as written
    tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert str(df.select(race_timestamp().alias("ts")).collect()[4].ts) == \
            "2021-03-28 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    assert dict(df.select(race_timestamp().alias("ts")).dtypes)["ts"] == "timestamp_ntz"


def test_flatten_struct_null_part_gives_null(spark):
    df = spark.createDataFrame([Row(name=Row(forename="Ann", surname="Lee")),
                                Row(name=Row(forename=None, surname="Roe"))])
    out = flatten_struct(df, "name", ["forename", "surname"]).collect()
    assert out[0].name == "Ann Lee" and out[1].name is None


def test_audit_columns_use_one_literal_stamp(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    out = add_audit_columns(df, "src", "2021-03-21", "2021-03-21 06:00:00")
    assert out.columns == ["a", "data_source", "file_date", "ingestion_date"]
    assert {str(r.ingestion_date) for r in out.collect()} == {"2021-03-21 06:00:00"}


def test_partition_column_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "race_id int, a int, b int")
    assert partition_column_last(df, "race_id").columns == ["a", "b", "race_id"]


def test_dedupe_is_deterministic_and_keeps_smallest(spark):
    rows = [(1, 1, 30, "z"), (1, 1, 10, "y"), (1, 1, 10, "a"), (2, 1, 5, None), (2, 1, 5, "b")]
    df = spark.createDataFrame(rows, "race_id int, driver_id int, result_id int, tag string")
    out = {(r.race_id, r.driver_id): (r.result_id, r.tag)
           for r in dedupe_by_key(df, ["race_id", "driver_id"]).collect()}
    assert out == {(1, 1): (10, "a"), (2, 1): (5, None)}
    # same answer whatever the input order / partitioning
    again = dedupe_by_key(df.repartition(3).orderBy(F.rand(7)), ["race_id", "driver_id"])
    assert sorted(again.collect()) == sorted(dedupe_by_key(df, ["race_id", "driver_id"]).collect())


def test_dedupe_hot_key_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 30000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    out = dedupe_by_key(hot, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert out.collect()[0].v == 0


def test_audit_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "race_id int, driver_id int")
    assert [tuple(r) for r in audit_duplicate_keys(df, ["race_id", "driver_id"]).collect()] == \
        [(1, 1, 2)]
