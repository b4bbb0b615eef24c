"""One key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.functions.conform import dedupe_by_key
from paddock.operators.standings import (affected_periods, driver_standings, rank_within,
                                         rows_of_periods)
from paddock.operators.star import calculated_results


def test_hot_season_rank_is_exact(spark):
    # season 2000 holds a third of the rows (and many tied scores)
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(2000)).otherwise((F.col("id") % 50 + 1950).cast("int"))
        .alias("race_year"), F.col("id").alias("entity"),
        (F.col("id") % 37).alias("pts"), (F.col("id") % 4).alias("wins"))
    ours = rank_within(df, ["race_year"], ["pts", "wins"])
    ref = df.withColumn("rank", F.rank().over(
        Window.partitionBy("race_year").orderBy(F.col("pts").desc(), F.col("wins").desc())))
    assert ours.count() == 30000
    assert ours.exceptAll(ref.select(*ours.columns)).count() == 0


def test_hot_driver_in_star_join_and_standings(spark):
    n = 30000
    results = spark.range(0, n).select(
        (F.col("id") % 500).alias("race_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200).alias("driver_id"),
        (F.col("id") % 10).alias("constructor_id"),
        ((F.col("id") % 12) + 1).cast("int").alias("position"),
        (F.col("id") % 26).cast("float").alias("points"))
    races = spark.range(0, 500).select(F.col("id").alias("race_id"),
                                       (F.col("id") % 5 + 2000).cast("int").alias("race_year"))
    drivers = spark.range(0, 200).select(F.col("id").alias("driver_id"),
                                         F.concat(F.lit("d"), F.col("id")).alias("name"))
    teams = spark.range(0, 10).select(F.col("id").alias("constructor_id"),
                                      F.concat(F.lit("t"), F.col("id")).alias("name"))
    calc = calculated_results(results, races, drivers, teams, top_n=10)
    want = results.filter("position <= 10").count()
    assert calc.count() == want
    hot = calc.filter("driver_name = 'd7'").count()
    assert hot == results.filter("position <= 10 AND driver_id = 7").count()
    rr = calc.select("race_year", F.col("driver_name"), F.lit("x").alias("driver_nationality"),
                     F.col("team_name").alias("team"), "points", "position")
    st = driver_standings(rr, with_team=False)
    total = st.agg(F.sum("total_points")).collect()[0][0]
    assert total == rr.agg(F.sum("points")).collect()[0][0]


def test_hot_key_dedupe_keeps_every_other_key(spark):
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    out = dedupe_by_key(df, ["k"])
    assert out.count() == 20000 + 1
    assert out.filter("k = -1").collect()[0].v == 0


def test_hot_season_continuous_scores_bucketed_rank_is_exact(spark):
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(2000)).otherwise((F.col("id") % 20 + 1980).cast("int"))
        .alias("race_year"), F.col("id").alias("entity"),
        (F.sin(F.col("id")) * 500).alias("pts"), (F.col("id") % 4).alias("wins"))
    ours = rank_within(df, ["race_year"], ["pts", "wins"], buckets=16)
    ref = df.withColumn("rank", F.rank().over(
        Window.partitionBy("race_year").orderBy(F.col("pts").desc(), F.col("wins").desc())))
    assert ours.count() == 20000
    assert ours.exceptAll(ref.select(*ours.columns)).count() == 0


def test_rows_of_periods_stay_where_they_are(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = f"{tmp}/rr"
        spark.range(3000).selectExpr("id", "IF(id % 100 = 0, 'b', 'a') AS file_date", "CAST(2000 + id % 7 AS INT) AS race_year"
                                     ).write.partitionBy("race_year").parquet(path)
        rr = spark.read.parquet(path)
        out = rows_of_periods(rr, affected_periods(rr, "b"))
        assert out.count() == 3000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
