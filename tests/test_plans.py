"""Plan checks: filters and column pruning reach the scans, the top-k rank is
limited before its single-partition exchange, batch seasons are a semi join,
and no query plan contains a Python UDF."""

import os

import pytest

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def queries():
    import __spark_entry__ as e
    return e.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_position_filter_pushed_to_scan(spark, queries):
    plan = _plan(queries["calculated_results"](spark, SF_SMALL))
    assert "LessThanOrEqual(l_linenumber,5)" in plan


def test_top_k_uses_window_group_limit(spark, queries):
    df = queries["top10_drivers"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString() or \
        "WindowGroupLimit" in _plan(df)


def test_affected_seasons_is_a_semi_join(spark, queries):
    assert "LeftSemi" in _plan(queries["affected_years_semi"](spark, SF_SMALL))


def test_no_python_udf_in_analytic_plans(spark, queries):
    for name in ["race_results", "driver_standings", "dominant_drivers_by_year", "dedupe_by_key"]:
        plan = _plan(queries[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_upsert_prunes_target_partitions(spark, tmp):
    from paddock.sinks.writes import overwrite_parquet, upsert_frame
    path = os.path.join(tmp, "t")
    base = spark.range(0, 1000).selectExpr("CAST(id % 7 AS INT) AS race_year", "id AS race_id",
                                          "id AS v")
    overwrite_parquet(base, path, partition_by=["race_year"])
    src = spark.createDataFrame([(3, 3, 99)], "race_year int, race_id bigint, v bigint")
    merged = upsert_frame(spark, src, path, ["race_id", "race_year"], "race_year")
    plan = _plan(merged)
    assert "(race_year#" in plan and "= 3)]" in plan   # static partition filter on the target
    rows = merged.collect()
    assert len(rows) == base.filter("race_year = 3").count()
    assert {r.v for r in rows if r.race_id == 3} == {99}


def test_star_join_broadcasts_small_dimensions(spark, queries):
    plan = _plan(queries["race_results"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan


def test_incremental_season_read_uses_dynamic_pruning(spark, tmp):
    from pyspark.sql import functions as F

    from paddock.operators.standings import affected_periods, rows_of_periods
    from paddock.sinks.writes import overwrite_parquet
    path = os.path.join(tmp, "rr")
    rr = spark.range(0, 5000).select(
        (F.col("id") % 7 + 1995).cast("int").alias("race_year"), F.col("id").alias("race_id"),
        F.when(F.col("id") % 7 == 3, "b2").otherwise("b1").alias("file_date"))
    overwrite_parquet(rr, path, partition_by=["race_year"])
    table = spark.read.parquet(path)
    seasons = rows_of_periods(table, affected_periods(table, "b2"))
    assert "dynamicpruning" in _plan(seasons).lower()
    assert {r.race_year for r in seasons.select("race_year").distinct().collect()} == {1998}
