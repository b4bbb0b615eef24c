import pytest

from paddock.operators import profile


def test_distinct_values_list(spark):
    df = spark.range(0, 50).selectExpr("id % 5 AS y")
    assert sorted(profile.distinct_values_list(df, "y")) == [0, 1, 2, 3, 4]


def test_describe_columns_one_pass(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None), (5, 6.0)], "a int, b double")
    out = {r.column_name: r for r in profile.describe_columns(df, ["a", "b"]).collect()}
    assert (out["a"]["count"], out["a"]["mean"], out["a"]["min"], out["a"]["max"]) == \
        (3, 3.0, 1.0, 5.0)
    assert out["a"]["stddev"] == pytest.approx(2.0)
    assert (out["b"]["count"], out["b"]["mean"]) == (2, 4.0)


def test_counts_and_spot_check(spark):
    rr = spark.createDataFrame(
        [(2020, "R1", 10.0, "d1"), (2020, "R1", 25.0, "d1"), (2020, "R2", 1.0, "d2"),
         (2021, "R1", 5.0, "d2")], "race_year int, race_name string, points float, file_date string")
    assert profile.row_count(rr).collect()[0].n == 4
    assert [(r.file_date, r.n) for r in profile.count_by(rr, ["file_date"]).collect()] == \
        [("d2", 2), ("d1", 2)]
    spot = profile.spot_check(rr, 2020, "R1").collect()
    assert [r.points for r in spot] == [25.0, 10.0]
