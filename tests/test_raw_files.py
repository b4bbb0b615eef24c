"""Raw files of the test tables: compressed, of bounded size, with every row."""

import glob
import gzip
import json
import os

from paddock.schemas import RAW_SCHEMAS
from paddock.sources import feeds
from paddock.sources import testtables as tt


def _pit_stops(spark, n, parts):
    return spark.range(0, n, 1, parts).selectExpr(
        "id AS raceId", "id % 7 AS driverId", "CAST(id % 3 AS STRING) AS stop", "CAST(id AS INT) AS lap",
        "'12:00:00' AS time", "'20.1' AS duration", "CAST(id AS INT) AS milliseconds")


def test_array_files_are_whole_bounded_and_packed(spark, tmp):
    for n, parts in ((0, 2), (1, 3), (20, 2), (23, 2), (47, 1)):
        path = os.path.join(tmp, f"a{n}")
        tt._json_array_files(_pit_stops(spark, n, parts), path, rows_per_file=5)
        files = [json.loads(t) for t in (gzip.open(f, "rt").read() for f in
                                         glob.glob(f"{path}/part-*.gz")) if t]
        assert sorted(r["raceId"] for f in files for r in f) == list(range(n))
        assert all(len(f) <= 5 for f in files)
        back = feeds.read_json(spark, path, RAW_SCHEMAS["pit_stops"], multiline=True)
        assert sorted(r.raceId for r in back.collect()) == list(range(n))


def test_every_format_is_packed_and_read_back(spark, tmp):
    from conftest import SF_SMALL
    for name in feeds.FEED_FILES:
        path = os.path.join(tmp, feeds.FEED_FILES[name])
        df = tt.raw_feed(spark, SF_SMALL, name)
        tt.write_feed(df, name, path)
        assert glob.glob(f"{path}/part-*.gz") and not glob.glob(f"{path}/part-*[!z]")
        assert feeds.read_feed(spark, tmp, name).count() == df.count()


def test_delivered_feeds_equal_their_sql(spark, tmp):
    import datetime
    day = datetime.date
    dates = [day(1999, 1, 1), day(2000, 7, 1), day(2001, 2, 28), day(2001, 3, 1), None, day(2000, 8, 1)]
    orders = [(k, d) for k, d in enumerate(dates)] + [(0, day(2001, 5, 1)), (5, day(2000, 9, 9)), (None, day(1999, 1, 1))]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate date").write.parquet(f"{tmp}/orders.parquet")
    items = [(k, p, 3, n, 5.0, "A") for k in (0, 1, 2, 3, 4, 5, 99, None) for n, p in ((1, 10), (2, 11), (2, 11), (3, None))]
    spark.createDataFrame(items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                          "l_quantity double, l_returnflag string").write.parquet(f"{tmp}/lineitem.parquet")
    for d in [b[0] for b in tt.BATCHES]:
        delivered, _ = tt.stage_deliveries(spark, tmp, [d])
        for name in tt.FACTS:
            got = tt.raw_feed(spark, tmp, name, d, delivered=delivered)
            want = tt.raw_feed(spark, tmp, name, d)
            assert got.schema.simpleString() == want.schema.simpleString()
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            # facts stay where the staged rows lie
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert delivered.count() > 0


def test_a_batch_is_shuffled_once_before_its_merge(spark):
    from paddock.plans.ingest import MERGE_KEYS, prepare_incremental
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        races = spark.range(9).selectExpr("id AS race_id", "CAST(2000 + id AS INT) AS race_year")
        fact = spark.range(90).selectExpr("id % 9 AS race_id", "id % 30 AS driver_id", "id AS result_id",
                                          "id % 30 AS qualify_id", "id % 3 AS stop", "id % 2 AS lap")
        for name in MERGE_KEYS:
            plan = prepare_incremental(fact, name, races)._jdf.queryExecution().executedPlan().toString()
            # the rows' one, the races' one
            assert plan.count("Exchange hashpartitioning") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_of_a_full_load_are_shuffled_once(spark, tmp, monkeypatch):
    from paddock.plans import ingest as plan
    written = {}

    def keep(df, path, partition_by=None, cluster_by=(), rebalance=True):
        written[os.path.basename(path)] = (df._jdf.queryExecution().executedPlan().toString(), rebalance)
        return real(df, path, partition_by, cluster_by, rebalance)
    real = plan.overwrite_parquet
    monkeypatch.setattr(plan, "overwrite_parquet", keep)
    from conftest import SF_SMALL
    names = ["races", *plan.MERGE_KEYS]
    tt.write_raw_folder(spark, SF_SMALL, f"{tmp}/raw", None, names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            plan.ingest(spark, f"{tmp}/raw", f"{tmp}/done", n)
            text, rebalance = written[n]
            assert text.count("Exchange hashpartitioning") == (0 if n == "races" else 2) and not rebalance
            if n != "races":
                want = tt.raw_feed(spark, SF_SMALL, n).count()
                assert spark.read.parquet(f"{tmp}/done/{n}").count() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
