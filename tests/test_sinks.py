import os

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.sinks import writes as sink

SCHEMA = "race_year int, race_id int, driver_id int, points int, tag string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _state(spark, path):
    return {(r.race_year, r.race_id, r.driver_id): (r.points, r.tag)
            for r in spark.read.parquet(path).collect()}


KEYS = ["race_id", "driver_id", "race_year"]


def test_upsert_first_load_merge_and_idempotence(spark, tmp):
    path = os.path.join(tmp, "t")
    sink.upsert(spark, _df(spark, [(2020, 1, 1, 10, "a"), (2020, 1, 2, 8, "a"),
                                   (2021, 2, 1, 5, "a")]), path, KEYS, "race_year")
    src = _df(spark, [(2020, 1, 2, 9, "b"), (2020, 3, 1, 1, "b")])   # row (2020,1,1) absent
    sink.upsert(spark, src, path, KEYS, "race_year")
    once = _state(spark, path)
    assert once == {(2020, 1, 1): (10, "a"), (2020, 1, 2): (9, "b"), (2020, 3, 1): (1, "b"),
                    (2021, 2, 1): (5, "a")}
    sink.upsert(spark, src, path, KEYS, "race_year")
    assert _state(spark, path) == once


def test_upsert_rejects_duplicate_source_keys_and_foreign_partition(spark, tmp):
    path = os.path.join(tmp, "t")
    dup = _df(spark, [(2020, 1, 1, 1, "a"), (2020, 1, 1, 2, "b")])
    with pytest.raises(ValueError):
        sink.upsert(spark, dup, path, KEYS, "race_year")
    with pytest.raises(ValueError):
        sink.upsert(spark, dup, path, ["race_id"], "race_year")
    null_keys = _df(spark, [(2020, None, 1, 1, "a"), (2020, None, 1, 2, "b")])
    sink.upsert(spark, null_keys, path, KEYS, "race_year")
    assert spark.read.parquet(path).count() == 2


def test_upsert_null_keys_never_match(spark, tmp):
    path = os.path.join(tmp, "t")
    sink.upsert(spark, _df(spark, [(2020, None, 1, 1, "a")]), path, KEYS, "race_year",
                check_unique=False)
    sink.upsert(spark, _df(spark, [(2020, None, 1, 2, "b")]), path, KEYS, "race_year",
                check_unique=False)
    assert spark.read.parquet(path).count() == 2


def test_overwrite_partitions_keeps_untouched(spark, tmp):
    path = os.path.join(tmp, "t")
    sink.overwrite_parquet(_df(spark, [(2020, 1, 1, 1, "a"), (2021, 2, 1, 1, "a")]), path,
                           partition_by=["race_year"])
    sink.overwrite_partitions(_df(spark, [(2021, 2, 1, 7, "b")]), path, "race_year")
    assert _state(spark, path) == {(2020, 1, 1): (1, "a"), (2021, 2, 1): (7, "b")}


CALC = "race_year int, driver_id int, race_id int, position int, points int, " \
       "created_date timestamp_ntz, updated_date timestamp_ntz"


def test_selective_upsert(spark, tmp):
    path = os.path.join(tmp, "calc")
    keys = ["driver_id", "race_id", "race_year"]
    src1 = spark.createDataFrame([(2020, 1, 1, 1, 10), (2020, 2, 1, 2, 8)],
                                 "race_year int, driver_id int, race_id int, position int, points int")
    sink.selective_upsert(spark, src1, path, keys, ["position", "points"], "race_year", CALC,
                          stamp="2021-03-21 06:00:00")
    src2 = spark.createDataFrame([(2020, 1, 1, 1, 11), (2020, 3, 1, 3, 6)], src1.schema)
    sink.selective_upsert(spark, src2, path, keys, ["position", "points"], "race_year", CALC,
                          stamp="2021-03-28 06:00:00")
    rows = {r.driver_id: r for r in spark.read.parquet(path).collect()}
    assert rows[1].points == 11 and str(rows[1].created_date) == "2021-03-21 06:00:00"
    assert str(rows[1].updated_date) == "2021-03-28 06:00:00"
    assert rows[2].points == 8 and rows[2].updated_date is None
    assert str(rows[3].created_date) == "2021-03-28 06:00:00" and rows[3].updated_date is None


batch = st.lists(st.tuples(st.integers(2000, 2002), st.integers(0, 4), st.integers(0, 3),
                           st.integers(0, 9)), max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(batch, min_size=1, max_size=3))
def test_upsert_matches_dict_model(spark, tmp_path_factory, batches):
    path = str(tmp_path_factory.mktemp("prop") / "t")
    model = {}
    for b in batches:
        uniq = {}
        for y, r, d, p in b:
            uniq[(y, r, d)] = p
        rows = [(y, r, d, p, "x") for (y, r, d), p in uniq.items()]
        if not rows:
            continue
        sink.upsert(spark, _df(spark, rows), path, KEYS, "race_year")
        model.update(uniq)
    got = {k: v[0] for k, v in _state(spark, path).items()} if model else {}
    assert got == model


def test_upsert_table_creates_then_merges(spark, tmp):
    sink.create_database(spark, "paddock_t_merge", os.path.join(tmp, "db"))
    loc = os.path.join(tmp, "lake", "t")
    table = "paddock_t_merge.t"
    sink.upsert_table(spark, _df(spark, [(2020, 1, 1, 1, "a")]), table, loc, KEYS, "race_year")
    sink.upsert_table(spark, _df(spark, [(2020, 1, 1, 2, "b"), (2021, 2, 1, 3, "b")]), table,
                      loc, KEYS, "race_year")
    rows = {(r.race_year, r.race_id): r.points for r in spark.table(table).collect()}
    assert rows == {(2020, 1): 2, (2021, 2): 3}


def test_reset_databases_drops_tables(spark, tmp):
    loc = os.path.join(tmp, "db2")
    sink.create_database(spark, "paddock_t_reset", loc)
    sink.save_as_table(_df(spark, [(2020, 1, 1, 1, "a")]), "paddock_t_reset.x")
    assert spark.catalog.tableExists("paddock_t_reset.x")
    sink.reset_databases(spark, {"paddock_t_reset": loc})
    assert spark.catalog.databaseExists("paddock_t_reset")
    assert not spark.catalog.tableExists("paddock_t_reset.x")


def test_ctas_and_create_if_missing(spark, tmp):
    sink.create_database(spark, "paddock_t_ddl", os.path.join(tmp, "db3"))
    sink.ctas(spark, "paddock_t_ddl.c", _df(spark, [(2020, 1, 1, 1, "a")]))
    assert spark.table("paddock_t_ddl.c").count() == 1
    sink.create_table_if_missing(spark, "paddock_t_ddl.e", "a INT, race_year INT",
                                 partition_by=["race_year"])
    spark.sql("INSERT INTO paddock_t_ddl.e VALUES (1, 2020)")
    sink.create_table_if_missing(spark, "paddock_t_ddl.e", "a INT, race_year INT",
                                 partition_by=["race_year"])
    assert spark.table("paddock_t_ddl.e").count() == 1


def test_overwrite_table_partitions_keeps_session_static(spark, tmp):
    sink.create_database(spark, "paddock_t_parts", os.path.join(tmp, "db4"))
    table = "paddock_t_parts.t"
    sink.overwrite_table_partitions(spark, _df(spark, [(2020, 1, 1, 1, "a"), (2021, 2, 1, 1, "a")]),
                                    table, "race_year")
    sink.overwrite_table_partitions(spark, _df(spark, [(2021, 2, 1, 7, "b")]), table, "race_year")
    rows = {(r.race_year, r.race_id): r.points for r in spark.table(table).collect()}
    assert rows == {(2020, 1): 1, (2021, 2): 7}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


SCHEMA2 = "race_year int, race_bucket int, race_id int, driver_id int, points int"
KEYS2 = ["race_id", "driver_id", "race_year", "race_bucket"]


@settings(max_examples=6, deadline=None)
@given(st.lists(batch, min_size=1, max_size=3))
def test_upsert_two_partition_columns_matches_dict_model(spark, tmp_path_factory, batches):
    path = str(tmp_path_factory.mktemp("prop2") / "t")
    model = {}
    for b in batches:
        uniq = {(y, r % 3, r, d): p for y, r, d, p in b}
        if not uniq:
            continue
        rows = [(y, bk, r, d, p) for (y, bk, r, d), p in uniq.items()]
        sink.upsert(spark, spark.createDataFrame(rows, SCHEMA2), path, KEYS2,
                    ["race_year", "race_bucket"])
        model.update(uniq)
    if model:
        got = {(r.race_year, r.race_bucket, r.race_id, r.driver_id): r.points
               for r in spark.read.parquet(path).collect()}
        assert got == model


def test_two_column_partition_filter(spark, tmp):
    from paddock.sinks.writes import overwrite_parquet, upsert_frame
    path = os.path.join(tmp, "t2")
    base = spark.range(0, 700).selectExpr("CAST(id % 7 AS INT) AS race_year",
                                          "CAST(id % 4 AS INT) AS race_bucket",
                                          "id AS race_id", "id AS v")
    overwrite_parquet(base, path, partition_by=["race_year", "race_bucket"])
    src = spark.createDataFrame([(3, 1, 101, 99)],
                                "race_year int, race_bucket int, race_id bigint, v bigint")
    merged = upsert_frame(spark, src, path, ["race_id", "race_year", "race_bucket"],
                          ["race_year", "race_bucket"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "race_bucket" in plan
    assert merged.count() == base.filter("race_year = 3 AND race_bucket = 1").count()


def test_merge_keeps_null_partition_rows(spark, tmp):
    from paddock.sinks.writes import touched_partitions
    path = os.path.join(tmp, "t3")
    base = _df(spark, [(None, 1, 1, 1, "a"), (None, 2, 1, 1, "a"), (2021, 3, 1, 1, "a")])
    sink.overwrite_parquet(base, path, partition_by=["race_year"])
    target = spark.read.parquet(path)
    src = _df(spark, [(None, 1, 1, 5, "b")])
    two = touched_partitions(target.withColumn("b", F.lit(1)), ["race_year", "b"], [(None, 1)])
    assert two.count() == 2
    sink.upsert(spark, src, path, KEYS, "race_year")
    got = sorted((r.race_id, r.points) for r in spark.read.parquet(path).collect())
    # NULL keys never match (as in MERGE): the row is inserted, and no other row of the
    # NULL partition is lost by the partition rewrite
    assert got == [(1, 1), (1, 5), (2, 1), (3, 1)]


def _rows(spark, path):
    return sorted((r.race_year is None, r.race_year or 0, r.race_id, r.points)
                  for r in spark.read.parquet(path).collect())


def test_rows_move_to_another_partition_and_empty_folders_go(spark, tmp):
    path = os.path.join(tmp, "moved")
    keys = ["race_id", "driver_id"]
    touched = []
    sink.upsert(spark, _df(spark, [(None, 9, 1, 1, "a"), (2020, 1, 1, 1, "a"), (2020, 2, 1, 2, "a"),
                                   (2019, 5, 1, 5, "a")]), path, keys, "race_year")
    # the race of the first row is known now; race 1 moved; all of 2019 moved
    sink.upsert(spark, _df(spark, [(2021, 9, 1, 3, "b"), (2022, 1, 1, 4, "b"), (2020, 5, 1, 6, "b")]),
                path, keys, "race_year", touched=touched)
    assert _rows(spark, path) == [(False, 2020, 2, 2), (False, 2020, 5, 6), (False, 2021, 9, 3),
                                   (False, 2022, 1, 4)]
    assert sorted(touched, key=str) == sorted([(2021,), (2022,), (2020,), (None,), (2019,)], key=str)
    assert not any("2019" in d or "DEFAULT" in d for d in os.listdir(path))
    # the same delivery again changes nothing
    sink.upsert(spark, _df(spark, [(2021, 9, 1, 3, "b"), (2022, 1, 1, 4, "b"), (2020, 5, 1, 6, "b")]),
                path, keys, "race_year")
    assert len(_rows(spark, path)) == 4


def test_source_takes_the_targets_types(spark, tmp):
    path = os.path.join(tmp, "types")
    base = _df(spark, [(2020, 1, 1, 7, "a")])
    sink.upsert(spark, base, path, KEYS, "race_year")
    wide = base.withColumn("points", F.lit(8).cast("decimal(20,0)"))
    sink.upsert(spark, wide, path, KEYS, "race_year")
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["points"] == dict(base.dtypes)["points"]
    assert [r.points for r in stored.collect()] == [8]
    with pytest.raises(Exception, match="does not fit"):
        sink.upsert(spark, base.withColumn("points", F.lit("nine")), path, KEYS, "race_year")
    assert [r.points for r in spark.read.parquet(path).collect()] == [8]


def test_replaced_partitions_of_dates_and_quoted_strings(spark, tmp):
    for kind, values in (("date", ["2021-03-21", "2021-03-28"]), ("string", ["it's", 'a "b"'])):
        db = f"parts_{kind}"
        sink.create_database(spark, db, os.path.join(tmp, db))
        df = (spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, p string")
              .withColumn("p", F.col("p").cast(kind)))
        sink.save_as_table(df, f"{db}.t", partition_by=["p"])
        new = (spark.createDataFrame([(10, values[1])], "n int, p string")
               .withColumn("p", F.col("p").cast(kind)))
        sink.drop_partitions_and_append(spark, new, f"{db}.t", "p")
        assert sorted(r.n for r in spark.table(f"{db}.t").collect()) == [0, 10]
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_inspect_source_reports_duplicates_and_values(spark):
    from paddock.sinks.writes import inspect_source
    src = _df(spark, [(2020, 1, 1, 1, "a"), (2021, 2, 1, 1, "a")])
    assert sorted(inspect_source(src, KEYS, "race_year")) == [(2020,), (2021,)]
    dup = _df(spark, [(2020, 1, 1, 1, "a"), (2020, 1, 1, 2, "a")])
    with pytest.raises(ValueError):
        inspect_source(dup, KEYS, "race_year")


def test_partitioned_write_plan_rebalances_or_not(spark, tmp):
    from paddock.sinks.writes import _clustered
    df = _df(spark, [(2020, 1, 1, 1, "a"), (2021, 2, 1, 1, "a")])
    on = _clustered(df, ["race_year"], ["race_id"])._jdf.queryExecution().executedPlan()
    off = _clustered(df, ["race_year"], ["race_id"], rebalance=False)._jdf.queryExecution()
    assert "REBALANCE_PARTITIONS_BY_COL" in on.toString()
    assert "Exchange" not in off.executedPlan().toString()
    path = os.path.join(tmp, "nr")
    sink.overwrite_parquet(df, path, partition_by=["race_year"], rebalance=False)
    assert spark.read.parquet(path).count() == 2


def test_upsert_refuses_unknown_source_columns(spark, tmp):
    path = os.path.join(tmp, "t4")
    sink.upsert(spark, _df(spark, [(2020, 1, 1, 1, "a")]), path, KEYS, "race_year")
    wider = _df(spark, [(2020, 1, 1, 2, "b")]).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError):
        sink.upsert(spark, wider, path, KEYS, "race_year")


def test_first_load_is_checked_before_it_is_there(spark, tmp):
    path = os.path.join(tmp, "t")
    rows = [(2020, 1, 1, 1, "a"), (2021, 2, 1, 2, "b"), (None, 3, 1, 3, "c")]
    with pytest.raises(ValueError):
        sink.upsert(spark, _df(spark, rows + rows[:1]), path, KEYS[:2], "race_year")
    assert os.listdir(tmp) == []            # neither a dataset nor what was checked
    touched = []
    sink.upsert(spark, _df(spark, rows), path, KEYS[:2], "race_year", touched=touched)
    assert sorted(touched, key=str) == [(2020,), (2021,), (None,)] and os.listdir(tmp) == ["t"]
    sink.upsert(spark, _df(spark, []), os.path.join(tmp, "none"), KEYS[:2], "race_year")
    sink.upsert(spark, _df(spark, rows), os.path.join(tmp, "none"), KEYS[:2], "race_year")
    assert _state(spark, os.path.join(tmp, "none")) == _state(spark, path)


def test_loads_and_merges_are_not_dealt_out_by_season(spark, tmp, monkeypatch):
    asked = []
    plain = sink._clustered
    monkeypatch.setattr(sink, "_clustered", lambda df, parts, cluster_by=(), rebalance=True:
                        asked.append(rebalance) or plain(df, parts, cluster_by, rebalance))
    rows = [(2020, 1, 1, 1, "a"), (2021, 2, 1, 2, "b")]
    for name in ("a", "b"):
        for _ in range(2):
            sink.upsert(spark, _df(spark, rows), os.path.join(tmp, name), KEYS, "race_year", check_unique=name == "a")
            sink.selective_upsert(spark, _df(spark, rows).drop("tag"), os.path.join(tmp, f"s{name}"), KEYS, ["points"],
                                  "race_year", SCHEMA + ", created_date timestamp_ntz, updated_date timestamp_ntz")
    assert asked == [False] * 8


def test_rows_that_moved_are_sought_outside_the_written_partitions(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "t")
    first = [(2020, 1, 1, 1, "a"), (2020, 2, 1, 2, "a"), (2021, 3, 1, 3, "a"), (None, 4, 1, 4, "a"), (2022, 5, 1, 5, "a")]
    keys = ["race_id", "driver_id"]
    sink.upsert(spark, _df(spark, first), path, keys, "race_year")
    searched, plain = [], sink.matching_partitions
    monkeypatch.setattr(sink, "matching_partitions", lambda target, *a: searched.append(
        sorted({str(r.race_year) for r in target.collect()})) or plain(target, *a))
    sink.upsert(spark, _df(spark, [(2021, 1, 1, 9, "b"), (2021, 4, 1, 9, "b")]), path, keys, "race_year")
    assert searched == [["2020", "2022", "None"]]
    assert _state(spark, path) == {(2021, 1, 1): (9, "b"), (2020, 2, 1): (2, "a"), (2021, 3, 1): (3, "a"),
                                   (2021, 4, 1): (9, "b"), (2022, 5, 1): (5, "a")}
    sink.upsert(spark, _df(spark, [(None, 5, 1, 7, "c")]), path, keys, "race_year")
    assert searched[1] == ["2020", "2021"] or searched[1] == ["2020", "2021", "2022"]
    assert (None, 5, 1) in _state(spark, path) and (2022, 5, 1) not in _state(spark, path)


def test_written_tables_are_packed_and_leave_no_shuffle_files(spark, tmp):
    import glob
    from paddock.session import FREE_SHUFFLES
    before = spark.conf.get(FREE_SHUFFLES, "false")
    df = spark.range(100).selectExpr("id", "CAST(id % 3 AS INT) AS race_year").groupBy("race_year", "id").count()
    sink.overwrite_parquet(df, f"{tmp}/a", partition_by=["race_year"], rebalance=False)
    sink.overwrite_partitions(df, f"{tmp}/b", "race_year")
    assert glob.glob(f"{tmp}/a/*/*.zstd.parquet") and glob.glob(f"{tmp}/b/*/*.zstd.parquet")
    assert spark.conf.get(FREE_SHUFFLES, "false") == before
    with pytest.raises(Exception):
        sink.overwrite_parquet(df.withColumn("id", F.raise_error(F.lit("no"))), f"{tmp}/c")
    assert spark.conf.get(FREE_SHUFFLES, "false") == before


def test_shared_keys_rule_partitions_out_before_the_keys_are_sought(spark, tmp):
    path = os.path.join(tmp, "t")
    keys = ["race_id", "driver_id"]
    first = [(2020, 1, 1, 1, "a"), (2020, 2, 1, 2, "a"), (2021, 3, 1, 3, "a"), (None, 4, 1, 4, "a"),
             (2022, None, 1, 5, "a"), (2023, 6, 2, 6, "a")]
    sink.upsert(spark, _df(spark, first), path, keys, "race_year")
    target = sink.read_or_empty(spark, path)
    for rows in ([(2021, 1, 1, 9, "b"), (2021, 4, 1, 9, "b")], [(2024, 6, 1, 9, "b"), (2024, None, 1, 9, "b")],
                 [(2024, 7, 1, 9, "b")], [(2024, 6, 2, 9, "b"), (2024, 6, 2, 9, "b")]):
        source = _df(spark, rows)
        assert (sink.matching_partitions(target, source, keys, "race_year", moved_by=["race_id"])
                == sink.matching_partitions(target, source, keys, "race_year"))
    moved = _df(spark, [(2021, 1, 1, 9, "b"), (2021, 4, 1, 9, "b"), (2024, 6, 1, 7, "b")])
    sink.upsert(spark, moved, path, keys, "race_year", moved_by=["race_id"])
    assert _state(spark, path) == {(2021, 1, 1): (9, "b"), (2020, 2, 1): (2, "a"), (2021, 3, 1): (3, "a"),
                                   (2021, 4, 1): (9, "b"), (2022, None, 1): (5, "a"), (2023, 6, 2): (6, "a"),
                                   (2024, 6, 1): (7, "b")}


def test_keys_are_not_sought_where_no_shared_key_is(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "t")
    sink.upsert(spark, _df(spark, [(2020, 1, 1, 1, "a")]), path, ["race_id", "driver_id"], "race_year")
    target, searched, plain = sink.read_or_empty(spark, path), [], sink.touched_partitions
    monkeypatch.setattr(sink, "touched_partitions", lambda *a: searched.append(a[2]) or plain(*a))
    for race, found in ((2, {}), (1, {(2020,): 1})):
        assert sink.matching_partitions(target, _df(spark, [(2021, race, 1, 9, "b")]), ["race_id", "driver_id"],
                                        "race_year", moved_by=["race_id"]) == found
    assert searched == [[(2020,)]]


def test_written_pages_hold_differences(spark, tmp):
    import glob
    import pyarrow.parquet as pq
    df = spark.range(0, 300_000, 1, 1).selectExpr("id * 1000003 AS id", "CAST(id % 2 AS INT) AS race_year")
    sink.overwrite_parquet(df, f"{tmp}/a", partition_by=["race_year"], rebalance=False)
    sink.overwrite_partitions(df, f"{tmp}/b", "race_year", rebalance=False)
    sink.stage(spark, df, f"{tmp}/c")
    files = [glob.glob(f"{tmp}/{x}/*/*.parquet") for x in "ab"] + [glob.glob(f"{sink._stage_dir(spark, f'{tmp}/c')}/*.parquet")]
    for found in files:
        assert "DELTA_BINARY_PACKED" in pq.ParquetFile(found[0]).metadata.row_group(0).column(0).encodings
    assert spark.read.parquet(f"{tmp}/a").count() == spark.read.parquet(f"{tmp}/b").count() == 300_000


def test_kept_frames_go_with_their_end(spark, tmp):
    df = spark.range(3)
    with pytest.raises(ValueError), sink.kept(spark, f"{tmp}/x") as keep:
        a, b = keep("a", df), keep("b", df.filter("id > 0"))
        assert (a.count(), b.count()) == (3, 2)
        raise ValueError
    assert not any(os.path.exists(sink._stage_dir(spark, f"{tmp}/x/{n}")) for n in "ab")
