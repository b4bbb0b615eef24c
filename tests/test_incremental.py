"""Three delivery batches through the real ingestion and presentation jobs:
a cutover batch, one race per later batch, and a re-delivery of batch 2 with
one changed points value and one row absent (FIXTURES.md §3.1)."""

import json
import os

from pyspark.sql import functions as F

from paddock.operators.standings import driver_standings
from paddock.plans.incremental import run_history

DATES = ["2021-03-21", "2021-03-28", "2021-04-18"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _jsonl(rows):
    return "".join(json.dumps(r) + "\n" for r in rows)


def _result(rid, race, drv, con, pos, pts):
    return {"resultId": rid, "raceId": race, "driverId": drv, "constructorId": con,
            "position": pos, "points": pts, "grid": pos, "fastestLap": 1, "time": "1:00"}


def _raw(root):
    batches = {
        DATES[0]: [_result(1, 1, 1, 1, 1, 10), _result(2, 1, 2, 2, 2, 8.5),
                   _result(3, 2, 1, 1, 2, 8), _result(4, 2, 2, 2, 1, 10),
                   _result(5, 2, 3, 2, 3, 6)],
        DATES[1]: [_result(6, 3, 1, 1, 1, 10), _result(7, 3, 2, 2, 2, 8)],
        # re-delivery of race 3: driver 2's points corrected, driver 1 absent; plus race 4
        DATES[2]: [_result(7, 3, 2, 2, 2, 9), _result(8, 4, 3, 2, 1, 10)],
    }
    for d, rows in batches.items():
        f = os.path.join(root, d)
        _write(os.path.join(f, "circuits.csv", "part-0.csv"),
               "circuitId,circuitRef,name,location,country,lat,lng,alt,url\n"
               "1,c1,C1,Loc1,X,1.0,2.0,3,u\n")
        _write(os.path.join(f, "races.csv", "part-0.csv"),
               "raceId,year,round,circuitId,name,date,time,url\n"
               "1,2020,1,1,R1,2020-03-01,10:00:00,u\n2,2020,2,1,R2,2020-04-01,\\N,u\n"
               "3,2021,1,1,R3,2021-03-01,10:00:00,u\n4,2021,2,1,R4,2021-04-11,10:00:00,u\n")
        _write(os.path.join(f, "constructors.json", "part-0.json"), _jsonl(
            [{"constructorId": 1, "name": "T1"}, {"constructorId": 2, "name": "T2"}]))
        _write(os.path.join(f, "drivers.json", "part-0.json"), _jsonl(
            [{"driverId": 1, "number": 44, "name": {"forename": "Ann", "surname": "Lee"},
              "nationality": "X"},
             {"driverId": 2, "number": 5, "name": {"forename": "Bo", "surname": "Ng"},
              "nationality": "Y"},
             {"driverId": 3, "number": 7, "name": {"forename": None, "surname": "Roe"},
              "nationality": "Z"}]))
        _write(os.path.join(f, "results.json", "part-0.json"), _jsonl(rows))


def test_three_batch_history(spark, tmp):
    raw = os.path.join(tmp, "raw")
    _raw(raw)
    layers = run_history(spark, raw, os.path.join(tmp, "lake"), DATES, "test",
                         [f"{d} 06:00:00" for d in DATES], top_n=10,
                         feeds=["circuits", "races", "constructors", "drivers", "results"])
    pres = layers["presentation"]
    rr = spark.read.parquet(os.path.join(pres, "race_results"))
    race3 = {r.driver_name: (r.points, r.file_date) for r in rr.filter("race_id = 3").collect()}
    # corrected row updated, absent row kept from its original batch
    assert race3 == {"Bo Ng": (9.0, DATES[2]), "Ann Lee": (10.0, DATES[1])}
    # NULL forename gives a NULL name; the row is still loaded
    assert rr.filter("race_id = 4").collect()[0].driver_name is None
    # race without start time keeps a NULL timestamp
    assert rr.filter("race_id = 2").select("race_date").distinct().collect()[0][0] is None
    # incremental standings equal a full recompute over the final race results
    inc = spark.read.parquet(os.path.join(pres, "driver_standings"))
    full = driver_standings(rr, with_team=False)
    cols = ["race_year", "driver_name", "driver_nationality", "total_points", "wins", "rank"]
    assert sorted(inc.select(cols).collect(), key=str) == \
        sorted(full.select(cols).collect(), key=str)
    # half points kept as FLOAT in results, truncated by the INT column of scored results
    calc = spark.read.parquet(os.path.join(pres, "calculated_race_results"))
    r = calc.filter("race_id = 1 AND driver_id = 2").collect()[0]
    assert r.points == 8 and r.calculated_points == 9
    r3 = calc.filter("race_id = 3 AND driver_id = 2").collect()[0]
    assert r3.points == 9 and str(r3.created_date) == f"{DATES[1]} 06:00:00"
    assert str(r3.updated_date) == f"{DATES[2]} 06:00:00"
    # processed results: one row per (race, driver), latest delivery wins
    res = spark.read.parquet(os.path.join(layers["processed"], "results"))
    assert res.count() == 8
    assert res.filter("result_id = 7").collect()[0].file_date == DATES[2]
    # the load profile per batch
    prof = {r.file_date: r.n for r in res.groupBy("file_date").agg(F.count("*").alias("n"))
            .collect()}
    assert prof == {DATES[0]: 5, DATES[1]: 1, DATES[2]: 2}


# --- property: incremental standings after random batches = full recompute --------------

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from paddock.operators.standings import constructor_standings  # noqa: E402
from paddock.plans.presentation import standings_incremental  # noqa: E402
from paddock.sinks.writes import upsert  # noqa: E402

RR_SCHEMA = ("race_id bigint, race_year int, driver_name string, driver_nationality string, "
             "team string, points float, position int, file_date string")
result_row = st.tuples(st.integers(1, 6), st.integers(0, 4), st.integers(0, 10),
                       st.integers(1, 4))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(result_row, min_size=1, max_size=8), min_size=1, max_size=3))
def test_incremental_standings_equal_full_recompute(spark, tmp_path_factory, batches):
    root = str(tmp_path_factory.mktemp("inc"))
    rr_path = os.path.join(root, "race_results")
    for i, batch in enumerate(batches):
        d = f"2021-0{i + 1}-01"
        rows = {}
        for race, drv, pts, pos in batch:  # one row per (driver, race) in a batch
            rows[(race, drv)] = (race, 2000 + race % 3, f"d{drv}", "x", f"t{drv % 2}",
                                 float(pts), pos, d)
        df = spark.createDataFrame(list(rows.values()), RR_SCHEMA)
        upsert(spark, df, rr_path, ["driver_name", "race_id", "race_year"], "race_year")
        standings_incremental(spark, root, d, "driver")
        standings_incremental(spark, root, d, "constructor")
    rr = spark.read.parquet(rr_path)
    cols = ["race_year", "driver_name", "driver_nationality", "total_points", "wins", "rank"]
    inc = spark.read.parquet(os.path.join(root, "driver_standings")).select(cols).collect()
    full = driver_standings(rr, with_team=False).select(cols).collect()
    assert sorted(inc, key=str) == sorted(full, key=str)
    ccols = ["race_year", "team", "total_points", "wins", "rank"]
    cinc = spark.read.parquet(os.path.join(root, "constructor_standings")).select(ccols).collect()
    cfull = constructor_standings(rr).select(ccols).collect()
    assert sorted(cinc, key=str) == sorted(cfull, key=str)


def _rr_batch(spark, rows, d):
    return spark.createDataFrame([(*r, d) for r in rows], RR_SCHEMA)


def _files(path):
    out = {}
    for base, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(base, n)
                out[p] = os.path.getmtime(p)
    return out


def test_late_correction_rewrites_only_its_season(spark, tmp):
    rr_path = os.path.join(tmp, "race_results")
    keys = ["driver_name", "race_id", "race_year"]
    b1 = [(1, 2020, "A", "x", "T", 10.0, 1), (2, 2021, "A", "x", "T", 8.0, 2),
          (2, 2021, "B", "y", "U", 10.0, 1)]
    upsert(spark, _rr_batch(spark, b1, "d1"), rr_path, keys, "race_year")
    standings_incremental(spark, tmp, "d1", "driver")
    st_path = os.path.join(tmp, "driver_standings")
    before = _files(st_path)
    # correction of the 2021 race only
    upsert(spark, _rr_batch(spark, [(2, 2021, "A", "x", "T", 12.0, 1)], "d2"), rr_path, keys,
           "race_year")
    standings_incremental(spark, tmp, "d2", "driver")
    after = _files(st_path)
    untouched = {p: t for p, t in before.items() if "race_year=2020" in p}
    assert untouched and all(after.get(p) == t for p, t in untouched.items())
    rows = {(r.race_year, r.driver_name): (r.total_points, r.wins, r.rank)
            for r in spark.read.parquet(st_path).collect()}
    assert rows[(2021, "A")] == (12.0, 1, 1) and rows[(2021, "B")] == (10.0, 1, 2)
    assert rows[(2020, "A")] == (10.0, 1, 1)


def test_name_collisions(spark, tmp):
    rr_path = os.path.join(tmp, "race_results")
    keys = ["driver_name", "race_id", "race_year"]
    # two drivers named "A" with one nationality collapse into one standing (name is the key)
    same = [(1, 2020, "A", "x", "T", 10.0, 1), (2, 2020, "A", "x", "U", 1.0, 2)]
    upsert(spark, _rr_batch(spark, same, "d1"), rr_path, keys, "race_year")
    standings_incremental(spark, tmp, "d1", "driver")
    got = spark.read.parquet(os.path.join(tmp, "driver_standings")).collect()
    assert [(r.driver_name, r.total_points, r.wins) for r in got] == [("A", 11.0, 1)]
    # same name, different nationality: two source rows for one merge key -> refused
    other = os.path.join(tmp, "o")
    clash = [(1, 2020, "A", "x", "T", 10.0, 1), (2, 2020, "A", "y", "U", 4.0, 2)]
    upsert(spark, _rr_batch(spark, clash, "d1"), os.path.join(other, "race_results"), keys,
           "race_year")
    import pytest
    with pytest.raises(ValueError):
        standings_incremental(spark, other, "d1", "driver")


def test_history_registers_tables(spark, tmp):
    raw = os.path.join(tmp, "raw")
    _raw(raw)
    run_history(spark, raw, os.path.join(tmp, "lake"), DATES[:2], "test",
                [f"{d} 06:00:00" for d in DATES[:2]], top_n=10,
                feeds=["circuits", "races", "constructors", "drivers", "results"],
                processed_db="paddock_t_proc", presentation_db="paddock_t_pres")
    assert spark.table("paddock_t_proc.results").count() == 7
    assert spark.table("paddock_t_pres.race_results").count() == 7
    assert spark.table("paddock_t_pres.driver_standings").filter("race_year = 2021").count() == 2


def test_batch_steps_read_only_the_delivery_partitions(spark, tmp):
    from paddock.plans.incremental import delivery_partitions
    from paddock.plans.presentation import race_results_batch
    raw = os.path.join(tmp, "raw")
    _raw(raw)
    layers = run_history(spark, raw, os.path.join(tmp, "lake"), DATES, "test",
                         [f"{d} 06:00:00" for d in DATES], top_n=10,
                         feeds=["circuits", "races", "constructors", "drivers", "results"],
                         presentation=())
    parts = delivery_partitions(spark, raw, layers["processed"], DATES[2])
    assert parts == [(2021,)]
    df = race_results_batch(spark, layers["processed"], DATES[2], partitions=parts)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "race_year" in plan and "PartitionFilters: [isnotnull(race_year" in plan
    assert df.count() == 2


def test_command_line_incremental(spark, tmp):
    from paddock.__main__ import main
    raw = os.path.join(tmp, "raw")
    _raw(raw)
    # the raw folders hold only the feeds the presentation needs
    main(["incremental", "--raw", raw, "--root", os.path.join(tmp, "lake"), "--dates", *DATES,
          "--buckets", "2", "--feeds", "circuits", "races", "constructors", "drivers", "results"])
    rr = spark.read.parquet(os.path.join(tmp, "lake", "presentation", "race_results"))
    assert rr.count() == 8 and "race_bucket" in rr.columns


def test_standings_replace_mode_equals_merge(spark, tmp):
    rr_path = os.path.join(tmp, "race_results")
    keys = ["driver_name", "race_id", "race_year"]
    batches = [[(1, 2020, "A", "x", "T", 10.0, 1), (2, 2021, "B", "y", "U", 8.0, 1)],
               [(2, 2021, "B", "y", "U", 9.0, 1), (3, 2021, "A", "x", "T", 4.0, 2)]]
    for i, rows in enumerate(batches):
        d = f"d{i}"
        upsert(spark, _rr_batch(spark, rows, d), rr_path, keys, "race_year")
        for root, mode in ((tmp, "merge"), (os.path.join(tmp, "rep"), "replace")):
            if root != tmp:
                os.makedirs(root, exist_ok=True)
                if not os.path.exists(os.path.join(root, "race_results")):
                    os.symlink(rr_path, os.path.join(root, "race_results"))
            standings_incremental(spark, root, d, "driver", mode=mode)
    cols = ["race_year", "driver_name", "total_points", "wins", "rank"]
    a = spark.read.parquet(os.path.join(tmp, "driver_standings")).select(cols).collect()
    b = spark.read.parquet(os.path.join(tmp, "rep", "driver_standings")).select(cols).collect()
    assert sorted(a, key=str) == sorted(b, key=str) and len(a) == 3


def test_one_race_delivery_rewrites_one_bucket(spark, tmp):
    """With the default layout a delivery of one race replaces the files of its (season,
    bucket) folder only."""
    from paddock.plans.ingest import DEFAULT_BUCKETS, with_bucket
    assert DEFAULT_BUCKETS > 1
    path = os.path.join(tmp, "bucketed")
    schema = "race_year int, race_id long, driver_id long, points int"
    keys, parts = ["race_id", "driver_id"], ["race_year", "race_bucket"]
    base = spark.createDataFrame([(2020, r, d, 1) for r in range(16) for d in range(3)], schema)
    upsert(spark, with_bucket(base, DEFAULT_BUCKETS), path, keys, parts)

    def files():
        return {os.path.join(a, f) for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    one = spark.createDataFrame([(2020, 5, d, 2) for d in range(3)], schema)
    upsert(spark, with_bucket(one, DEFAULT_BUCKETS), path, keys, parts, located_by=["race_bucket"])
    changed = before ^ files()
    assert changed and all(f"race_bucket={5 % DEFAULT_BUCKETS}/" in f for f in changed)
    assert spark.read.parquet(path).filter("points = 2").count() == 3


def test_standings_follow_a_race_to_its_new_season(spark, tmp):
    """A race dated to another season: one row each, and both seasons' standings are right."""
    raw = os.path.join(tmp, "raw")
    _raw(raw)
    feeds = ["circuits", "races", "constructors", "drivers", "results"]
    layers = run_history(spark, raw, os.path.join(tmp, "lake"), DATES, "test",
                         [f"{d} 06:00:00" for d in DATES], top_n=10, feeds=feeds,
                         standings_mode="replace")
    res = spark.read.parquet(os.path.join(layers["processed"], "results"))
    rr = spark.read.parquet(os.path.join(layers["presentation"], "race_results"))
    assert res.groupBy("race_id", "driver_id").count().filter("count > 1").count() == 0
    inc = spark.read.parquet(os.path.join(layers["presentation"], "driver_standings"))
    full = driver_standings(rr, with_team=False)
    cols = ["race_year", "driver_name", "total_points", "wins", "rank"]
    assert sorted(inc.select(cols).collect(), key=str) == sorted(full.select(cols).collect(), key=str)
