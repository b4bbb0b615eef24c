import json
import os

from paddock.schemas import RAW_SCHEMAS
from paddock.sources import feeds


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_permissive_nulls(spark, tmp):
    p = os.path.join(tmp, "races.csv")
    _write(p, "raceId,year,round,circuitId,name,date,time,url\n"
              "1,2009,1,1,A GP,2009-03-29,06:00:00,u\n"
              "2,\\N,2,\\N,B GP,2009-04-05,\\N,u\n")
    rows = feeds.read_csv(spark, p, RAW_SCHEMAS["races"]).orderBy("raceId").collect()
    assert rows[0].year == 2009 and rows[1].year is None and rows[1].circuitId is None
    assert rows[1].time == "\\N"


def test_json_lines_permissive_nulls_keep_other_fields(spark, tmp):
    p = os.path.join(tmp, "results.json")
    _write(p, json.dumps({"resultId": 1, "raceId": 5, "points": 8.5, "position": "\\N"}) + "\n")
    r = feeds.read_json(spark, p, RAW_SCHEMAS["results"]).collect()[0]
    assert r.position is None and r.raceId == 5 and r.points == 8.5


def test_nested_json_struct(spark, tmp):
    p = os.path.join(tmp, "drivers.json")
    _write(p, json.dumps({"driverId": 1, "name": {"forename": "Ann", "surname": "Lee"}}) + "\n")
    r = feeds.read_json(spark, p, RAW_SCHEMAS["drivers"]).collect()[0]
    assert r.name.forename == "Ann" and r.name.surname == "Lee"


def test_multiline_json_folder(spark, tmp):
    d = os.path.join(tmp, "qualifying")
    for i in range(3):
        rows = [{"qualifyId": i * 10 + j, "raceId": i, "driverId": j} for j in range(2)]
        _write(os.path.join(d, f"q_{i}.json"), json.dumps(rows, indent=2))
    df = feeds.read_json(spark, d, RAW_SCHEMAS["qualifying"], multiline=True)
    assert df.count() == 6


def test_headerless_csv_folder(spark, tmp):
    d = os.path.join(tmp, "lap_times")
    _write(os.path.join(d, "a.csv"), "1,1,1,1,1:30.1,90100\n1,1,2,1,1:31.0,91000\n")
    _write(os.path.join(d, "b.csv"), "1,2,1,2,1:32.0,92000\n")
    df = feeds.read_csv(spark, d, RAW_SCHEMAS["lap_times"], header=False)
    assert df.count() == 3 and df.agg({"milliseconds": "sum"}).collect()[0][0] == 273100


def test_dated_path_reads_one_folder_only(spark, tmp):
    for d, n in [("2021-03-21", 2), ("2021-03-28", 1)]:
        lines = "".join(json.dumps({"resultId": i, "raceId": i}) + "\n" for i in range(n))
        _write(os.path.join(tmp, d, "results.json"), lines)
    assert feeds.read_feed(spark, tmp, "results", "2021-03-28").count() == 1
    assert feeds.dated_path(tmp, "2021-03-21", "lap_times").endswith("2021-03-21/lap_times")
