"""The streaming delivery load: each delivery folder is merged once, in date
order, and a restart with a new folder only merges the new one."""

import json
import os

from paddock.plans.ingest import ingest
from paddock.streaming.deliveries import ingest_deliveries


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _results(folder, rows):
    _write(os.path.join(folder, "results.json", "part-0.json"),
           "".join(json.dumps(r) + "\n" for r in rows))


def test_stream_merges_each_delivery_once_in_order(spark, tmp):
    raw = os.path.join(tmp, "raw")
    proc = os.path.join(tmp, "processed")
    _write(os.path.join(raw, "2021-03-21", "races.csv", "p.csv"),
           "raceId,year,round,circuitId,name,date,time,url\n"
           "1,2020,1,1,R1,2020-03-01,10:00:00,u\n2,2021,1,1,R2,2021-03-01,10:00:00,u\n")
    ingest(spark, raw, proc, "races", "t", "2021-03-21", incremental=True)
    r = dict(resultId=1, raceId=1, driverId=1, constructorId=1, position=1, points=10)
    _results(os.path.join(raw, "2021-03-21"), [r, {**r, "resultId": 2, "driverId": 2}])
    _results(os.path.join(raw, "2021-03-28"), [{**r, "points": 12}])     # correction
    ckpt = os.path.join(tmp, "_ckpt")
    ingest_deliveries(spark, raw, proc, "results", ckpt, "t")
    out = {x.result_id: (x.points, x.file_date, x.race_year)
           for x in spark.read.parquet(os.path.join(proc, "results")).collect()}
    assert out == {1: (12.0, "2021-03-28", 2020), 2: (10.0, "2021-03-21", 2020)}
    # a restart with one more delivery merges only that one
    _results(os.path.join(raw, "2021-04-18"), [{**r, "resultId": 3, "raceId": 2}])
    ingest_deliveries(spark, raw, proc, "results", ckpt, "t")
    out = {x.result_id: (x.points, x.file_date)
           for x in spark.read.parquet(os.path.join(proc, "results")).collect()}
    assert out == {1: (12.0, "2021-03-28"), 2: (10.0, "2021-03-21"), 3: (10.0, "2021-04-18")}
