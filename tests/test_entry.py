"""Driver contract: entry() runs on sf0.001, every query has an oracle, and a
sample of queries matches its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

SAMPLE = ["race_results", "calculated_results", "driver_standings", "top10_drivers",
          "dominant_drivers_by_year", "dedupe_by_key", "profile_describe", "scan_json_lines",
          "upsert_merge", "partition_overwrite", "upsert_selective", "ingest_results_incremental",
          "stream_results_incremental", "full_load_driver_standings", "scan_json_multiline",
          "partition_overwrite_table"]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["race_year", "driver_name", "total_races", "total_points", "avg_points"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    from paddock.plans.registry import QUERIES
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_parity_small(spark, name):
    import __spark_entry__ as e
    sys_path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools")
    import sys
    sys.path.insert(0, sys_path)
    from compare import canon
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                    f"read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    got = canon(e.queries()[name](spark, SF_SMALL).toPandas())
    want = canon(con.sql(e.oracle_sql()[name]).df())
    assert got == want
