"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the test tables under ``sf_dir`` with the library's operators.

Names follow the operator inventory; oracles are in ``paddock.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.conform import audit_duplicate_keys, dedupe_by_key
from paddock.operators import dominance as dom
from paddock.operators import profile
from paddock.operators.standings import (affected_periods, constructor_standings,
                                         driver_standings, rows_of_periods)
from paddock.operators.star import calculated_results, race_circuits, race_results
from paddock.plans import testbed as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs ----------------------------------------------------------

def _star(spark, sf_dir):
    t = tb.processed(spark, sf_dir)
    return t["results"], t["races"], t["circuits"], t["drivers"], t["constructors"]


def _race_results(spark, sf_dir):
    return race_results(*_star(spark, sf_dir), load_ts=tb.LOAD_TS)


def _calc(spark, sf_dir):
    t = tb.processed(spark, sf_dir, ("races", "constructors", "drivers", "results"))
    return calculated_results(t["results"], t["races"], t["drivers"], t["constructors"],
                              top_n=tb.TOP_N)


def _batch_race_results(spark, sf_dir):
    t = tb.processed(spark, sf_dir, ("circuits", "races", "constructors", "drivers"))
    results = tb.processed_batches(spark, sf_dir, "results")
    return race_results(results, t["races"], t["circuits"], t["drivers"], t["constructors"],
                        load_ts=tb.LOAD_TS, incremental=True)


def _top_drivers(calc):
    return dom.ranked_dominance(calc, "driver_name", tb.DRIVER_MIN, tb.TOP_DRIVERS, "driver_rank")


def _top_teams(calc):
    return dom.ranked_dominance(calc, "team_name", tb.TEAM_MIN, tb.TOP_TEAMS, "team_rank")


# --- star joins, scoring -------------------------------------------------------

@query
def race_results_q(spark, sf_dir):
    return _race_results(spark, sf_dir)


@query
def join_inner_dim(spark, sf_dir):
    t = tb.processed(spark, sf_dir, ("circuits", "races"))
    return race_circuits(t["races"], t["circuits"])


@query
def calculated_results_q(spark, sf_dir):
    return _calc(spark, sf_dir)


@query
def filter_topn_position(spark, sf_dir):
    r = tb.processed(spark, sf_dir, ("results",))["results"]
    return (r.filter(F.col("position") <= tb.TOP_N)
             .select("result_id", "race_id", "driver_id", "position", "points"))


# --- standings ------------------------------------------------------------------

@query
def driver_standings_q(spark, sf_dir):
    return driver_standings(_race_results(spark, sf_dir), with_team=True)


@query
def constructor_standings_q(spark, sf_dir):
    return constructor_standings(_race_results(spark, sf_dir))


# --- dominance analyses ---------------------------------------------------------

@query
def dominant_drivers_all_time(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "driver_name", tb.DRIVER_MIN)


@query
def dominant_drivers_window1(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "driver_name", tb.DRIVER_WINDOW_MIN,
                         years=tb.WINDOW1)


@query
def dominant_drivers_window2(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "driver_name", tb.DRIVER_WINDOW_MIN,
                         years=tb.WINDOW2)


@query
def dominant_teams_all_time(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "team_name", tb.TEAM_MIN, inclusive=True)


@query
def dominant_teams_window1(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "team_name", tb.TEAM_WINDOW_MIN, years=tb.WINDOW1)


@query
def dominant_teams_window2(spark, sf_dir):
    return dom.dominance(_calc(spark, sf_dir), "team_name", tb.TEAM_WINDOW_MIN, years=tb.WINDOW2)


@query
def top10_drivers(spark, sf_dir):
    return _top_drivers(_calc(spark, sf_dir))


@query
def top5_teams(spark, sf_dir):
    return _top_teams(_calc(spark, sf_dir))


@query
def dominant_drivers_by_year(spark, sf_dir):
    return dom.profile_of_top(_calc(spark, sf_dir), "driver_name", tb.DRIVER_MIN, tb.TOP_DRIVERS)


@query
def dominant_drivers_by_year_semi(spark, sf_dir):
    calc = _calc(spark, sf_dir)
    return dom.yearly_profile(calc, _top_drivers(calc), "driver_name", "semi")


@query
def dominant_teams_by_year(spark, sf_dir):
    return dom.profile_of_top(_calc(spark, sf_dir), "team_name", tb.TEAM_MIN, tb.TOP_TEAMS)


@query
def view_chain(spark, sf_dir):
    """The top-10 analysis in SQL over chained temp views (views are session
    scoped, so their names carry a per-call suffix)."""
    import uuid
    prefix = f"v_dominant_drivers_{uuid.uuid4().hex[:8]}"
    return dom.create_dominance_views(spark, _calc(spark, sf_dir), "driver_name",
                                      tb.DRIVER_MIN, tb.TOP_DRIVERS, "driver_rank", prefix)


# --- profiles and checks ----------------------------------------------------------

@query
def profile_count(spark, sf_dir):
    return profile.row_count(tb.processed(spark, sf_dir, ("results",))["results"])


@query
def profile_count_by_batch(spark, sf_dir):
    return profile.count_by(_batch_race_results(spark, sf_dir), ["file_date"])


@query
def profile_count_by_race(spark, sf_dir):
    return profile.count_by(_batch_race_results(spark, sf_dir), ["race_id"])


@query
def profile_count_by_season(spark, sf_dir):
    return profile.count_by(_race_results(spark, sf_dir), ["race_year"])


@query
def column_distinct_values(spark, sf_dir):
    return profile.distinct_values(_race_results(spark, sf_dir), "race_year")


@query
def audit_duplicate_keys_q(spark, sf_dir):
    r = tb.processed(spark, sf_dir, ("results",))["results"]
    return audit_duplicate_keys(r, ["race_id", "driver_id"])


@query
def dedupe_by_key_q(spark, sf_dir):
    r = tb.processed(spark, sf_dir, ("results",))["results"]
    return dedupe_by_key(r, ["race_id", "driver_id"])


@query
def profile_describe(spark, sf_dir):
    r = tb.processed(spark, sf_dir, ("results",))["results"]
    d = profile.describe_columns(r, ["points", "position", "grid", "laps"])
    return d.select("column_name", "count", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


@query
def spot_check_race(spark, sf_dir):
    return profile.spot_check(_race_results(spark, sf_dir), 1998, "1-URGENT Grand Prix")


@query
def filter_batch(spark, sf_dir):
    rr = _batch_race_results(spark, sf_dir)
    return rr.filter(F.col("file_date") == F.lit(tb.FILE_DATES[1]))


@query
def affected_years_semi(spark, sf_dir):
    rr = _batch_race_results(spark, sf_dir)
    return rows_of_periods(rr, affected_periods(rr, tb.FILE_DATES[1]))


# registry names without the suffix used to avoid clashing with imported operators
for _k in list(QUERIES):
    if _k.endswith("_q"):
        QUERIES[_k[:-2]] = QUERIES.pop(_k)

# storage-backed queries register themselves on import
from paddock.plans import registry_io as _registry_io  # noqa: E402,F401
