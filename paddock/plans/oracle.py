"""DuckDB SQL oracles of the registered queries.

Each oracle recomputes a query's answer directly from the pre-registered test
tables with plain SQL (joins, GROUP BY, window functions), independently of
the Spark operators. The raw feeds come from the same SQL templates as the
Spark side (``paddock.sources.testtables``). Types are cast to Spark's
(INT ranks and years, BIGINT sums) so that schemas compare equal.
"""

from __future__ import annotations

from paddock.plans.testbed import (BUCKETS, DRIVER_MIN, DRIVER_WINDOW_MIN, FILE_DATES, LOAD_TS,
                                   TEAM_MIN, TEAM_WINDOW_MIN, TOP_DRIVERS, TOP_N,
                                   TOP_TEAMS, WINDOW1, WINDOW2, batch_stamp)
from paddock.sources.testtables import DATA_SOURCE, oracle_feed

TS = f"TIMESTAMP '{LOAD_TS}'"
SRC = f"'{DATA_SOURCE}'"

RESULT_COLS = ("resultId AS result_id, raceId AS race_id, driverId AS driver_id, "
               "constructorId AS constructor_id, number, grid, position, "
               "positionText AS position_text, positionOrder AS position_order, points, laps, "
               "time, milliseconds, fastestLap AS fastest_lap, rank, "
               "fastestLapTime AS fastest_lap_time, fastestLapSpeed AS fastest_lap_speed")


def _processed(name: str, ts: str = TS, file_date: str | None = None) -> str:
    feed = oracle_feed(name, file_date)
    fd = f", '{file_date}' AS file_date" if file_date else ""
    if name == "circuits":
        return (f"SELECT circuitId AS circuit_id, circuitRef AS circuit_ref, name, location, "
                f"country, lat AS latitude, lng AS longitude, alt AS altitude, "
                f"{SRC} AS data_source{fd}, {ts} AS ingestion_date FROM ({feed})")
    if name == "races":
        return (f"SELECT raceId AS race_id, year AS race_year, round, circuitId AS circuit_id, "
                f"name, {ts} AS ingestion_date, {SRC} AS data_source, "
                f"try_strptime(CAST(date AS STRING) || ' ' || time, '%Y-%m-%d %H:%M:%S') "
                f"AS race_timestamp{fd} FROM ({feed})")
    if name == "constructors":
        return (f"SELECT constructorId AS constructor_id, constructorRef AS constructor_ref, "
                f"name, nationality, {SRC} AS data_source{fd}, {ts} AS ingestion_date "
                f"FROM ({feed})")
    if name == "drivers":
        return (f"SELECT driverId AS driver_id, driverRef AS driver_ref, number, code, "
                f"name_forename || ' ' || name_surname AS name, dob, nationality, "
                f"{ts} AS ingestion_date, {SRC} AS data_source{fd} FROM ({feed})")
    if name == "results":
        return (f"SELECT {RESULT_COLS}, {SRC} AS data_source{fd}, {ts} AS ingestion_date "
                f"FROM ({feed})")
    if name in ("pit_stops", "lap_times"):
        return (f"SELECT raceId AS race_id, driverId AS driver_id, * EXCLUDE (raceId, driverId), "
                f"{ts} AS ingestion_date, {SRC} AS data_source{fd} FROM ({feed})")
    if name == "qualifying":
        return (f"SELECT qualifyId AS qualify_id, raceId AS race_id, driverId AS driver_id, "
                f"constructorId AS constructor_id, number, position, q1, q2, q3, "
                f"{ts} AS ingestion_date, {SRC} AS data_source{fd} FROM ({feed})")
    raise KeyError(name)


def with_processed(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({_processed(n)})" for n in names)


def results_batches_sql() -> str:
    """Results as the union of the delivery batches, each with its file_date."""
    parts = [_processed("results", f"TIMESTAMP '{batch_stamp(d)}'", d) for d in FILE_DATES]
    return "\nUNION ALL\n".join(parts)


STAR = ("FROM results r JOIN races ra ON r.race_id = ra.race_id "
        "JOIN circuits c ON ra.circuit_id = c.circuit_id "
        "JOIN drivers d ON r.driver_id = d.driver_id "
        "JOIN constructors co ON r.constructor_id = co.constructor_id")

RACE_RESULTS_SELECT = (
    "ra.race_year, ra.name AS race_name, ra.race_timestamp AS race_date, "
    "c.location AS circuit_location, d.name AS driver_name, d.number AS driver_number, "
    "d.nationality AS driver_nationality, co.name AS team, r.grid, r.fastest_lap, "
    "r.time AS race_time, r.points, r.position")

RACE_RESULTS = (with_processed("circuits", "races", "constructors", "drivers", "results") +
                f"\nSELECT {RACE_RESULTS_SELECT}, {TS} AS created_date {STAR}")

CALC_CTE = (with_processed("races", "constructors", "drivers", "results") + f""",
calc AS (
  SELECT ra.race_year, co.name AS team_name, d.name AS driver_name, r.position, r.points,
         {TOP_N + 1} - r.position AS calculated_points
    FROM results r
    JOIN drivers d ON r.driver_id = d.driver_id
    JOIN constructors co ON r.constructor_id = co.constructor_id
    JOIN races ra ON r.race_id = ra.race_id
   WHERE r.position <= {TOP_N})
""")


def _dominance(entity: str, op: str, bound: int, years=None) -> str:
    where = f"WHERE race_year BETWEEN {years[0]} AND {years[1]}" if years else ""
    return (CALC_CTE + f"SELECT {entity}, COUNT(1) AS total_races, "
            f"CAST(SUM(calculated_points) AS BIGINT) AS total_points, "
            f"AVG(calculated_points) AS avg_points FROM calc {where} "
            f"GROUP BY {entity} HAVING COUNT(1) {op} {bound} ORDER BY avg_points DESC")


def _top(entity: str, bound: int, k: int, rank_col: str) -> str:
    return (f"SELECT * FROM (SELECT {entity}, COUNT(1) AS total_races, "
            f"CAST(SUM(calculated_points) AS BIGINT) AS total_points, "
            f"AVG(calculated_points) AS avg_points, "
            f"CAST(RANK() OVER (ORDER BY AVG(calculated_points) DESC) AS INT) AS {rank_col} "
            f"FROM calc GROUP BY {entity} HAVING COUNT(1) >= {bound}) WHERE {rank_col} <= {k}")


def _by_year(entity: str, bound: int, k: int, rank_col: str, semi: bool = False) -> str:
    top = _top(entity, bound, k, rank_col)
    if semi:
        src = f"FROM calc WHERE {entity} IN (SELECT {entity} FROM ({top}))"
    else:
        src = f"FROM calc JOIN ({top}) t USING ({entity})"
    return (CALC_CTE + f"SELECT race_year, {entity}, COUNT(1) AS total_races, "
            f"CAST(SUM(calculated_points) AS BIGINT) AS total_points, "
            f"AVG(calculated_points) AS avg_points {src} "
            f"GROUP BY race_year, {entity} ORDER BY race_year, avg_points DESC")


def _standings(group: str) -> str:
    return (f"WITH rr AS ({RACE_RESULTS}), st AS (SELECT race_year, {group}, "
            f"SUM(points) AS total_points, COUNT(*) FILTER (WHERE position = 1) AS wins "
            f"FROM rr GROUP BY race_year, {group}) "
            f"SELECT *, CAST(RANK() OVER (PARTITION BY race_year ORDER BY total_points DESC, "
            f"wins DESC) AS INT) AS rank FROM st")


RESULTS_ORDER = ("result_id, constructor_id, number, grid, position, position_text, "
                 "position_order, points, laps, time, milliseconds, fastest_lap, rank, "
                 "fastest_lap_time, fastest_lap_speed, data_source, ingestion_date")

BATCH_RACE_RESULTS = (
    with_processed("circuits", "races", "constructors", "drivers") +
    f",\nresults AS ({results_batches_sql()})\n"
    f"SELECT r.race_id, {RACE_RESULTS_SELECT}, r.file_date, {TS} AS created_date {STAR}")

# materialised: the batch's seasons are found in the joined rows, not by joining again
AFFECTED_YEARS = (f"WITH rr AS MATERIALIZED ({BATCH_RACE_RESULTS}), years AS MATERIALIZED (SELECT DISTINCT "
                  f"race_year FROM rr WHERE file_date = '{FILE_DATES[1]}') "
                  "SELECT rr.* FROM rr SEMI JOIN years ON rr.race_year = years.race_year")


def analytic_oracles() -> dict[str, str]:
    q = {}
    q["race_results"] = RACE_RESULTS
    q["join_inner_dim"] = (with_processed("circuits", "races") +
                           "\nSELECT ra.race_id, ra.race_year, ra.name AS race_name, "
                           "ra.race_timestamp AS race_date, c.location AS circuit_location "
                           "FROM races ra JOIN circuits c ON ra.circuit_id = c.circuit_id")
    q["calculated_results"] = CALC_CTE + "SELECT * FROM calc"
    q["filter_topn_position"] = (with_processed("results") +
                                 f"\nSELECT result_id, race_id, driver_id, position, points "
                                 f"FROM results WHERE position <= {TOP_N}")
    q["driver_standings"] = _standings("driver_name, driver_nationality, team")
    q["constructor_standings"] = _standings("team")
    q["dominant_drivers_all_time"] = _dominance("driver_name", ">", DRIVER_MIN)
    q["dominant_drivers_window1"] = _dominance("driver_name", ">", DRIVER_WINDOW_MIN, WINDOW1)
    q["dominant_drivers_window2"] = _dominance("driver_name", ">", DRIVER_WINDOW_MIN, WINDOW2)
    q["dominant_teams_all_time"] = _dominance("team_name", ">=", TEAM_MIN)
    q["dominant_teams_window1"] = _dominance("team_name", ">", TEAM_WINDOW_MIN, WINDOW1)
    q["dominant_teams_window2"] = _dominance("team_name", ">", TEAM_WINDOW_MIN, WINDOW2)
    q["top10_drivers"] = CALC_CTE + _top("driver_name", DRIVER_MIN, TOP_DRIVERS, "driver_rank")
    q["view_chain"] = q["top10_drivers"]
    q["top5_teams"] = CALC_CTE + _top("team_name", TEAM_MIN, TOP_TEAMS, "team_rank")
    q["dominant_drivers_by_year"] = _by_year("driver_name", DRIVER_MIN, TOP_DRIVERS, "driver_rank")
    q["dominant_drivers_by_year_semi"] = _by_year("driver_name", DRIVER_MIN, TOP_DRIVERS,
                                                  "driver_rank", semi=True)
    q["dominant_teams_by_year"] = _by_year("team_name", TEAM_MIN, TOP_TEAMS, "team_rank")
    q["profile_count"] = with_processed("results") + "\nSELECT COUNT(1) AS n FROM results"
    q["profile_count_by_batch"] = (f"WITH rr AS ({BATCH_RACE_RESULTS}) SELECT file_date, "
                                   f"COUNT(1) AS n FROM rr GROUP BY file_date")
    q["profile_count_by_race"] = (f"WITH rr AS ({BATCH_RACE_RESULTS}) SELECT race_id, COUNT(1) AS n "
                                  f"FROM rr GROUP BY race_id")
    q["profile_count_by_season"] = (f"WITH rr AS ({RACE_RESULTS}) SELECT race_year, "
                                    f"COUNT(1) AS n FROM rr GROUP BY race_year")
    q["column_distinct_values"] = (f"WITH rr AS ({RACE_RESULTS}) SELECT DISTINCT race_year "
                                   f"FROM rr")
    q["audit_duplicate_keys"] = (with_processed("results") +
                                 "\nSELECT race_id, driver_id, COUNT(1) AS n FROM results "
                                 "GROUP BY race_id, driver_id HAVING COUNT(1) > 1")
    q["dedupe_by_key"] = (with_processed("results") +
                          f"\nSELECT * FROM results QUALIFY row_number() OVER (PARTITION BY "
                          f"race_id, driver_id ORDER BY "
                          + ", ".join(f"{c} ASC NULLS FIRST" for c in RESULTS_ORDER.split(", "))
                          + ") = 1")
    cols = ["points", "position", "grid", "laps"]
    q["profile_describe"] = (with_processed("results") + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, round(AVG({c}), 6) AS mean, "
        f"round(STDDEV_SAMP({c}), 6) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, "
        f"CAST(MAX({c}) AS DOUBLE) AS max FROM results" for c in cols))
    q["spot_check_race"] = (f"WITH rr AS ({RACE_RESULTS}) SELECT * FROM rr WHERE race_year = 1998 "
                            f"AND race_name = '1-URGENT Grand Prix' ORDER BY points DESC")
    q["filter_batch"] = (f"WITH rr AS ({BATCH_RACE_RESULTS}) SELECT * FROM rr "
                         f"WHERE file_date = '{FILE_DATES[1]}'")
    q["affected_years_semi"] = AFFECTED_YEARS
    return q


# --- storage-backed queries -------------------------------------------------------

def _feed(name: str, file_date: str | None = None) -> str:
    return f"SELECT * FROM ({oracle_feed(name, file_date)})"


def _stamp(col: str) -> str:
    return f"CAST({col} || ' 06:00:00' AS TIMESTAMP)"


RESULTS_WITH_YEAR = (with_processed("races", "results") +
                     "\nSELECT r.*, ra.race_year FROM results r "
                     "LEFT JOIN races ra ON r.race_id = ra.race_id")

# per-batch dedupe on (race_id, driver_id), every batch with its own stamp
def _batch_deduped(d: str) -> str:
    return (f"SELECT * FROM ({_processed('results', _stamp(repr(d)), d)}) QUALIFY row_number() "
            f"OVER (PARTITION BY race_id, driver_id ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in RESULTS_ORDER.split(", ")) + ") = 1")


def _batches_deduped(dates) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({_batch_deduped(d)})" for d in dates)


BATCHES_DEDUPED = _batches_deduped(FILE_DATES)


def _final_results(dates) -> str:
    """State of the results table after merging ``dates`` in order (update all)."""
    return (with_processed("races") + ",\nb AS (" + _batches_deduped(dates) + "),\n"
            "fin AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY result_id, race_id "
            "ORDER BY file_date DESC) = 1)\n"
            "SELECT fin.*, ra.race_year FROM fin LEFT JOIN races ra ON fin.race_id = ra.race_id")


FINAL_RESULTS = _final_results(FILE_DATES)

FINAL_RACE_RESULTS = (
    with_processed("circuits", "races", "constructors", "drivers") +
    f",\nresults AS ({_final_results(FILE_DATES).replace(with_processed('races') + ',', 'WITH', 1)})"
    f"\nSELECT r.race_id, {RACE_RESULTS_SELECT}, r.file_date, {_stamp('r.file_date')} "
    f"AS created_date {STAR}")

FINAL_CALCULATED = (
    with_processed("races", "constructors", "drivers") + f",\nb AS ({BATCHES_DEDUPED}),\n"
    f"cb AS (SELECT ra.race_year, co.name AS team_name, d.driver_id, d.name AS driver_name, "
    f"ra.race_id, r.position, CAST(r.points AS INT) AS points, "
    f"{TOP_N + 1} - r.position AS calculated_points, r.file_date FROM b r "
    f"JOIN drivers d ON r.driver_id = d.driver_id "
    f"JOIN constructors co ON r.constructor_id = co.constructor_id "
    f"JOIN races ra ON r.race_id = ra.race_id WHERE r.position <= {TOP_N})\n"
    f"SELECT race_year, team_name, driver_id, driver_name, race_id, "
    f"arg_max(position, file_date) AS position, arg_max(points, file_date) AS points, "
    f"arg_max(calculated_points, file_date) AS calculated_points, "
    f"{_stamp('min(file_date)')} AS created_date, "
    f"CASE WHEN count(*) > 1 THEN {_stamp('max(file_date)')} END AS updated_date "
    f"FROM cb GROUP BY race_year, team_name, driver_id, driver_name, race_id")


def _inc_standings(group: str) -> str:
    return (f"WITH rr AS ({FINAL_RACE_RESULTS}), st AS (SELECT race_year, {group}, "
            f"SUM(points) AS total_points, COUNT(*) FILTER (WHERE position = 1) AS wins "
            f"FROM rr GROUP BY race_year, {group}) "
            f"SELECT *, CAST(RANK() OVER (PARTITION BY race_year ORDER BY total_points DESC, "
            f"wins DESC) AS INT) AS rank FROM st")


NESTED_DRIVERS = ("SELECT driverId, driverRef, number, code, name_forename AS forename, "
                  "name_surname AS surname, dob, nationality, url FROM (" +
                  oracle_feed("drivers") + ")")

INFERRED_RESULTS = (
    "SELECT CAST(resultId AS BIGINT) AS resultId, CAST(raceId AS BIGINT) AS raceId, "
    "CAST(driverId AS BIGINT) AS driverId, CAST(constructorId AS BIGINT) AS constructorId, "
    "CAST(number AS BIGINT) AS number, CAST(grid AS BIGINT) AS grid, "
    "CAST(position AS BIGINT) AS position, positionText, "
    "CAST(positionOrder AS BIGINT) AS positionOrder, CAST(points AS DOUBLE) AS points, "
    "CAST(laps AS BIGINT) AS laps, time, CAST(milliseconds AS BIGINT) AS milliseconds, "
    "CAST(fastestLap AS BIGINT) AS fastestLap, CAST(rank AS BIGINT) AS rank, fastestLapTime, "
    "CAST(fastestLapSpeed AS DOUBLE) AS fastestLapSpeed, statusId FROM ("
    + oracle_feed("results") + ")")

MARKED_PART = ("SELECT p_partkey, p_name, CASE WHEN p_size % 5 = 0 THEN NULL "
               "ELSE CAST(p_size AS INT) END AS p_size FROM part")


def _processed_with_year(name: str) -> str:
    return (with_processed("races") + f",\nx AS ({_processed(name)})\n"
            "SELECT x.*, ra.race_year FROM x LEFT JOIN races ra ON x.race_id = ra.race_id")


# Fixed values (mirroring paddock.plans.ingest): merge keys of the timing facts
# and the rest of their columns, in schema order, which decide the dedupe.
TIMING_KEYS = {
    "pit_stops": ("race_id, driver_id, stop", "lap, time, duration, milliseconds"),
    "lap_times": ("race_id, driver_id, lap", "position, time, milliseconds"),
    "qualifying": ("qualify_id, race_id",
                   "driver_id, constructor_id, number, position, q1, q2, q3"),
}


def _final_timing(name: str) -> str:
    keys, rest = TIMING_KEYS[name]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest.split(", "))
    parts = "\nUNION ALL\n".join(
        f"SELECT * FROM (SELECT * FROM ({_processed(name, _stamp(repr(d)), d)}) QUALIFY "
        f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)" for d in FILE_DATES)
    return (with_processed("races") + f",\nb AS ({parts}),\n"
            f"fin AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY file_date DESC) = 1)\n"
            "SELECT fin.*, ra.race_year FROM fin LEFT JOIN races ra ON fin.race_id = ra.race_id")


def io_oracles() -> dict[str, str]:
    q = {}
    q["scan_csv_header"] = _feed("races")
    q["scan_csv_folder"] = _feed("lap_times")
    q["scan_json_lines"] = _feed("results")
    q["scan_json_ddl_schema"] = _feed("constructors")
    q["scan_json_nested"] = NESTED_DRIVERS
    q["scan_json_multiline"] = _feed("pit_stops")
    q["scan_json_multiline_folder"] = _feed("qualifying")
    q["scan_json_inferred"] = INFERRED_RESULTS
    q["scan_permissive_nulls"] = MARKED_PART
    q["scan_permissive_nulls_json"] = MARKED_PART
    q["scan_parquet"] = "SELECT * FROM lineitem"
    q["scan_catalog_table"] = "SELECT * FROM orders"
    q["scan_dated_batch"] = _feed("results", FILE_DATES[1])
    q["race_timestamp"] = with_processed("races") + "\nSELECT race_id, race_timestamp FROM races"
    q["ddl_raw_csv_table"] = _feed("races")
    q["ddl_raw_csv_folder_table"] = _feed("lap_times")
    q["ddl_raw_json_table"] = _feed("results")
    q["ddl_raw_json_struct_table"] = NESTED_DRIVERS
    q["ddl_raw_json_multiline_table"] = _feed("qualifying")
    q["project_select"] = with_processed("races") + "\nSELECT * FROM races"
    q["project_rename"] = with_processed("results") + "\nSELECT * FROM results"
    q["project_drop"] = with_processed("constructors") + "\nSELECT * FROM constructors"
    q["audit_columns"] = f"SELECT * FROM ({_processed('circuits', TS, FILE_DATES[0])})"
    q["struct_flatten"] = with_processed("drivers") + "\nSELECT * FROM drivers"
    q["project_partition_last"] = q["project_rename"]
    q["sink_parquet_overwrite"] = RACE_RESULTS
    q["sink_partitioned"] = RESULTS_WITH_YEAR
    q["sink_save_as_table"] = RESULTS_WITH_YEAR
    q["sink_ctas"] = CALC_CTE + "SELECT * FROM calc"
    q["ddl_create_if_missing"] = (
        with_processed("races", "constructors", "drivers", "results") +
        f"\nSELECT ra.race_year, co.name AS team_name, d.driver_id, d.name AS driver_name, "
        f"ra.race_id, r.position, CAST(r.points AS INT) AS points, "
        f"{TOP_N + 1} - r.position AS calculated_points, {TS} AS created_date, "
        f"CAST(NULL AS TIMESTAMP) AS updated_date FROM results r "
        f"JOIN drivers d ON r.driver_id = d.driver_id "
        f"JOIN constructors co ON r.constructor_id = co.constructor_id "
        f"JOIN races ra ON r.race_id = ra.race_id WHERE r.position <= {TOP_N}")
    changed = (f"WITH base AS ({RESULTS_WITH_YEAR}) SELECT * REPLACE (CASE WHEN race_year = 2000 "
               f"THEN CAST(points + 10 AS FLOAT) ELSE points END AS points) FROM base")
    q["partition_overwrite"] = changed
    q["partition_drop_reload"] = changed
    q["partition_overwrite_table"] = changed
    q["upsert_first_load"] = _final_results(FILE_DATES[:1])
    q["upsert_merge"] = FINAL_RESULTS
    q["upsert_idempotent"] = FINAL_RESULTS
    q["upsert_table"] = FINAL_RESULTS
    bucket = f"CAST(race_id % {BUCKETS} AS INTEGER) AS race_bucket"
    q["upsert_merge_bucketed"] = f"SELECT *, {bucket} FROM ({FINAL_RESULTS})"
    q["race_results_incremental_bucketed"] = f"SELECT *, {bucket} FROM ({FINAL_RACE_RESULTS})"
    q["calculated_results_incremental_bucketed"] = (f"SELECT *, {bucket} "
                                                    f"FROM ({FINAL_CALCULATED})")
    q["upsert_selective"] = FINAL_CALCULATED
    first = _final_results(FILE_DATES[:1])
    q["upsert_late_dimension"] = first
    q["upsert_moved_season"] = (f"SELECT * REPLACE (CAST(CASE WHEN race_id % 2 = 0 THEN race_year + 1 "
                                f"ELSE race_year END AS INT) AS race_year) FROM ({first})")
    q["upsert_widened_type"] = first
    named = (f"SELECT CASE WHEN driver_id % 10 <> 0 THEN driver_id END AS driver_id, race_id, points, "
             f"position, race_year FROM ({first})")
    q["upsert_null_keys"] = (f"SELECT * FROM ({named}) UNION ALL "
                             f"SELECT * FROM ({named}) WHERE driver_id IS NULL")
    q["upsert_selective_moved_season"] = (
        with_processed("races", "constructors", "drivers") +
        f",\nb AS ({_batches_deduped(FILE_DATES[:1])})\n"
        f"SELECT ra.race_year, co.name AS team_name, d.driver_id, d.name AS driver_name, "
        f"ra.race_id, r.position, CAST(r.points AS INT) AS points, "
        f"{TOP_N + 1} - r.position AS calculated_points, "
        f"{_stamp(repr(FILE_DATES[0]))} AS created_date, {_stamp(repr(FILE_DATES[1]))} AS updated_date "
        f"FROM b r JOIN drivers d ON r.driver_id = d.driver_id "
        f"JOIN constructors co ON r.constructor_id = co.constructor_id "
        f"JOIN races ra ON r.race_id = ra.race_id WHERE r.position <= {TOP_N}")
    q["reset_layers"] = (with_processed("circuits") +
                         "\nSELECT *, CAST(1 AS BIGINT) AS n_tables FROM circuits")
    q["affected_years_pruned"] = AFFECTED_YEARS

    def merged_once(name: str) -> str:
        d = FILE_DATES[0]
        if name == "results":
            return first
        keys, rest = TIMING_KEYS[name]
        return f"SELECT DISTINCT {keys} FROM ({_processed(name, _stamp(repr(d)), d)})"

    q["run_ingestion_all_incremental"] = " UNION ALL ".join(
        [f"SELECT '{n}' AS table_name, COUNT(*) AS n FROM {t}" for n, t in [
            ("circuits", "nation"), ("races", "orders"), ("constructors", "supplier"), ("drivers", "part")]]
        + [f"SELECT '{n}', COUNT(*) FROM ({merged_once(n)})" for n in ["results", *TIMING_KEYS]])
    for name in ("circuits", "races", "constructors", "drivers"):
        q[f"ingest_{name}"] = with_processed(name) + f"\nSELECT * FROM {name}"
    for name in ("results", "pit_stops", "lap_times", "qualifying"):
        q[f"ingest_{name}"] = _processed_with_year(name)
    q["ingest_results_incremental"] = FINAL_RESULTS
    q["stream_results_incremental"] = FINAL_RESULTS
    for name in TIMING_KEYS:
        q[f"ingest_{name}_incremental"] = _final_timing(name)
    q["run_ingestion_all"] = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n FROM {t}" for n, t in [
            ("circuits", "nation"), ("races", "orders"), ("constructors", "supplier"),
            ("drivers", "part"), ("results", "lineitem"), ("pit_stops", "lineitem"),
            ("lap_times", "lineitem"), ("qualifying", "lineitem")])
    q["full_load_race_results"] = RACE_RESULTS
    q["full_load_driver_standings"] = _standings("driver_name, driver_nationality, team")
    q["full_load_constructor_standings"] = _standings("team")
    q["full_load_calculated_race_results"] = CALC_CTE + "SELECT * FROM calc"
    q["race_results_incremental"] = FINAL_RACE_RESULTS
    q["driver_standings_incremental"] = _inc_standings("driver_name, driver_nationality")
    q["constructor_standings_incremental"] = _inc_standings("team")
    q["calculated_results_incremental"] = FINAL_CALCULATED
    return q


def all_oracles() -> dict[str, str]:
    out = analytic_oracles()
    out.update(io_oracles())
    out["full_load_top10_drivers"] = out["top10_drivers"]
    out["full_load_dominant_drivers_by_year"] = out["dominant_drivers_by_year"]
    return out
