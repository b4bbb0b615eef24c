"""Dominance analyses over scored results: per-entity totals with a minimum
number of scored races, an all-time rank with a top-k cut, and the yearly
profile of the top entities.

The unpartitioned ``RANK()`` runs after the per-entity aggregate (one row per
entity) and, with the ``rank <= k`` filter, Spark inserts a partial
``WindowGroupLimit`` before the single-partition exchange, so only about k
rows per map task (plus ties) move to the ranking task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _totals(df: DataFrame, group_cols: Sequence[str], points_col: str) -> DataFrame:
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_races"),
        F.sum(points_col).alias("total_points"),
        F.avg(points_col).alias("avg_points"))


def dominance(scored: DataFrame, entity_col: str, min_races: int, inclusive: bool = False,
              years: tuple[int, int] | None = None, period_col: str = "race_year",
              points_col: str = "calculated_points", ordered: bool = True) -> DataFrame:
    """Entities with more than (or at least, ``inclusive``) ``min_races`` scored
    rows, optionally restricted to ``years`` (inclusive BETWEEN)."""
    df = scored
    if years is not None:
        df = df.filter(F.col(period_col).between(years[0], years[1]))
    out = _totals(df, [entity_col], points_col)
    bound = F.col("total_races") >= min_races if inclusive else F.col("total_races") > min_races
    out = out.filter(bound)
    return out.orderBy(F.col("avg_points").desc()) if ordered else out


def ranked_dominance(scored: DataFrame, entity_col: str, min_races: int, top_k: int | None,
                     rank_col: str, inclusive: bool = True,
                     points_col: str = "calculated_points") -> DataFrame:
    """Entities ranked by average points (ties share a rank), rank <= ``top_k``.

    ``top_k=None`` ranks every entity with ``standings.global_rank`` (exact
    RANK without a single-task window); with a ``top_k`` the window is limited
    per map task before its single-partition exchange.
    """
    base = dominance(scored, entity_col, min_races, inclusive=inclusive,
                     points_col=points_col, ordered=False)
    if top_k is None:
        from paddock.operators.standings import global_rank
        return global_rank(base, "avg_points", rank_col)
    w = Window.orderBy(F.col("avg_points").desc())
    return (base.withColumn(rank_col, F.rank().over(w))
                .filter(F.col(rank_col) <= top_k))


def yearly_profile(scored: DataFrame, top: DataFrame, entity_col: str,
                   method: str = "join", period_col: str = "race_year",
                   points_col: str = "calculated_points") -> DataFrame:
    """Per-period totals of the entities in ``top``.

    ``method="join"`` joins on the entity (``top`` has one row per entity, so
    no row is multiplied); ``method="semi"`` is the IN-subquery form.
    """
    keys = top.select(entity_col)
    how = {"join": "inner", "semi": "left_semi"}[method]
    picked = scored.join(keys, entity_col, how)
    return (_totals(picked, [period_col, entity_col], points_col)
            .orderBy(F.col(period_col).asc(), F.col("avg_points").desc()))


def profile_of_top(scored: DataFrame, entity_col: str, min_races: int, top_k: int,
                   period_col: str = "race_year", points_col: str = "calculated_points") -> DataFrame:
    """Per-period totals of the ``top_k`` entities of all time (``ranked_dominance``,
    then ``yearly_profile``) from one pass over the scored rows: the all-time totals are
    sums of the per-period ones, whose shuffle both sides of the join share."""
    per = scored.groupBy(period_col, entity_col).agg(F.count(F.lit(1)).alias("total_races"),
                                                     F.sum(points_col).alias("total_points"),
                                                     F.count(points_col).alias("scored_races"))
    mean = F.col("total_points") / F.when(F.col("scored_races") > 0, F.col("scored_races"))
    top = (per.groupBy(entity_col).agg(F.sum("total_races").alias("total_races"),
                                       F.sum("total_points").alias("total_points"),
                                       F.sum("scored_races").alias("scored_races"))
           .filter(F.col("total_races") >= min_races)
           .withColumn("place", F.rank().over(Window.orderBy(mean.desc())))
           .filter(F.col("place") <= top_k).select(entity_col))
    return (per.join(top, entity_col, "left_semi")
            .select(period_col, entity_col, "total_races", "total_points", mean.alias("avg_points"))
            .orderBy(F.col(period_col).asc(), F.col("avg_points").desc()))


def create_dominance_views(spark: SparkSession, scored: DataFrame, entity_col: str,
                           min_races: int, top_k: int, rank_col: str,
                           prefix: str = "v_dominant") -> DataFrame:
    """The SQL form of ``ranked_dominance``: chained temporary views.

    ``{prefix}_scored`` (the scored results), ``{prefix}`` (per-entity totals
    with ``RANK() OVER (ORDER BY AVG(points) DESC)``, at least ``min_races``)
    and ``{prefix}_top`` (rank <= ``top_k``). No ORDER BY inside the views:
    ordering belongs to the final query. Returns the top view.

    Read the ranking through ``{prefix}_top``: with the rank filter the
    unpartitioned window becomes a partial + final ``WindowGroupLimit``.
    Selecting ``{prefix}`` without a filter ranks every entity in one task,
    which is what an unpartitioned ``RANK()`` means in SQL.
    """
    scored.createOrReplaceTempView(f"{prefix}_scored")
    spark.sql(f"""
        CREATE OR REPLACE TEMP VIEW {prefix} AS
        SELECT {entity_col},
               COUNT(1) AS total_races,
               SUM(calculated_points) AS total_points,
               AVG(calculated_points) AS avg_points,
               RANK() OVER (ORDER BY AVG(calculated_points) DESC) AS {rank_col}
          FROM {prefix}_scored
         GROUP BY {entity_col}
        HAVING COUNT(1) >= {int(min_races)}""")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {prefix}_top AS "
              f"SELECT * FROM {prefix} WHERE {rank_col} <= {int(top_k)}")
    return spark.table(f"{prefix}_top")
