"""Load profiles and data checks: counts, counts per batch, distinct values,
column statistics and a one-race spot check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """Global row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_by(df: DataFrame, cols: Sequence[str], alias: str = "n",
             descending: bool = True) -> DataFrame:
    """Rows per value of ``cols`` (e.g. per file_date / race_id / race_year)."""
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(alias))
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in cols]
    return out.orderBy(*order)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, kept distributed."""
    return df.select(column).distinct()


def distinct_values_list(df: DataFrame, column: str) -> list:
    """Distinct values collected to the driver, for metadata-sized columns (partition
    values, delivery dates); use ``distinct_values`` with a semi join for any other."""
    return [r[0] for r in distinct_values(df, column).collect()]


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / stddev / min / max per numeric column, in one aggregate
    pass, returned long: (column_name, count, mean, stddev, min, max)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', c{i}, a{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {rows}) as (column_name, count, mean, stddev, min, max)")


def spot_check(race_results: DataFrame, race_year: int, race_name: str) -> DataFrame:
    """One race of one season, best points first (a by-eye comparison aid)."""
    return (race_results.filter((F.col("race_year") == race_year) &
                                (F.col("race_name") == race_name))
                        .orderBy(F.col("points").desc()))
