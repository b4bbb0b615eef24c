"""Season standings: per-period sums, conditional win counts and ranks.

``rank_within`` computes ``rank()`` without putting a whole period into one
task. A period (a season) may hold a large share of all standing rows, so a
``Window.partitionBy(period)`` would sort that share in a single task. Instead
the rows are first reduced to a histogram of distinct score tuples per period
(a partially aggregated group-by), the window runs over that histogram, and the
ranks are joined back on (period, score). ``rank = 1 + number of rows with a
strictly better score in the same period`` is exactly SQL ``RANK()``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition_cols: Sequence[str], order_desc: Sequence[str],
                rank_col: str = "rank", buckets: int = 0) -> DataFrame:
    """Append ``RANK() OVER (PARTITION BY p ORDER BY o1 DESC, o2 DESC, ...)``.

    ``buckets`` > 1 also cuts each partition's histogram into ranges of the
    first order column (approximate quantiles; equal values share a range, so
    ties stay exact): when scores are continuous, one hot partition's histogram
    is as large as its rows, and the window then runs per (partition, range)
    with each range's offset from a window over the table of range totals
    (``buckets`` + 1 rows a partition).
    """
    keys = [*partition_cols, *order_desc]
    return _with_ranks(df, _period_ranks(df, partition_cols, order_desc, rank_col, buckets), keys)


def _period_ranks(df: DataFrame, partition_cols: Sequence[str], order_desc: Sequence[str],
                  rank_col: str, buckets: int) -> DataFrame:
    """The rank of every distinct score tuple of a partition, by columns ``__k<i>``."""
    partition_cols, order_desc = list(partition_cols), list(order_desc)
    keys = partition_cols + order_desc
    hist = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    spans, offset = partition_cols, F.lit(0)
    if buckets > 1:
        hist, offsets = _bucket_offsets(hist, partition_cols, order_desc[0], buckets)
        spans = partition_cols + ["__b"]
        hist = hist.join(offsets, [hist[c].eqNullSafe(offsets[f"__o_{c}"]) for c in spans],
                         "left").drop(*[f"__o_{c}" for c in spans])
        offset = F.coalesce(F.col("__off"), F.lit(0))
    w = (Window.partitionBy(*spans)
               .orderBy(*[F.col(c).desc() for c in order_desc])
               .rowsBetween(Window.unboundedPreceding, -1))
    return hist.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                       (offset + F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1)
                       .cast("int").alias(rank_col))


def _with_ranks(df: DataFrame, ranks: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = [df[k].eqNullSafe(ranks[f"__k{i}"]) for i, k in enumerate(keys)]
    return df.join(ranks, cond, "inner").drop(*[f"__k{i}" for i in range(len(keys))])


def _bucket_offsets(hist: DataFrame, partition_cols: list, primary: str, buckets: int):
    """Bucket a (partition, score) histogram by quantile ranges of ``primary``
    and compute, per partition, how many rows rank ahead of each range."""
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(hist.filter(F.col(primary).isNotNull())
                      .approxQuantile(primary, probs, 0.001)))
    b = F.lit(0)
    for c in cuts:
        b = b + F.when(F.col(primary) >= F.lit(c), 1).otherwise(0)
    hist = hist.withColumn("__b", F.when(F.col(primary).isNull(), F.lit(-1)).otherwise(b))
    totals = hist.groupBy(*partition_cols, "__b").agg(F.sum("__n").alias("__t"))
    # better ranges first; the NULL range (-1) is the lowest number, so it comes last
    ahead = (Window.partitionBy(*partition_cols).orderBy(F.col("__b").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    return hist, totals.select(*[F.col(c).alias(f"__o_{c}") for c in [*partition_cols, "__b"]],
                               F.sum("__t").over(ahead).alias("__off"))


Keep = Callable[[str, DataFrame], DataFrame]


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def season_standings(race_results: DataFrame, group_cols: Sequence[str],
                     period_col: str = "race_year", points_col: str = "points",
                     position_col: str = "position", win_position: int = 1,
                     rank_col: str = "rank", rank_buckets: int = 0, keep: Keep = _lazy) -> DataFrame:
    """``total_points`` (SUM), ``wins`` (COUNT of finishes at ``win_position``)
    and ``rank`` within the period, ordered by total_points DESC, wins DESC.

    The totals are read twice, for the ranks and with them: ``keep`` (name, frame) may store
    both. Spark then knows the size of the ranks before it plans the join, and where they are few
    the totals are not shuffled for it."""
    agg = (race_results.groupBy(period_col, *group_cols)
           .agg(F.sum(points_col).alias("total_points"),
                F.count(F.when(F.col(position_col) == win_position, True)).alias("wins")))
    agg = keep("totals", agg)
    score = ["total_points", "wins"]
    ranks = keep("ranks", _period_ranks(agg, [period_col], score, rank_col, rank_buckets))
    return _with_ranks(agg, ranks, [period_col, *score])


# The grains of the standings tables.
DRIVER_GRAIN_FULL = ["driver_name", "driver_nationality", "team"]
DRIVER_GRAIN_INCREMENTAL = ["driver_name", "driver_nationality"]
CONSTRUCTOR_GRAIN = ["team"]


def driver_standings(race_results: DataFrame, with_team: bool = True,
                     rank_buckets: int = 0, keep: Keep = _lazy) -> DataFrame:
    grain = DRIVER_GRAIN_FULL if with_team else DRIVER_GRAIN_INCREMENTAL
    return season_standings(race_results, grain, rank_buckets=rank_buckets, keep=keep)


def constructor_standings(race_results: DataFrame, rank_buckets: int = 0,
                          keep: Keep = _lazy) -> DataFrame:
    return season_standings(race_results, CONSTRUCTOR_GRAIN, rank_buckets=rank_buckets, keep=keep)


def affected_periods(race_results: DataFrame, file_date: str,
                     period_col: str = "race_year") -> DataFrame:
    """Distinct periods touched by one batch, kept as a DataFrame (no collect)."""
    return (race_results.filter(F.col("file_date") == F.lit(file_date))
                        .select(period_col).distinct())


def rows_of_periods(race_results: DataFrame, periods: DataFrame,
                    period_col: str = "race_year") -> DataFrame:
    """All rows of the given periods (semi join: prunes partitions, never multiplies).

    The distinct periods (a row a season, as many as there are folders) go to every executor:
    a join that shuffles the rows by period would bring a whole season to one task."""
    return race_results.join(F.broadcast(periods.distinct()), period_col, "left_semi")


def global_rank(df: DataFrame, order_col: str, rank_col: str = "rank",
                buckets: int = 64, relative_error: float = 0.001) -> DataFrame:
    """``RANK() OVER (ORDER BY order_col DESC)`` over the whole frame, without
    moving every row to one task.

    rank = 1 + number of rows with a strictly greater key. The rows are reduced
    to a histogram of distinct keys (partially aggregated); the histogram is cut
    into ``buckets`` ranges of the key at approximate quantiles (equal keys
    always share a bucket, so ties stay exact); the bucket totals (one row per
    bucket) give each bucket's offset; a running count inside each bucket gives
    the rest; ranks are joined back on the key. NULL keys sort last (DESC) and
    tie with each other.
    """
    hist = df.groupBy(order_col).agg(F.count(F.lit(1)).alias("__n"))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(hist.filter(F.col(order_col).isNotNull())
                      .approxQuantile(order_col, probs, relative_error))) if probs else []
    bucket = F.lit(0)
    for c in cuts:  # bucket = number of cut points at or below the key
        bucket = bucket + F.when(F.col(order_col) >= F.lit(c), 1).otherwise(0)
    bucket = F.when(F.col(order_col).isNull(), F.lit(-1)).otherwise(bucket)
    hist = hist.withColumn("__b", bucket)
    totals = {r["__b"]: r["n"] for r in hist.groupBy("__b").agg(F.sum("__n").alias("n"))
              .collect()}
    # DESC order: higher buckets first, NULL bucket (-1) last
    offsets, running = {}, 0
    for b in sorted(totals, key=lambda b: (b == -1, -b)):
        offsets[b] = running
        running += totals[b]
    offset = F.lit(0)
    for b, off in offsets.items():
        offset = F.when(F.col("__b") == b, F.lit(off)).otherwise(offset)
    w = (Window.partitionBy("__b").orderBy(F.col(order_col).desc())
               .rowsBetween(Window.unboundedPreceding, -1))
    ranks = hist.select(F.col(order_col).alias("__k"),
                        (offset + F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1)
                        .cast("int").alias(rank_col))
    return df.join(ranks, df[order_col].eqNullSafe(ranks["__k"]), "inner").drop("__k")
