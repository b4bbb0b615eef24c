"""Conforming operators: rename, audit columns, struct flattening, timestamp
parsing, partition-column placement and deterministic dedupe.

All of them are narrow projections (or one partial-aggregating group-by for
the dedupe) that Catalyst collapses into the scan's codegen stage.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layout of the raw race start (date + time of day).
RACE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_OF_DAY = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename columns; unlike ``withColumnsRenamed`` a missing name is an error."""
    if strict:
        missing = [c for c in mapping if c not in df.columns]
        if missing:
            raise ValueError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(dict(mapping))


def timestamp_literal(value: str | _dt.datetime | None) -> Column:
    """A load timestamp as a TIMESTAMP_NTZ column.

    ``None`` means "now" (``current_timestamp`` in the session time zone);
    jobs pass one value per run so every copy of a batch carries the same stamp.
    """
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def add_audit_columns(df: DataFrame, data_source: str | None = None,
                      file_date: str | None = None,
                      load_ts: str | _dt.datetime | None = None,
                      ts_column: str = "ingestion_date") -> DataFrame:
    """Append ``data_source`` / ``file_date`` literals and the load timestamp."""
    cols: dict[str, Column] = {}
    if data_source is not None:
        cols["data_source"] = F.lit(data_source)
    if file_date is not None:
        cols["file_date"] = F.lit(file_date)
    if ts_column:
        cols[ts_column] = timestamp_literal(load_ts)
    return df.withColumns(cols)


def flatten_struct(df: DataFrame, column: str, fields: Sequence[str], sep: str = " ") -> DataFrame:
    """Replace a struct column by the concatenation of its fields (NULL if any is NULL)."""
    parts: list[Column] = []
    for i, f in enumerate(fields):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(f"{column}.{f}"))
    return df.withColumn(column, F.concat(*parts))


def race_timestamp(date_col: str = "date", time_col: str = "time",
                   fmt: str = RACE_TIMESTAMP_FORMAT) -> Column:
    """``date || ' ' || time`` parsed as a TIMESTAMP_NTZ.

    A missing or malformed time (the ``\\N`` marker, ``25:00:00``) yields NULL
    instead of failing the load under ANSI mode. With the default format the
    text is guarded by a strict time-of-day pattern and parsed straight to
    TIMESTAMP_NTZ, so the result does not depend on the session time zone;
    other formats go through ``try_to_timestamp``.
    """
    text = F.concat(F.col(date_col).cast("string"), F.lit(" "), F.col(time_col))
    if fmt == RACE_TIMESTAMP_FORMAT:
        valid = F.col(time_col).rlike(TIME_OF_DAY)
        return F.when(valid, F.to_timestamp_ntz(text, F.lit(fmt)))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def partition_column_last(df: DataFrame, partition_col: str | Sequence[str]) -> DataFrame:
    """Move the partition column(s) to the end (position-based inserts need it)."""
    parts = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    return df.select(*[c for c in df.columns if c not in parts], *parts)


def dedupe_by_key(df: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order_by`` (default: every other
    column in schema order, ascending, NULLs first).

    Expressed as ``min(struct(...))`` per key, so the choice is deterministic
    (``dropDuplicates`` is not) and the aggregate runs partially before the
    shuffle: a key holding a third of all rows is combined map-side instead of
    landing whole in one task as a ``row_number`` window would.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by else rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c) for c in order + tail])
    picked = df.groupBy(*keys).agg(F.min(packed).alias("__row"))
    return picked.select(*[F.col(k) for k in keys],
                         *[F.col(f"__row.{c}").alias(c) for c in order + tail]
                         ).select(*df.columns)


def audit_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity (``n``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))
