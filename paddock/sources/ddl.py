"""Raw tables over files: ``CREATE TABLE ... USING csv|json OPTIONS (path ...)``.

The table is dropped and created again (so a changed schema takes effect);
the data stays in the files and is parsed at query time with the declared
schema, like the typed readers in ``paddock.sources.feeds``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from paddock.schemas import RAW_SCHEMAS, to_ddl
from paddock.sources.feeds import FEED_FORMATS


def create_raw_table(spark: SparkSession, table: str, schema, fmt: str, path: str,
                     options: Mapping[str, str] | None = None) -> DataFrame:
    """Drop and create an external table over ``path``; returns ``SELECT *`` of it."""
    opts = {"path": path, **(options or {})}
    rendered = ", ".join(f"{k} '{v}'" for k, v in opts.items())
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({to_ddl(schema)}) USING {fmt} "
              f"OPTIONS ({rendered})")
    return spark.table(table)


def create_raw_feed_table(spark: SparkSession, database: str, name: str, path: str) -> DataFrame:
    """The raw table of one feed, with the feed's schema and file layout options."""
    layout = FEED_FORMATS[name]
    fmt = "csv" if layout.startswith("csv") else "json"
    options = {"header": "true"} if layout == "csv_header" else {}
    if layout == "json_multiline":
        options["multiLine"] = "true"
    return create_raw_table(spark, f"{database}.{name}", RAW_SCHEMAS[name], fmt, path, options)
