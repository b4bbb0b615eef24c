"""Helpers shared by the operators: staging in the shared folder, worker
set-up, free column names, document input."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import work_dir

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the folder the driver uses
    (a cluster that ships the package by --py-files does not need it)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder of ``spark.checkpoint.dir`` and
    read it back: lineage is cut, a lost executor costs only its own tasks, and
    what several later steps read is computed once. The step's shuffle files, which nothing
    reads after the write, are deleted with its end rather than at some garbage collection."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` wrote, once nothing that is still to be computed reads
    them: what a long operator holds is then what its next steps need."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState()
        path = jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(conf.newHadoopConf()).delete(path, True)


BROADCAST_ROWS = 250_000   # narrow rows (numbers, digests) that go to every executor at most


def small(table: DataFrame) -> DataFrame:
    """The stored narrow ``table``, to be broadcast if it is small enough, so that what it is
    joined with (texts) stays in place; beyond that a join shuffles both sides as usual."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def numbered(df: DataFrame, name: str, row: str = "row") -> DataFrame:
    """``df`` with a number of every row, stored. File splits, and so numbers given in
    the scan, may differ from job to job (with the executors there are); every step that
    knows rows by number reads this table."""
    return staged(df.withColumn(row, F.monotonically_increasing_id()), name, "zstd")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                row_col: str | None = None) -> DataFrame:
    """The two columns an operator reads (and the rows' stored numbers, if ``row_col``
    names them), under fixed names; null text counts as empty. Every other column,
    whatever its name, is left unread."""
    row = [F.col(f"`{row_col}`").alias("row")] if row_col else []
    return docs.select(*row, F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
