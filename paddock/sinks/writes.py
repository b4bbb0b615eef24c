"""Writers of the processed and presentation layers.

Storage is plain Parquet folders (optionally registered as catalog tables).
Without a transactional table format, a keyed MERGE is rebuilt as:

    touched = distinct partition values of the source (metadata-sized)
    old     = target WHERE p IN touched         -- static partition pruning
    kept    = old LEFT ANTI source ON keys      -- NULL keys never match
    result  = kept UNION BY NAME source         -- (upsert)
    write result with partitionOverwriteMode=dynamic, partitionBy(p)

Only the touched partitions are rewritten. The partition column must be one
of the keys (or a function of them), so a matched row never changes partition.
The old files of a partition are replaced when the write job commits, so a
task or executor lost mid-job is simply recomputed from the still-present
input. Writes are single-writer and not atomic across partitions.

Partitioned writes are rebalanced on the partition column first (the
``rebalance`` hint): one shuffle without a sampling pass, after which adaptive
execution splits a partition value that holds a large share of the rows (a hot
season) over several tasks and merges small ones, so each task writes few
folders with large files. Rows that a join or an aggregate has just dealt by their keys
are not shuffled again for that (``rebalance=False``; merges always): each task of AQE's
advisory size then writes a file per partition value it holds.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.conform import partition_column_last, timestamp_literal
from paddock.session import freed_shuffles, shared_dir

# Fixed value: codec of the Parquet files that loads and merges write.
CODEC = "zstd"
# Fixed value: their page format, in which sorted numbers and texts that begin alike are stored as
# differences.
PAGES = {"parquet.writer.version": "v2"}

Partitions = str | Sequence[str]


def _parts(partition_col: Partitions) -> list[str]:
    return [partition_col] if isinstance(partition_col, str) else list(partition_col)


def _clustered(df: DataFrame, partition_by: Sequence[str] | None,
               cluster_by: Sequence[str] = (), rebalance: bool = True) -> DataFrame:
    """Rows of one partition value together, in AQE-sized tasks; sorted by
    ``cluster_by`` inside each task so Parquet min/max statistics are tight.

    ``rebalance=False`` skips the shuffle (each task then writes one file per
    partition value it holds): right when the input is already clustered by
    the partition columns, e.g. straight after a group-by on them, or has just been
    shuffled whole and the partition values are few beside the rows of a task.
    """
    if not partition_by:
        return df
    out = df.hint("rebalance", *partition_by) if rebalance else df
    cluster = [c for c in cluster_by if c not in partition_by]
    if cluster:
        out = out.sortWithinPartitions(*partition_by, *cluster)
    return out


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                      cluster_by: Sequence[str] = (), rebalance: bool = True) -> str:
    """Replace the whole dataset at ``path`` (optionally partitioned)."""
    w = _clustered(df, partition_by, cluster_by, rebalance).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        w.options(**PAGES).parquet(path, compression=CODEC)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_col: Partitions,
                         cluster_by: Sequence[str] = (), rebalance: bool = True) -> str:
    """Replace only the partitions present in ``df``; create the dataset if absent."""
    parts = _parts(partition_col)
    w = (_clustered(partition_column_last(df, parts), parts, cluster_by, rebalance)
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts))
    with freed_shuffles(df.sparkSession):
        w.options(**PAGES).parquet(path, compression=CODEC)
    return path


def overwrite_table_partitions(spark: SparkSession, df: DataFrame, table: str,
                               partition_col: Partitions) -> str:
    """Replace only the partitions present in ``df`` in a catalog table; create
    the table, partitioned, if it is absent.

    The dynamic mode is stored on the table itself (storage option
    ``partitionOverwriteMode``), where an insert reads it; the session setting
    is never changed, so no later write in the session turns dynamic by
    accident. Columns are aligned to the table by name before the positional
    insert.
    """
    parts = _parts(partition_col)
    out = _clustered(partition_column_last(df, parts), parts)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES "
                  f"('partitionOverwriteMode' = 'dynamic')")
        out.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    else:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts).format("parquet").saveAsTable(table))
    return table


def read_or_empty(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The dataset at ``path``; ``None`` (or an empty frame of ``schema``) if absent."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            if schema is None:
                return None
            return spark.createDataFrame([], schema)
        raise


def stage(spark: SparkSession, source: DataFrame, target_path: str) -> DataFrame:
    """Materialise a merge source once, in a per-target folder under the shared
    checkpoint location (overwritten by the next merge into the same target).

    The key check and the merge then read this copy instead of recomputing the
    source (a star join, an aggregate); lineage is cut here, so a lost executor
    only recomputes from the staged files, and a non-deterministic source
    (timestamps) is evaluated exactly once.
    """
    path = _stage_dir(spark, target_path)
    with freed_shuffles(source.sparkSession):
        source.write.mode("overwrite").options(**PAGES).parquet(path, compression=CODEC)
    return spark.read.parquet(path)


def _stage_dir(spark: SparkSession, target_path: str) -> str:
    return shared_dir(spark, "stage", hashlib.sha1(target_path.encode()).hexdigest()[:16])


@contextmanager
def kept(spark: SparkSession, target_path: str):
    """A function (name, frame) that stages a frame needed more than once on the way to the
    dataset at ``target_path``; what it staged is deleted at the end."""
    held: list = []

    def keep(name: str, df: DataFrame) -> DataFrame:
        held.append(f"{target_path.rstrip('/')}/{name}")
        return stage(spark, df, held[-1])

    try:
        yield keep
    finally:
        _delete_folders(spark, [_stage_dir(spark, p) for p in held])


def cast_to(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with its columns in the target's types; a value that does not fit
    (overflow, unreadable text) fails the job whatever the session's ANSI mode."""
    _check_columns(source, target)
    types, own = dict(target.dtypes), dict(source.dtypes)

    def checked(c: str):
        col = F.col(f"`{c}`")
        if own[c] == types[c]:
            return col
        fits = col.try_cast(types[c])
        return F.when(col.isNotNull() & fits.isNull(), F.raise_error(F.concat(
            F.lit(f"{c}: does not fit {types[c]}: "), col.cast("string"))).cast(types[c])
        ).otherwise(fits).alias(c)

    return source.select(*[checked(c) for c in source.columns])


def inspect_source(source: DataFrame, keys: Sequence[str], partition_col: Partitions,
                   check_unique: bool = True) -> list:
    """The partition value tuples a merge source touches (one per partition folder, as
    many as the file index holds on the driver anyway).

    With ``check_unique`` a repeated merge key raises ``ValueError``, as a MERGE would
    fail; a key with a NULL part matches nothing, so it is no repetition.
    """
    parts, keys = _parts(partition_col), list(keys)
    if check_unique and set(parts) <= set(keys):   # both answers in one pass
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        rows = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("n", F.when(whole, F.col("n")).otherwise(F.lit(1)))
                .groupBy(*parts).agg(F.max("n").alias("n")).collect())
        if any(r["n"] > 1 for r in rows):
            _check_unique(source, keys)
    else:
        if check_unique:
            _check_unique(source, keys)
        rows = source.select(*parts).distinct().collect()
    return [tuple(r[c] for c in parts) for r in rows]


def partition_filter(partition_col: Partitions, values: list, dtypes: dict | None = None):
    """A Column selecting the partitions ``values`` (tuples, one value per
    partition column). Used as a partition filter, it makes the scan list and
    read only those folders."""
    parts = _parts(partition_col)

    def typed(c, v):
        return F.lit(v).cast(dtypes[c]) if dtypes else F.lit(v)

    whole = [t for t in values if all(v is not None for v in t)]
    if len(parts) == 1:
        cond = F.col(parts[0]).isin([t[0] for t in whole]) if whole else F.lit(False)
    else:
        packed = F.struct(*[F.col(c) for c in parts])
        cond = packed.isin([F.struct(*[typed(c, v).alias(c) for c, v in zip(parts, t)])
                            for t in whole]) if whole else F.lit(False)
    for t in values:   # the default partition folders
        if t not in whole:
            one = F.lit(True)
            for c, v in zip(parts, t):
                one = one & (F.col(c).isNull() if v is None else F.col(c) == typed(c, v))
            cond = cond | one
    return cond


def touched_partitions(target: DataFrame, partition_col: Partitions, values: list) -> DataFrame:
    """Target rows in the given partitions (static partition pruning)."""
    return target.filter(partition_filter(partition_col, values, dict(target.dtypes)))


def _in_partitions(target: DataFrame, partition_col: Partitions, values: list):
    """``partition_filter``, but false where it is NULL (in the default partition)."""
    return F.coalesce(partition_filter(partition_col, values, dict(target.dtypes)), F.lit(False))


def _check_columns(source: DataFrame, target: DataFrame) -> None:
    """A merge never drops source columns silently (no schema evolution)."""
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns {extra} are not in the target {target.columns}")


def _check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    dup = (source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    first = dup.limit(1).collect()
    if first:
        raise ValueError(f"source has duplicate merge keys {list(keys)}: {first[0].asDict()}")


def matching_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        partition_col: Partitions, located_by: Sequence[str] = (),
                        moved_by: Sequence[str] = ()) -> dict:
    """Partition value tuple -> number of target rows whose merge key is in the source.

    Needed when a row may have moved since its last delivery (its partition is not part
    of the key). The target's keys are read; ``located_by`` names partition columns that
    are functions of the key, by whose source values the scan is pruned. ``moved_by`` names
    the part of the key that several rows share (a race): partitions that hold none of the
    source's are ruled out by its distinct values, fewer than the keys.
    """
    parts = _parts(partition_col)
    for c in located_by:
        held = [(r[0],) for r in source.select(c).distinct().collect()]
        target = target.filter(partition_filter(c, held, dict(target.dtypes)))
    if moved_by:
        shared = (target.select(*dict.fromkeys([*moved_by, *parts])).distinct()
                  .join(source.select(*moved_by).distinct(), list(moved_by), "left_semi"))
        near = [tuple(r) for r in shared.select(*parts).distinct().collect()]
        if not near:
            return {}
        target = touched_partitions(target, parts, near)
    hits = (target.select(*dict.fromkeys([*keys, *parts]))
            .join(source.select(*keys), list(keys), "left_semi").groupBy(*parts).count())
    return {tuple(r[c] for c in parts): r["count"] for r in hits.collect()}


def _folders(target: DataFrame, partition_col: Partitions, values: list) -> list[str]:
    """Folders of the given partitions (their files' parents)."""
    if not values:
        return []
    files = (touched_partitions(target, partition_col, values)
             .select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("f")))
    return [r["f"] for r in files.distinct().collect()]


def _delete_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in folders:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        path.getFileSystem(conf).delete(path, True)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
           partition_col: Partitions, check_unique: bool = True, staged: bool = True,
           located_by: Sequence[str] = (), touched: list | None = None,
           moved_by: Sequence[str] = ()) -> str:
    """Keyed upsert: matched rows take every column from the source (update
    all), unmatched source rows are inserted, other target rows are kept.

    ``keys`` is the merge key. Partition columns that are not part of it may change: the
    row then leaves its old partition (late or corrected dimension), which is found by
    key and rewritten, and removed if nothing is left in it. A key with a NULL part
    matches nothing. Source columns are cast to the target's types.

    Creates the partitioned dataset on first load. Fails if a key repeats in
    the source (a MERGE would). Rows are never deleted. The source is read
    more than once (partition values, key check, merge), so it is staged first.
    ``touched`` is filled with the value tuples of the partitions written or removed;
    ``located_by`` and ``moved_by`` as in ``matching_partitions``.
    An attempt that broke off between writing and removing is mended by the next one.
    """
    keys, parts = list(keys), _parts(partition_col)
    target = read_or_empty(spark, path)
    if target is None and not check_unique and touched is None:
        return overwrite_partitions(source, path, partition_col, cluster_by=keys, rebalance=False)
    if target is None and not _exists(spark, path):
        values = _first_load(spark, source, path, keys, parts, check_unique)
        if touched is not None:
            touched += [v for v in values if v not in touched]
        return path
    if target is not None:
        source = cast_to(source, target)
    if staged:
        source = stage(spark, source, path)
    values = inspect_source(source, keys, partition_col, check_unique)
    emptied: list = []
    merged = source
    if target is not None:
        merged, values, emptied = _merge(target, source, keys, parts, values, located_by,
                                         moved_by)
    folders = _folders(target, parts, emptied) if emptied else []
    if touched is not None:
        touched += [v for v in values if v not in touched]
    overwrite_partitions(merged, path, partition_col, cluster_by=keys, rebalance=False)
    _delete_folders(spark, folders)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def _first_load(spark: SparkSession, source: DataFrame, path: str, keys: list, parts: list,
                check_unique: bool) -> list:
    """Write the first rows of the dataset at ``path``, where nothing is yet; returns the
    partitions they belong to.

    There is nothing to merge with, so the rows are written once, as they will lie, in a hidden
    folder beside ``path``. They are checked there (a repeated key fails the load and
    leaves no dataset), then the folder is renamed."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    beside = f"{folder}/_{name}_first"
    new, fs = _hadoop_path(spark, beside)
    try:
        overwrite_parquet(partition_column_last(source, parts), beside, parts, keys, rebalance=False)
        written = spark.read.schema(source.schema).parquet(beside)
        values = inspect_source(written, keys, parts, check_unique)
        if not fs.rename(new, _hadoop_path(spark, path)[0]):
            raise OSError(f"cannot rename {beside} to {path}")
    finally:
        fs.delete(new, True)
    return values


def _merge(target: DataFrame, source: DataFrame, keys: list, parts: list, values: list,
           located_by: Sequence[str], moved_by: Sequence[str] = ()
           ) -> tuple[DataFrame, list, list]:
    """(new content, partitions it belongs to, partitions left without a row)."""
    emptied: list = []
    if not set(parts) <= set(keys):
        # those the source writes to anyway are known: their rows stay out of the search
        others = target.filter(~_in_partitions(target, parts, values))
        hits = matching_partitions(others, source, keys, parts, located_by, moved_by)
        left = list(hits)
        if left:
            held = {tuple(r[c] for c in parts): r["count"] for r in
                    touched_partitions(target, parts, left).groupBy(*parts).count().collect()}
            emptied = [v for v in left if held[v] == hits[v]]
        values = values + left
    kept = touched_partitions(target, parts, values).join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns)), values, emptied


def upsert_frame(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                 partition_col: Partitions, values: list | None = None) -> DataFrame:
    """The new content of the partitions ``source`` touches (lazy)."""
    target = read_or_empty(spark, path)
    if target is None:
        return source
    source = cast_to(source, target)
    if values is None:
        values = inspect_source(source, keys, partition_col, check_unique=False)
    return _merge(target, source, list(keys), _parts(partition_col), values, ())[0]


def selective_upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                     update_cols: Sequence[str], partition_col: Partitions, schema,
                     stamp: str | _dt.datetime | None = None,
                     created_col: str = "created_date", updated_col: str = "updated_date",
                     check_unique: bool = True, located_by: Sequence[str] = (),
                     moved_by: Sequence[str] = ()) -> str:
    """MERGE with column-level update.

    matched      -> ``update_cols`` from the source, ``updated_col`` = stamp,
                    every other column (``created_col`` included) kept, also a
                    partition column that is not updated: the row stays where it is;
    source only  -> inserted with ``created_col`` = stamp, ``updated_col`` NULL;
    target only  -> kept.
    ``schema`` is the target's (DDL or StructType), used when it is still empty.
    ``keys``, ``located_by`` and ``moved_by`` as in ``upsert``.
    """
    keys, update_cols, parts = list(keys), list(update_cols), _parts(partition_col)
    if set(parts) & set(update_cols):
        raise ValueError("a partition column cannot be updated selectively")
    target = read_or_empty(spark, path, schema)
    ts = timestamp_literal(stamp)
    source = cast_to(source, target)
    if not _exists(spark, path):
        new = {c: F.col(c) if c in source.columns else F.lit(None) for c in target.columns}
        new |= {created_col: ts, updated_col: F.lit(None)}
        first = source.select(*[new[c].cast(t).alias(c) for c, t in target.dtypes])
        _first_load(spark, first, path, keys, parts, check_unique)
        return path
    source = stage(spark, source, path)
    values = inspect_source(source, keys, partition_col, check_unique)
    if not set(parts) <= set(keys):
        others = target.filter(~_in_partitions(target, parts, values))
        values = values + list(matching_partitions(others, source, keys, parts, located_by,
                                                   moved_by))
    cols = target.columns
    src_cols = [c for c in source.columns if c not in keys]
    src = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in src_cols],
                        F.lit(True).alias("__in_s"))
    old = touched_partitions(target, parts, values).withColumn("__in_t", F.lit(True))
    j = old.join(src, keys, "full_outer")
    matched = F.col("__in_t").isNotNull() & F.col("__in_s").isNotNull()
    source_only = F.col("__in_t").isNull()

    def pick(c: str):
        if c in keys:
            return F.col(c)
        s = F.col(f"__s_{c}") if c in src_cols else F.lit(None)
        if c == updated_col:
            return (F.when(matched, ts).when(source_only, F.lit(None))
                     .otherwise(F.col(c))).cast("timestamp_ntz")
        if c == created_col:
            return F.when(source_only, ts).otherwise(F.col(c)).cast("timestamp_ntz")
        if c in update_cols:
            return F.when(matched | source_only, s).otherwise(F.col(c))
        return F.when(source_only, s).otherwise(F.col(c))

    dtypes = dict(target.dtypes)
    merged = j.select(*[pick(c).cast(dtypes[c]).alias(c) for c in cols])
    return overwrite_partitions(merged, path, partition_col, cluster_by=keys, rebalance=False)


# --- catalog --------------------------------------------------------------

def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def register_table(spark: SparkSession, table: str, path: str,
                   partitioned: bool = False) -> str:
    """Register (or refresh) a catalog table over a Parquet folder."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")
    return table


def register_layer(spark: SparkSession, database: str, root: str, names,
                   partitioned=()) -> list[str]:
    """Register every dataset folder ``root/<name>`` as ``database.<name>``
    (created if missing, new partitions recovered, file listings refreshed)."""
    create_database(spark, database)
    return [register_table(spark, f"{database}.{n}", f"{root}/{n}", n in partitioned)
            for n in names]


def save_as_table(df: DataFrame, table: str, partition_by: Sequence[str] | None = None) -> str:
    """Overwrite a managed table (location from its database)."""
    w = _clustered(df, partition_by).write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
    return table


def ctas(spark: SparkSession, table: str, query: DataFrame,
         partition_by: Sequence[str] | None = None) -> str:
    """``CREATE TABLE t USING parquet AS <query>``; the query is a DataFrame."""
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} USING parquet{part} AS SELECT * FROM {{q}}", q=query)
    return table


def create_table_if_missing(spark: SparkSession, table: str, columns_ddl: str,
                            partition_by: Sequence[str] | None = None,
                            location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS t (...) USING parquet [PARTITIONED BY] [LOCATION]``."""
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns_ddl}) USING parquet{part}{loc}")
    return table


def drop_partitions_and_append(spark: SparkSession, df: DataFrame, table: str,
                               partition_col: str) -> str:
    """Replace the partitions present in ``df`` by its rows: what dropping them and
    appending gives, but in one dynamic partition overwrite, so any type of partition
    value works, a failed job loses nothing and the new files are clustered. ``df`` must
    not read the partitions being replaced (checkpoint it first)."""
    return overwrite_table_partitions(spark, df, table, partition_col)


def upsert_table(spark: SparkSession, source: DataFrame, table: str, location: str,
                 keys: Sequence[str], partition_col: Partitions,
                 check_unique: bool = True, located_by: Sequence[str] = ()) -> str:
    """Keyed upsert into a catalog table stored at ``location``.

    Table absent: the source becomes its first load (partitioned) and the
    table is registered on the folder. Table present: merge into its folder,
    then pick up new partitions and refresh cached file listings.
    """
    exists = spark.catalog.tableExists(table)
    upsert(spark, source, location, keys, partition_col, check_unique, located_by=located_by)
    if not exists:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")
    return table


def reset_databases(spark: SparkSession, locations: dict[str, str]) -> None:
    """Drop each database with its tables and create it again, empty (a fresh
    start before replaying an incremental history)."""
    for name, location in locations.items():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        create_database(spark, name, location)
