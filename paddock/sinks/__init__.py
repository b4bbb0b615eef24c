"""Writers: overwrite, partitioned overwrite, tables, CTAS, dynamic partition
overwrite, keyed upsert and selective upsert on plain Parquet."""

from paddock.sinks.writes import (create_database, create_table_if_missing, ctas,
                                  drop_partitions_and_append, overwrite_parquet,
                                  overwrite_partitions, overwrite_table_partitions,
                                  read_or_empty, register_layer, register_table, reset_databases,
                                  save_as_table, selective_upsert, stage, upsert,
                                  upsert_frame, upsert_table)

__all__ = [
    "create_database", "create_table_if_missing", "ctas", "drop_partitions_and_append",
    "overwrite_parquet", "overwrite_partitions", "overwrite_table_partitions", "read_or_empty",
    "register_layer", "register_table", "reset_databases", "save_as_table", "selective_upsert", "stage", "upsert",
    "upsert_frame", "upsert_table",
]
