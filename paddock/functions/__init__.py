"""Column-level helpers: conforming, audit columns, parsing, dedupe."""

from paddock.functions.conform import (add_audit_columns, audit_duplicate_keys,
                                       dedupe_by_key, flatten_struct,
                                       partition_column_last, race_timestamp,
                                       rename_columns, timestamp_literal)

__all__ = [
    "add_audit_columns", "audit_duplicate_keys", "dedupe_by_key", "flatten_struct",
    "partition_column_last", "race_timestamp", "rename_columns", "timestamp_literal",
]
