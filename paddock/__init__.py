"""paddock: a Spark-native library for layered (raw -> processed -> presentation)
motorsport results tables.

Every operator is a DataFrame -> DataFrame function with explicit parameters;
the physical plan is left to Catalyst and adaptive query execution.

Entry points:

* ``paddock.plans.presentation.run_full_load`` / ``paddock.plans.incremental.run_history``
  (also ``python -m paddock full-load|incremental``)
* ``paddock.plans.ingest.ingest`` - one feed, full or incremental
* ``paddock.operators`` - star joins, standings, dominance analyses, profiles
* ``paddock.sinks`` - overwrite, partition overwrite, upsert, selective upsert, DDL
* ``paddock.sources`` - typed feed readers and raw tables
* ``paddock.streaming.ingest_deliveries`` - the incremental fact load as a stream
"""

__version__ = "0.1.0"
