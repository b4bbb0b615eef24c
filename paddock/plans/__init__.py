"""Jobs composed from the operators: ingestion, full load, incremental load,
analyses."""
