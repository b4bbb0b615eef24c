"""Typed scans of raw feeds, dated batch folders, catalog tables and raw DDL."""
