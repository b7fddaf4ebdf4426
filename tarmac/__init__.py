"""tarmac - flight-delay analytics as Spark DataFrame jobs.

Sub-packages:
  functions  column expressions (time parsing, flags, bins)
  sources    scans and sinks of landed files (CSV, JSON, Parquet)
  operators  DataFrame -> DataFrame operators (joins, aggregates, windows, models)
  plans      the registry of named queries and their SQL oracles
  streaming  incremental ingest of monthly drops with Structured Streaming
"""

__version__ = "0.1.0"
