"""Scans of landed files and the Parquet sinks of the pipeline."""
