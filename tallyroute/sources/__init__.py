"""Readers and writers: CSV, Parquet, line files, edge lists, JSON metadata."""
