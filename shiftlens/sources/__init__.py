"""Delimited files in, parquet tables in and out."""
