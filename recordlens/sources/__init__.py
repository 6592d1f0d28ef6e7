"""Readers: daily exports, input files, payload caches, parquet tables and test views."""
