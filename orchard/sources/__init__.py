"""Readers (text files, parquet tables), stand-in views and the report sink."""
