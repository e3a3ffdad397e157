"""Readers and writers: report files, download index, Parquet tables."""
