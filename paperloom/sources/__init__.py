"""Readers, record extracts and the Parquet index store."""
