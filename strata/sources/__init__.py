"""Readers: parquet tables and landing folders, CSV and JSON payloads, test-table bindings."""
