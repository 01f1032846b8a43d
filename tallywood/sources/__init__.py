"""Readers: log text, trip parquet, file inventories and stored results."""
