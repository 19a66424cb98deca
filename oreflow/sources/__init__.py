"""Readers of the landing area and of partitioned Parquet."""
