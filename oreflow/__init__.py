"""Medallion pipelines (bronze, silver, gold) expressed as Spark DataFrame operators."""
