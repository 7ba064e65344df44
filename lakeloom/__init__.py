"""Lakehouse pipelines on Spark: untyped CSV vintages to star schema and feature table."""
