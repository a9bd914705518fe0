"""Logical tables over the test parquet and the query catalogue built on them."""
