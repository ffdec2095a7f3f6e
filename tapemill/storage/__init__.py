"""Keyed Parquet tables: write, audit, publish; buckets; counts from footers."""
