"""Operators for large training-data pipelines: encoding, deduplication, filtering, mixing and sharding.

Nothing outside this package imports it. Every operator takes a DataFrame with the
columns it names and ignores all others, so extra columns never clash.
"""
