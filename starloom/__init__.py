"""Dimensional warehouses on Spark: dates, keys, loads, conversions and event streams."""
