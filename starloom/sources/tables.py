"""Warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a table as it is now, also if a stream has written to it since."""
    spark.catalog.refreshTable(table)
    return spark.table(table)
