"""Relational databases over JDBC.

The driver jar, the address and the credentials are the caller's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FOREIGN_TABLE_PROVIDER = "org.apache.spark.sql.jdbc"


@dataclass(frozen=True)
class Ranges:
    """Splits a read into ``partitions`` ranges of a numeric or date column."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def as_relation(query: str, alias: str = "q") -> str:
    """A query in the form that a JDBC read takes in place of a table name."""
    return f"({query.strip().rstrip(';')}) {alias}"


def read_database(
    spark: SparkSession,
    url: str,
    relation: str,
    properties: Mapping[str, str],
    ranges: Ranges | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table, or a query wrapped by :func:`as_relation`.

    Filters and columns are pushed to the database. The read is one task unless
    ``ranges`` or, for unevenly spread keys, disjoint ``predicates`` split it.
    """
    if predicates is not None:
        return spark.read.jdbc(
            url, relation, predicates=list(predicates), properties=dict(properties)
        )
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", relation)
    reader = reader.options(**properties)
    if ranges is not None:
        reader = reader.options(**ranges.options())
    return reader.load()


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str],
    ranges: Ranges | None = None,
) -> DataFrame:
    """Read the result of a SQL query."""
    return read_database(spark, url, as_relation(query), properties, ranges)


def sql_text(text: str) -> str:
    """A string as a SQL literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_foreign_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    provider: str = FOREIGN_TABLE_PROVIDER,
) -> DataFrame:
    """Declare a table whose rows stay where they are, and return it.

    A table of that name that exists already is left as it is.
    """
    listed = ", ".join(f"{sql_text(name)} {sql_text(value)}" for name, value in options.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {provider} OPTIONS ({listed})")
    return spark.table(table)
