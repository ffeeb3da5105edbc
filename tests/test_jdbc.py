"""The calls that reach Spark's JDBC source; no database is started for a test."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from starloom.operators import KeyViolation
from starloom.sinks import load_database_table
from starloom.sources import Ranges, as_relation, create_foreign_table, read_database, read_query

URL = "jdbc:some:thing"


@pytest.fixture
def calls(spark, monkeypatch):
    """What a JDBC read or write is asked for, with three rows as the answer."""
    seen = []
    answer = spark.createDataFrame([(1,), (2,), (3,)], "k int")

    def load(reader, *_, **__):
        seen.append(dict(reader.asked))
        return answer

    def option(reader, name, value):
        reader.__dict__.setdefault("asked", {})[name] = value
        return reader

    def options(reader, **values):
        reader.__dict__.setdefault("asked", {}).update(values)
        return reader

    def read(reader, url, table, **more):
        seen.append({"url": url, "dbtable": table, **more})
        return answer

    def write(writer, url, table, mode=None, properties=None):
        seen.append({"url": url, "write": table, "properties": properties})

    monkeypatch.setattr(DataFrameReader, "load", load)
    monkeypatch.setattr(DataFrameReader, "option", option)
    monkeypatch.setattr(DataFrameReader, "options", options)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return seen


def test_query_is_wrapped():
    assert as_relation(" select 1; ") == "(select 1) q"


def test_query_read(spark, calls):
    read_query(spark, URL, "select k from t", {"user": "u"})
    assert calls == [{"url": URL, "dbtable": "(select k from t) q", "user": "u"}]


def test_ranges(spark, calls):
    read_database(spark, URL, "t", {}, Ranges("k", 0, 100, 4))
    assert calls == [
        {
            "url": URL,
            "dbtable": "t",
            "partitionColumn": "k",
            "lowerBound": "0",
            "upperBound": "100",
            "numPartitions": "4",
        }
    ]


def test_predicates(spark, calls):
    read_database(spark, URL, "t", {"user": "u"}, predicates=["k < 5", "k >= 5"])
    assert calls[0]["predicates"] == ["k < 5", "k >= 5"]


def test_load_checks_before_writing(spark, calls):
    def rows(*keys) -> DataFrame:
        return spark.createDataFrame([(k,) for k in keys], "k int")

    with pytest.raises(KeyViolation):
        load_database_table(rows(1, 1), URL, "t", "k", {})
    assert calls == []
    load_database_table(rows(1, 2), URL, "t", "k", {"user": "u"})
    assert calls == [{"url": URL, "write": "t", "properties": {"user": "u"}}]
    with pytest.raises(KeyViolation):
        load_database_table(rows(3, 4), URL, "t", "k", {}, "update")
    assert [call.get("write") for call in calls] == ["t", None]
    load_database_table(rows(4, 5), URL, "t", "k", {}, "update")
    assert calls[-1]["write"] == "t"
    with pytest.raises(ValueError):
        load_database_table(rows(4), URL, "t", "k", {}, "upsert")


def test_keys_of_the_target_are_read_in_parts(spark, calls):
    rows = spark.createDataFrame([(4,)], "k int")
    load_database_table(rows, URL, "t", "k", {}, "update", ranges=Ranges("k", 0, 9, 3))
    assert calls[0]["partitionColumn"] == "k" and calls[0]["numPartitions"] == "3"
    load_database_table(rows, URL, "t", "k", {}, "update", predicates=["k < 5", "k >= 5"])
    assert calls[2]["predicates"] == ["k < 5", "k >= 5"]


def test_a_failing_row_reaches_no_database(spark, calls):
    rows = spark.range(3).selectExpr("id AS k", "IF(id = 1, raise_error('broken'), 'v') AS v")
    with pytest.raises(Exception, match="broken"):
        load_database_table(rows, URL, "t", "k", {})
    assert calls == []


def test_foreign_table_statement(monkeypatch):
    said = []

    class Session:
        def sql(self, text):
            said.append(text)

        def table(self, name):
            return name

    create_foreign_table(Session(), "days", {"url": URL, "dbtable": "d'd"})
    assert said == [
        "CREATE TABLE IF NOT EXISTS days USING org.apache.spark.sql.jdbc "
        "OPTIONS ('url' 'jdbc:some:thing', 'dbtable' 'd\\'d')"
    ]
