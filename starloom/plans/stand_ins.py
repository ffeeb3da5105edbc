"""The shared test tables in the roles of users, orders, products and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    return rows.withColumn("o_orderdate", F.to_date("o_orderdate"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with the price as text, as a CSV scan without types gives it."""
    rows = table(spark, sf_dir, "part")
    return rows.withColumn("p_retailprice", F.col("p_retailprice").cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-shop events; the previous timestamp of an event is its user's first touch.

    So it is null for first events, without one sorted group per user: the
    minimum is aggregated before the shuffle, and the join splits hot users.
    """
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        # Read as UTC whatever the session's time zone.
        F.unix_micros(F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")).alias(
            "event_timestamp"
        ),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    first = rows.groupBy("user_id").agg(
        F.min("event_timestamp").alias("user_first_touch_timestamp")
    )
    touched_before = F.col("user_first_touch_timestamp") < F.col("event_timestamp")
    return rows.join(first, "user_id").select(
        F.when(F.col("value") < 10, "mobile").otherwise("desktop").alias("device"),
        F.struct(F.col("event_id").alias("order")).alias("ecommerce"),
        F.col("event_type").alias("event_name"),
        F.when(touched_before, F.col("user_first_touch_timestamp")).alias(
            "event_previous_timestamp"
        ),
        "event_timestamp",
        F.struct(F.concat(F.lit("city "), F.col("user_id")).alias("city")).alias("geo"),
        F.array(F.struct(F.col("event_id").alias("item"))).alias("items"),
        F.col("props").alias("traffic_source"),
        "user_first_touch_timestamp",
        F.col("user_id").cast("string").alias("user_id"),
    )
