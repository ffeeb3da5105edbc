"""Bronze, silver and gold stages over a stream of events.

Each stage is a temporary view over the one before it, so that SQL and
DataFrame users meet the same stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.merge import merge
from starloom.operators.shape import count_by, drop_columns, with_audit_columns
from starloom.sinks.tables import create_database, drop_database
from starloom.sources.json import stream_json_lines, stream_table
from starloom.streaming.sinks import (
    DEFAULT_INTERVAL,
    append_to_files,
    append_to_table,
    replace_table,
)

# The names of the views and of the gold table.
BRONZE_VIEW = "bronze_temp"
ENHANCED_VIEW = "bronze_enhanced_temp"
SILVER_VIEW = "silver_temp"
COUNTS_VIEW = "customer_count_by_event_name_temp"
GOLD_TABLE = "gold_customer_count_by_event_name"


@dataclass(frozen=True)
class Layout:
    """Names and places of one pipeline; no two stages share one.

    Everything lies in a database of its own at ``location``, a folder that
    driver and executors share. ``prefix`` goes before the names of the views.
    ``queries`` are the streams that were started for it.
    """

    database: str
    location: str
    prefix: str = ""
    queries: list[StreamingQuery] = field(default_factory=list, compare=False, repr=False)

    def started(self, query: StreamingQuery) -> StreamingQuery:
        self.queries.append(query)
        return query

    @property
    def bronze_path(self) -> str:
        return f"{self.location}/bronze"

    @property
    def gold_path(self) -> str:
        return f"{self.location}/gold"

    @property
    def silver_table(self) -> str:
        return f"{self.database}.silver"

    @property
    def gold_table(self) -> str:
        return f"{self.database}.{GOLD_TABLE}"

    def checkpoint(self, stage: str) -> str:
        return f"{self.location}/checkpoints/{stage}"

    def view(self, name: str) -> str:
        return self.prefix + name


def create_layout(spark: SparkSession, database: str, location: str, prefix: str = "") -> Layout:
    """Create the database of a pipeline; fails if it exists."""
    create_database(spark, database, location)
    return Layout(database, location.rstrip("/"), prefix)


def clean_up(spark: SparkSession, layout: Layout) -> None:
    """Stop the pipeline's streams and remove its views, tables, files and checkpoints."""
    for query in layout.queries:
        query.stop()
    for name in (COUNTS_VIEW, SILVER_VIEW, ENHANCED_VIEW, BRONZE_VIEW):
        spark.catalog.dropTempView(layout.view(name))
    drop_database(spark, layout.database)


def bronze_view(
    spark: SparkSession,
    source: str,
    layout: Layout,
    max_files_per_trigger: int | None = 1,
) -> DataFrame:
    """The events as they arrive, exposed as the view ``bronze_temp``."""
    events = stream_json_lines(spark, source, max_files_per_trigger=max_files_per_trigger)
    bronze = drop_columns(events, ["_corrupt_record"], strict=False)
    bronze.createOrReplaceTempView(layout.view(BRONZE_VIEW))
    return bronze


def start_bronze(
    bronze: DataFrame,
    layout: Layout,
    name: str | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the events to parquet files."""
    return layout.started(
        append_to_files(
            bronze, layout.bronze_path, layout.checkpoint("bronze"), name, interval, available_now
        )
    )


def silver_view(spark: SparkSession, layout: Layout) -> DataFrame:
    """Events with a previous event, plus audit columns, as ``bronze_enhanced_temp``."""
    bronze = spark.table(layout.view(BRONZE_VIEW))
    silver = with_audit_columns(bronze.where(F.col("event_previous_timestamp") > 0))
    silver.createOrReplaceTempView(layout.view(ENHANCED_VIEW))
    return silver


def start_silver(
    silver: DataFrame,
    layout: Layout,
    interval: str | None = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the enhanced events to the silver table."""
    return layout.started(
        append_to_table(
            silver,
            layout.silver_table,
            layout.checkpoint("silver"),
            interval=interval,
            available_now=available_now,
        )
    )


def gold_view(spark: SparkSession, layout: Layout) -> DataFrame:
    """Number of silver events per name, as ``customer_count_by_event_name_temp``."""
    silver = stream_table(spark, layout.silver_table)
    silver.createOrReplaceTempView(layout.view(SILVER_VIEW))
    gold = count_by(spark.table(layout.view(SILVER_VIEW)), "event_name", "customer_count")
    gold.createOrReplaceTempView(layout.view(COUNTS_VIEW))
    return gold


def start_gold(
    gold: DataFrame,
    layout: Layout,
    interval: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the gold table equal to the counts so far."""
    return layout.started(
        replace_table(
            gold,
            layout.gold_table,
            layout.gold_path,
            layout.checkpoint("gold"),
            interval=interval,
            available_now=available_now,
        )
    )


def join_reference_data(stream: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    """Events joined with static rows; whether to broadcast is left to Spark's size check."""
    return merge(stream, reference, on)
