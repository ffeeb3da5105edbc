"""Streaming sinks and the life of their queries."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from starloom.sinks.versions import drop_former
from starloom.sources.jdbc import sql_text

DEFAULT_INTERVAL = "5 seconds"
POLL_SECONDS = 0.1


def _writer(
    stream: DataFrame,
    checkpoint: str,
    output_mode: str,
    name: str | None,
    interval: str | None,
    available_now: bool,
) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer if interval is None else writer.trigger(processingTime=interval)


def append_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    available_now: bool = False,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Add new rows to the files of a directory, each exactly once per checkpoint."""
    writer = _writer(stream, checkpoint, "append", name, interval, available_now)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.format(format).start(path)


def append_to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    available_now: bool = False,
    format: str = "parquet",
) -> StreamingQuery:
    """Add new rows to a table, each exactly once per checkpoint."""
    writer = _writer(stream, checkpoint, "append", name, interval, available_now)
    return writer.format(format).toTable(table)


def replace_table(
    stream: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = None,
    available_now: bool = False,
    format: str = "parquet",
) -> StreamingQuery:
    """Make a table equal to the whole aggregate after every batch.

    File formats take no complete-mode stream. So each attempt at a batch is
    written to a folder of its own below ``path`` and the table pointed to it,
    which readers meet as one step. Former folders stay, so a slow reader and a
    repeated batch disturb nothing, until :func:`drop_versions` is called.
    """
    session = stream.sparkSession

    def publish(batch: DataFrame, batch_id: int) -> None:
        place = f"{path}/version={batch_id}-{uuid.uuid4().hex}"
        batch.write.format(format).save(place)
        if session.catalog.tableExists(table):
            session.sql(f"ALTER TABLE {table} SET LOCATION {sql_text(place)}")
        else:
            session.catalog.createTable(table, path=place, source=format, schema=batch.schema)
        session.catalog.refreshTable(table)

    writer = _writer(stream, checkpoint, "complete", name, interval, available_now)
    return writer.foreachBatch(publish).start()


def drop_versions(spark: SparkSession, table: str, path: str, keep: int = 1) -> list[str]:
    """Delete the folders of :func:`replace_table` but the ``keep`` latest ones.

    Which one is live is read from the table itself, and what there is from the folders, so that
    nothing is noted per batch and no crash can make the two disagree. Call it when no reader
    that began before the kept ones is left.
    """
    return drop_former(spark, table, path.rstrip("/"), keep)


def wait_until_ready(query: StreamingQuery, timeout: float = 60.0) -> None:
    """Return once the query has done a batch; raise its error, or TimeoutError."""
    deadline = time.monotonic() + timeout
    while query.lastProgress is None:
        error = query.exception()
        if error is not None:
            raise error
        if not query.isActive:
            return
        if time.monotonic() > deadline:
            raise TimeoutError(f"no batch within {timeout} seconds")
        time.sleep(POLL_SECONDS)


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an ``available_now`` query to end; raise its error, or TimeoutError."""
    if query.awaitTermination(timeout) is False:
        raise TimeoutError(f"not finished within {timeout} seconds")


def stop_all(spark: SparkSession) -> None:
    """Stop every stream of the session."""
    for query in spark.streams.active:
        query.stop()
