"""Where intermediate results are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def scratch_base(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    A cluster names it in ``spark.checkpoint.dir``; every executor must see it.
    Only a local session may fall back to a folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by driver and executors"
        )
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="starloom-")
    return _local_base


def _session_folder(spark: SparkSession) -> str:
    return f"{scratch_base(spark)}/starloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call has been given."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written to the shared folder.

    Frames that were built on it, such as numbered rows, can no longer be read;
    call this once the results are loaded.
    """
    drop_folder(spark, _session_folder(spark))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark writes to, by way of a database."""
    name, place = f"scratch_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")
