"""Folders that hold one version of a table each, and the one that is live.

A table's location is the only pointer to its rows. A version is written to a folder of its own,
and one statement makes it live, so that every reader meets one version or the other, and a
failure at any point leaves a whole one behind.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from starloom.names import parts_of, quoted, sibling
from starloom.scratch import drop_folder
from starloom.sources.jdbc import sql_text

_VERSION = re.compile(r"/(version=[^/]+)(?:/|$)")


def location(spark: SparkSession, table: str) -> str | None:
    """Where the rows of a table lie; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row.col_name == "Location":
            return row.data_type.rstrip("/")
    return None


def _detail(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next((row.data_type for row in rows if row.col_name == name), None)


def versions_base(spark: SparkSession, table: str) -> str:
    """The folder beside a table's usual one that holds its versions."""
    *outer, name = parts_of(table)
    database = outer[-1] if outer else spark.catalog.currentDatabase()
    place = spark.catalog.getDatabase(quoted(database)).locationUri.rstrip("/")
    return f"{place}/{name}__versions"


def new_version(base: str) -> str:
    return f"{base}/version={uuid.uuid4().hex}"


def list_versions(spark: SparkSession, base: str) -> list[str]:
    """The names of the folders below ``base``, oldest first, by the times of their files.

    Only names are listed, one for each file of a version that has not been dropped.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
        found = (
            files.select(
                F.regexp_extract("path", r"/(version=[^/]+)/[^/]+$", 1).alias("name"),
                "modificationTime",
            )
            .where("name <> ''")
            .groupBy("name")
            .agg(F.max("modificationTime").alias("time"))
            .orderBy("time", "name")
        )
        return [row.name for row in found.collect()]
    except AnalysisException:
        return []


def live_version(spark: SparkSession, table: str) -> str | None:
    """The name of the folder that a table points to, if it is one of a version."""
    found = _VERSION.search(location(spark, table) or "")
    return found[1] if found else None


def drop_former(spark: SparkSession, table: str, base: str, keep: int = 1) -> list[str]:
    """Delete versions that a table no longer points to, and return their names.

    The live one always stays, whatever its age, and so do the ``keep - 1`` latest that were
    written before it. One that is newer than the live one may be on its way to become it and
    stays too. Folders that a failed attempt left behind go when they are old enough.
    """
    if keep < 1:
        raise ValueError("the version that is live is kept")
    names, live = list_versions(spark, base), live_version(spark, table)
    if live not in names:
        return []
    former = names[: names.index(live)]
    dropped = former[: len(former) - (keep - 1)]
    for name in dropped:
        drop_folder(spark, f"{base}/{name}")
    return dropped


def _same_layout(spark: SparkSession, table: str, schema: T.StructType, format: str) -> bool:
    held = spark.table(table).schema
    kinds = [[(f.name, f.dataType) for f in s.fields] for s in (held, schema)]
    return (
        kinds[0] == kinds[1]
        and (_detail(spark, table, "Provider") or "").lower() == format.lower()
        and _detail(spark, table, "# Partition Information") is None
    )


def restore(spark: SparkSession, table: str) -> bool:
    """Put a table back that was lost between two renames of :func:`publish`."""
    if spark.catalog.tableExists(table):
        return False
    *outer, name = parts_of(table)
    place = f" IN {quoted(outer[-1])}" if outer else ""
    for row in spark.sql(f"SHOW TABLES{place}").collect():
        if row.tableName.startswith(f"{name.lower()}__former_") and not row.isTemporary:
            former = ".".join([*map(quoted, outer), quoted(row.tableName)])
            spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
            return True
    return False


def publish(
    spark: SparkSession, table: str, folder: str, schema: T.StructType, format: str
) -> None:
    """Make the rows in ``folder`` those of ``table``.

    One statement does it: a table that is not there is created over the folder, one of the same
    columns and format is pointed to it. Only a table of other columns is replaced by two renames;
    if the second one fails the first is undone, and after a crash between them the next load, or
    :func:`restore`, does that.
    """
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=folder, source=format, schema=schema)
    elif _same_layout(spark, table, schema, format):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_text(folder)}")
    else:
        attempt = uuid.uuid4().hex
        staged, former = (sibling(table, f"__{kind}_{attempt}") for kind in ("load", "former"))
        spark.catalog.createTable(staged, path=folder, source=format, schema=schema)
        try:
            spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        finally:
            if not spark.catalog.tableExists(table):
                spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
            # All are created over paths, so dropping them deletes no rows.
            for left in (staged, former):
                spark.sql(f"DROP TABLE IF EXISTS {left}")
    spark.catalog.refreshTable(table)


def drop_replaced(spark: SparkSession, table: str, before: str | None, base: str) -> None:
    """Delete what a table held before it was published anew, if it was the library's to keep.

    That is its former versions, those of failed loads too, and the folder that Spark gave it.
    """
    drop_former(spark, table, base)
    usual = _without_scheme(base.removesuffix("__versions"))
    if before is not None and _without_scheme(before) == usual and live_version(spark, table):
        drop_folder(spark, before)


def _without_scheme(path: str) -> str:
    return "/" + re.sub(r"^[a-zA-Z][\w+.-]*:", "", path).lstrip("/")
