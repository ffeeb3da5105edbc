"""Loading warehouse tables with a checked primary key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.names import column, quoted
from starloom.operators.keys import check_new_keys, check_primary_key
from starloom.scratch import drop_folder, scratch_path
from starloom.sinks.versions import (
    drop_replaced,
    live_version,
    location,
    new_version,
    publish,
    restore,
    versions_base,
)
from starloom.sources.jdbc import Ranges, read_database, sql_text

#: The column by which tables of :func:`append_once` are partitioned.
TOKEN = "load_token"


def create_database(
    spark: SparkSession, name: str, location: str | None = None, use: bool = False
) -> None:
    """Create a database, failing if it exists, and optionally make it current."""
    place = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE `{name}`{place}")
    if use:
        spark.sql(f"USE `{name}`")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables; the default one is refused."""
    if name.strip("`").lower() == "default":
        raise ValueError("the default database is not dropped")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def recreate_table(
    spark: SparkSession, table: str, schema: T.StructType, format: str = "parquet"
) -> None:
    """Make a table empty, with these columns; rows and columns that it had are gone.

    A table of the same columns is pointed to an empty folder in one statement, so that it is
    never missing; a definition that cannot be written leaves it as it was.
    """
    restore(spark, table)
    base, before = versions_base(spark, table), location(spark, table)
    folder = new_version(base)
    spark.createDataFrame([], schema).write.format(format).save(folder)
    _publish(spark, table, folder, schema, format, base, before)


def _publish(spark, table, folder, schema, format, base, before) -> None:
    try:
        publish(spark, table, folder, schema, format)
    finally:
        # A statement that fails may have done its work.
        if not folder.endswith(f"/{live_version(spark, table)}"):
            drop_folder(spark, folder)
    drop_replaced(spark, table, before, base)


def write_by_key(df: DataFrame, key: str | Sequence[str], format: str = "parquet"):
    """A writer of files that are sorted by key and whose ranges of it do not overlap.

    Parquet files get Bloom filters of the key columns too. Checks of new keys, and joins on few
    keys, then read only the files that may hold them.
    """
    names = [key] if isinstance(key, str) else list(key)
    columns = [column(name) for name in names]
    writer = df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.format(format)
    if format == "parquet":
        for name in names:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    return writer


def load_table(
    df: DataFrame,
    table: str,
    key: str | Sequence[str],
    operation: str = "insert",
    format: str = "parquet",
    sort_by_key: bool = False,
) -> None:
    """Replace (``insert``) or extend (``update``) a table with rows of unique key.

    The rows are computed once, into a folder of their own. Their keys are checked there, reading
    the key columns only, and these very rows are published: a table is pointed to the folder in
    one statement, or gets the rows in one append. Until then it stays as it was, whatever fails.
    ``sort_by_key`` writes them as :func:`write_by_key` does, which costs a shuffle and saves
    reading the whole table at later updates.
    """
    spark = df.sparkSession
    if operation not in ("insert", "update"):
        raise ValueError(f"operation is insert or update, not {operation}")
    restore(spark, table)
    base, before = versions_base(spark, table), location(spark, table)
    appended = operation == "update" and before is not None
    folder = new_version(base)
    # Ranges are sampled before rows are written, so what is sorted has to be computed before.
    aside = appended or sort_by_key
    staged = scratch_path(spark, "load") if aside else folder

    def writer(rows: DataFrame):
        return write_by_key(rows, key, format) if sort_by_key else rows.write.format(format)

    try:
        df.write.format(format).save(staged)
        rows = spark.read.format(format).schema(df.schema).load(staged)
        check_primary_key(rows, key)
        if appended:
            check_new_keys(rows, spark.table(table), key)
            writer(rows).mode("append").saveAsTable(table)
        elif aside:
            writer(rows).save(folder)
    except Exception:
        drop_folder(spark, folder)
        raise
    finally:
        if aside:
            drop_folder(spark, staged)
    if appended:
        return
    _publish(spark, table, folder, rows.schema, format, base, before)


def append_once(
    df: DataFrame,
    table: str,
    key: str | Sequence[str],
    token: str,
    format: str = "parquet",
) -> bool:
    """Add rows to a table unless rows of this ``token`` are there; whether they were added.

    The table is partitioned by a column ``load_token``. Every attempt writes to a folder of its
    own, and the statement that adds it as the token's partition is both the commit of the rows
    and the note that they are in, so a load that is repeated, after a crash at any point too,
    adds nothing twice. Keys are checked as :func:`load_table` checks them.
    """
    spark = df.sparkSession
    if TOKEN in df.columns:
        raise ValueError(f"column exists already: {TOKEN}")
    if not spark.catalog.tableExists(table):
        schema = T.StructType([*df.schema.fields, T.StructField(TOKEN, T.StringType())])
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {format} "
            f"PARTITIONED BY ({quoted(TOKEN)})"
        )
    elif TOKEN not in spark.table(table).columns:
        raise ValueError(f"no table of tokens: {table}")
    partition = f"PARTITION ({quoted(TOKEN)} = {sql_text(token)})"
    if spark.sql(f"SHOW PARTITIONS {table} {partition}").take(1):
        return False
    expected = [f for f in spark.table(table).schema.fields if f.name != TOKEN]
    if [f.name for f in expected] != df.columns:
        df = df.select(*[quoted(f.name) for f in expected])
    folder = new_version(versions_base(spark, table))
    try:
        df.write.format(format).save(folder)
        rows = spark.read.format(format).schema(df.schema).load(folder)
        check_primary_key(rows, key)
        check_new_keys(rows, spark.table(table), key)
        spark.sql(f"ALTER TABLE {table} ADD {partition} LOCATION {sql_text(folder)}")
    except Exception:
        if not spark.sql(f"SHOW PARTITIONS {table} {partition}").take(1):
            drop_folder(spark, folder)
        raise
    spark.catalog.refreshTable(table)
    return True


def load_database_table(
    df: DataFrame,
    url: str,
    table: str,
    key: str | Sequence[str],
    properties: Mapping[str, str],
    operation: str = "insert",
    connections: int = 8,
    ranges: Ranges | None = None,
    predicates: Sequence[str] | None = None,
    column_types: str | None = None,
) -> None:
    """As :func:`load_table`, into a table of a database over JDBC.

    The rows are computed once, into the shared folder. ``connections`` bounds the tasks that
    write at once. An ``update`` needs the table to be there; ``ranges`` or ``predicates`` split
    the read of its keys over connections, of which it takes one without. The database is
    written as its driver does it: a failed ``insert`` may leave it empty. Spark cannot declare
    a key; :func:`primary_key_statement` gives the statement to run in the database, and
    ``column_types`` sets the types that the key needs, as in ``name VARCHAR(60)``.
    """
    spark = df.sparkSession
    if operation not in ("insert", "update"):
        raise ValueError(f"operation is insert or update, not {operation}")
    staged = scratch_path(spark, "load")
    try:
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        check_primary_key(rows, key)
        if operation == "update":
            existing = read_database(spark, url, table, properties, ranges, predicates)
            check_new_keys(rows, existing, key)
        mode = "overwrite" if operation == "insert" else "append"
        writer = rows.write.mode(mode).option("numPartitions", connections)
        if column_types and operation == "insert":
            writer = writer.option("createTableColumnTypes", column_types)
        writer.jdbc(url, table, properties=dict(properties))
    finally:
        drop_folder(spark, staged)


def primary_key_statement(table: str, key: str | Sequence[str], quote: str = "`") -> str:
    """The statement that declares the key of a loaded table in its database.

    ``quote`` is the mark that the database puts around names.
    """
    keys = [key] if isinstance(key, str) else list(key)
    listed = ", ".join(quote + name.replace(quote, quote * 2) + quote for name in keys)
    return f"ALTER TABLE {table} ADD PRIMARY KEY ({listed})"
