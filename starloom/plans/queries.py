"""The registered queries. Each takes a session and a folder of test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import (
    DATE_DIMENSION_SCHEMA,
    add_row_number,
    coerce_numbers,
    count_by,
    date_dimension,
    date_span,
    drop_columns,
    first_rows,
    grow_keys,
    ingestion_summary,
    insert_first,
    keep_first,
    key_violations,
    merge,
    move_to_front,
)
from starloom.plans import mart, stand_ins
from starloom.plans.stand_ins import table
from starloom.scratch import scratch_path
from starloom.sinks import (
    append_once,
    convert,
    create_database,
    csv_to_json,
    load_table,
    recreate_table,
    write_csv,
    write_json_array,
    write_json_lines,
    write_json_split,
)
from starloom.sources import (
    append_documents,
    create_foreign_table,
    read_collection,
    read_csv_text,
    read_csv_typed,
    read_json_array,
    read_json_lines,
    read_json_split,
    read_table,
    replace_collections,
    stream_json_lines,
)
from starloom.streaming import (
    Layout,
    append_to_files,
    bronze_view,
    clean_up,
    create_layout,
    finish,
    gold_view,
    join_reference_data,
    read_accepted,
    read_quarantined,
    silver_view,
    start_bronze,
    start_gold,
    start_silver,
    start_with_quarantine,
    stream_checked_lines,
)

Query = Callable[[SparkSession, str], DataFrame]

FILES_PER_TRIGGER = 1000

ORDER_FIELDS = (
    "o_orderkey bigint, custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate date, o_orderpriority string"
)
USER_FIELDS = (
    "custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
PRODUCT_FIELDS = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double"
)

EVENT_FIELDS = (
    "device string, ecommerce struct<order: bigint>, event_name string, "
    "event_previous_timestamp bigint, event_timestamp bigint, geo struct<city: string>, "
    "items array<struct<item: bigint>>, traffic_source string, "
    "user_first_touch_timestamp bigint, user_id string"
)


def _database(spark: SparkSession) -> str:
    """A new database in the shared folder."""
    name = f"starloom_{uuid.uuid4().hex}"
    create_database(spark, name, location=scratch_path(spark, "database"))
    return name


# Dates


def _order_days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    span = date_span(table(spark, sf_dir, "orders"), "o_orderdate")
    if span is None:
        raise ValueError("orders hold no date")
    return span


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(spark, *_order_days(spark, sf_dir))


def dim_date_lagging_fiscal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(spark, *_order_days(spark, sf_dir), fiscal_months_offset=-6)


def dim_date_empty_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = _order_days(spark, sf_dir)
    return date_dimension(spark, last + dt.timedelta(days=1), first)


def dim_date_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = _order_days(spark, sf_dir)
    middle = first + (last - first) / 2
    name = f"{_database(spark)}.dim_date"
    recreate_table(spark, name, DATE_DIMENSION_SCHEMA)
    load_table(date_dimension(spark, first, middle), name, "date_key", "update")
    later = date_dimension(spark, middle + dt.timedelta(days=1), last)
    load_table(later, name, "date_key", "update")
    return spark.table(name)


def dim_date_first_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(dim_date(spark, sf_dir), "date_key", 20)


# Star schema


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = stand_ins.users(spark, sf_dir)
    rows = mart.dimension(users, "user_key", "custkey", unique_order=True)
    name = f"{_database(spark)}.dim_users"
    load_table(rows, name, "user_key")
    return spark.table(name)


def dim_users_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indebted users are members first; with the others the dimension grows, numbers stay."""
    users = stand_ins.users(spark, sf_dir)
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    name = f"{_database(spark)}.dim_users"
    first = grow_keys(users.where(in_debt), None, "user_key", "custkey")
    load_table(first, name, "user_key", sort_by_key=True)
    load_table(grow_keys(users, spark.table(name), "user_key", "custkey"), name, "user_key")
    return spark.table(name)


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.dimension(
        stand_ins.products(spark, sf_dir),
        "product_key",
        "p_partkey",
        drop=["p_type"],
        numbers={"p_retailprice": "double"},
        unique_order=True,
    )


def fact_orders_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.joined_orders(
        stand_ins.orders(spark, sf_dir),
        stand_ins.users(spark, sf_dir),
        "custkey",
        "o_orderkey",
        unique_order=True,
    )


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.order_fact(fact_orders_joined(spark, sf_dir), "custkey")


def fact_orders_calendar_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact described by its calendar date."""
    joined = mart.joined_orders(
        stand_ins.orders(spark, sf_dir),
        stand_ins.users(spark, sf_dir),
        "custkey",
        "o_orderkey",
        date_key_mode="calendar",
        day="o_orderdate",
        unique_order=True,
    )
    return merge(mart.order_fact(joined, "custkey"), dim_date(spark, sf_dir), "date_key")


# Joins, keys and shaping


def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of urgent orders, and that of one user, are taken as unknown.

    So all urgent orders meet one user, and the result grows with the orders.
    """
    urgent = F.col("o_orderpriority") == "1-URGENT"
    orders = stand_ins.orders(spark, sf_dir).withColumn(
        "custkey", F.when(~urgent, F.col("custkey"))
    )
    users = stand_ins.users(spark, sf_dir).withColumn(
        "custkey", F.nullif(F.col("custkey"), F.lit(1))
    )
    return merge(orders, users, "custkey", null_safe=True)


def merge_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = stand_ins.orders(spark, sf_dir).withColumnRenamed("o_orderpriority", "label")
    right = stand_ins.users(spark, sf_dir).withColumnRenamed("c_mktsegment", "label")
    return merge(left, right, "custkey")


def key_violation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(stand_ins.orders(spark, sf_dir), "custkey")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered by type, of which there are a few hot ones, and within a type by id."""
    events = table(spark, sf_dir, "events")
    return add_row_number(events, "event_key", ["event_type", "event_id"])


def first_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def reshaped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_columns(stand_ins.orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])
    rows = move_to_front(rows, "o_orderdate")
    return insert_first(rows, "order_year", F.year("o_orderdate"))


def coerced_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small sizes are blanked, and blank text becomes a null number."""
    size = F.when(F.col("p_size") < 10, " ").otherwise(F.col("p_size").cast("string"))
    rows = stand_ins.products(spark, sf_dir).withColumn("p_size", size)
    return coerce_numbers(rows, {"p_size": "int", "p_retailprice": "double"})


def order_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(stand_ins.orders(spark, sf_dir), "o_orderkey", 5)


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion_summary(table(spark, sf_dir, "lineitem"))


# Formats


def csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    return read_csv_text(spark, path)


def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(stand_ins.orders(spark, sf_dir), path)
    return read_csv_typed(spark, path, ORDER_FIELDS)


def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks from files of any size, typed; an absent text stays apart from none."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return read_csv_typed(spark, path, fields, missing=())


def csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows end after three fields, another third have two fields more."""
    options = {
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    documents = table(spark, sf_dir, "documents")

    def line(*fields) -> Column:
        return F.to_csv(F.struct(*fields), options)

    third = F.col("doc_id") % 3
    short = line("doc_id", "text", "lang")
    full = line(*documents.columns)
    extra = line(F.lit('x,"y"').alias("x"), F.col("doc_id").alias("y"))
    longer = F.concat_ws(",", full, extra)
    written = F.when(third == 1, short).when(third == 2, longer).otherwise(full)
    # Files of a thousand ids, each with its header.
    files = (
        documents.groupBy(F.floor(F.col("doc_id") / 1000).alias("part"))
        .agg(F.collect_list(written).alias("lines"))
        .select(F.concat_ws("\n", F.lit(",".join(documents.columns)), F.col("lines")))
    )
    path = scratch_path(spark, "csv")
    files.write.option("maxRecordsPerFile", 1).text(path)
    rows = read_csv_text(spark, path, rest="rest")
    return rows.withColumn("rest", F.array_join("rest", "|"))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are found in the texts; NA stands for small sizes."""
    size = F.when(F.col("p_size") < 10, "NA").otherwise(F.col("p_size").cast("string"))
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "part").withColumn("p_size", size), path)
    return read_csv_typed(spark, path)


def csv_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts from CSV to JSON arrays, every value a string."""
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "json")
    documents = table(spark, sf_dir, "documents")
    write_csv(documents, source)
    csv_to_json(spark, source, target)
    fields = ", ".join(f"{name} string" for name in documents.columns)
    return read_json_array(spark, target, fields)


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are inferred from the lines; a date stays text."""
    path = scratch_path(spark, "json")
    write_json_lines(stand_ins.orders(spark, sf_dir), path)
    return read_json_lines(spark, path)


def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    write_json_array(table(spark, sf_dir, "documents"), path)
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return read_json_array(spark, path, fields)


def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files of over a megabyte, cut into their elements by many tasks."""
    path = scratch_path(spark, "json")
    write_json_array(table(spark, sf_dir, "documents"), path, bytes_per_file=1 << 30)
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return read_json_array(spark, path, fields, split_bytes=1 << 20)


def json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json") + ".gz"
    write_json_split(table(spark, sf_dir, "part"), path)
    return read_json_split(spark, path, PRODUCT_FIELDS)


def json_split_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by date and number, each with its position among all of them."""
    path = scratch_path(spark, "json")
    write_json_split(stand_ins.orders(spark, sf_dir), path, order_by=["o_orderdate", "o_orderkey"])
    return read_json_split(spark, path, ORDER_FIELDS, position="place")


def json_split_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct and an array among the cells."""
    path = scratch_path(spark, "json")
    nested = table(spark, sf_dir, "part").select(
        "*",
        F.struct("p_brand", "p_size").alias("detail"),
        F.array("p_type", "p_name").alias("words"),
    )
    write_json_split(nested, path)
    fields = f"{PRODUCT_FIELDS}, detail struct<p_brand: string, p_size: int>, words array<string>"
    return read_json_split(spark, path, fields).select(
        "*",
        F.col("detail.p_brand").alias("detail_brand"),
        F.col("detail.p_size").alias("detail_size"),
        F.col("words")[0].alias("first_word"),
        F.col("words")[1].alias("second_word"),
    ).drop("detail", "words")


def converted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events as JSON lines, CSV, split JSON and parquet in turn."""
    steps = ["json", "csv", "json_split", "parquet"]
    places = {step: scratch_path(spark, step) for step in steps}
    write_json_lines(stand_ins.events(spark, sf_dir), places["json"])
    for source, target in zip(steps, steps[1:]):
        convert(spark, places[source], source, places[target], target, EVENT_FIELDS)
    return spark.read.parquet(places["parquet"]).select(
        "device",
        F.col("ecommerce.order").alias("order_id"),
        "event_name",
        "event_previous_timestamp",
        "event_timestamp",
        F.col("geo.city").alias("city"),
        F.col("items")[0]["item"].alias("item"),
        F.size("items").alias("item_count"),
        "traffic_source",
        "user_first_touch_timestamp",
        "user_id",
    )


def converted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV, split JSON, JSON arrays, a table, JSON lines and parquet in turn."""
    steps = ["csv", "json_split", "json_array", "table", "json", "parquet"]
    places = {step: scratch_path(spark, step) for step in steps}
    places["table"] = f"{_database(spark)}.orders"
    write_csv(stand_ins.orders(spark, sf_dir), places["csv"])
    for source, target in zip(steps, steps[1:]):
        schema = None if source == "table" else ORDER_FIELDS
        convert(spark, places[source], source, places[target], target, schema)
    return spark.read.parquet(places["parquet"])


# Documents and tables


def replaced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second upload replaces the first."""
    arrays, store = scratch_path(spark, "json"), scratch_path(spark, "store")
    write_json_array(table(spark, sf_dir, "part"), arrays)
    for _ in range(2):
        replace_collections(
            spark, store, {"products": arrays}, schemas={"products": PRODUCT_FIELDS}
        )
    return read_collection(spark, store, "products", schema=PRODUCT_FIELDS)


def appended_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second upload adds the same documents again; ids are kept."""
    store = scratch_path(spark, "store")
    documents = stand_ins.users(spark, sf_dir).withColumn("_id", F.col("c_name"))
    for _ in range(2):
        append_documents(documents, store, "users")
    return read_collection(
        spark, store, "users", drop_id=False, schema=f"_id string, {USER_FIELDS}"
    )


def appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two uploads to a table and to a collection, each repeated; all rows are there once."""
    rows = stand_ins.users(spark, sf_dir)
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    table_name, store = f"{_database(spark)}.users", scratch_path(spark, "store")
    for token, part in (("first", rows.where(in_debt)), ("second", rows.where(~in_debt))) * 2:
        append_once(part, table_name, "custkey", token)
        append_documents(part, store, "users", token=token)
    loaded = spark.table(table_name).withColumn("kept_in", F.lit("table"))
    documents = read_collection(spark, store, "users", schema=USER_FIELDS)
    documents = documents.withColumn("load_token", F.lit("-")).withColumn("kept_in", F.lit("store"))
    return loaded.unionByName(documents)


def matching_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch_path(spark, "store")
    append_documents(stand_ins.users(spark, sf_dir), store, "users")
    return read_collection(
        spark, store, "users", where={"c_mktsegment": "BUILDING"}, schema=USER_FIELDS
    )


def updated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indebted users are loaded first and the others appended."""
    rows = stand_ins.users(spark, sf_dir)
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    name = f"{_database(spark)}.users"
    load_table(rows, name, "custkey")
    load_table(rows.where(in_debt), name, "custkey")
    load_table(rows.where(~in_debt), name, "custkey", "update")
    return spark.table(name)


def foreign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared over rows that stay in their files."""
    name = f"{_database(spark)}.lineitem"
    path = f"{sf_dir}/lineitem.parquet"
    return create_foreign_table(spark, name, {"path": path}, provider="parquet")


# Streams


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "events")
    stand_ins.events(spark, sf_dir).write.json(path)
    return path


def _layout(spark: SparkSession) -> Layout:
    name = f"starloom_{uuid.uuid4().hex}"
    return create_layout(spark, name, scratch_path(spark, "medallion"), prefix=f"{name}_")


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream is started twice; the checkpoint keeps rows from being added twice."""
    layout = _layout(spark)
    bronze = bronze_view(spark, _event_files(spark, sf_dir), layout, FILES_PER_TRIGGER)
    for _ in range(2):
        finish(start_bronze(bronze, layout, available_now=True))
    return spark.read.parquet(layout.bronze_path)


def _silver(spark: SparkSession, source: str, layout: Layout) -> DataFrame:
    bronze_view(spark, source, layout, FILES_PER_TRIGGER)
    finish(start_silver(silver_view(spark, layout), layout, available_now=True))
    return read_table(spark, layout.silver_table)


def events_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and file of receipt differ from run to run.

    So it is told whether there is a time, and whether the file is one of the stream's.
    """
    source = _event_files(spark, sf_dir)
    silver = _silver(spark, source, _layout(spark))
    files = spark.read.text(source).select(F.input_file_name().alias("file")).distinct()
    known = silver.join(files, silver.source_file == files.file, "left")
    return known.select(
        *[name for name in silver.columns if name not in ("receipt_time", "source_file")],
        F.col("receipt_time").isNotNull().alias("has_receipt_time"),
        F.col("file").isNotNull().alias("has_source_file"),
    )


def events_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark)
    _silver(spark, _event_files(spark, sf_dir), layout)
    finish(start_gold(gold_view(spark, layout), layout, available_now=True))
    return read_table(spark, layout.gold_table)


def events_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line in eleven breaks off. The stream is started twice; every line is kept once."""
    source = scratch_path(spark, "events")
    lines = stand_ins.events(spark, sf_dir).select(
        F.to_json(F.struct("*")).alias("value"), F.col("ecommerce.order").alias("number")
    )
    broken = lines.where(F.col("number") % 10 == 0).select(
        F.format_string('{"device": "none", "event_name": "%d', "number").alias("value")
    )
    lines.select("value").unionByName(broken).write.text(source)
    path, checkpoint = scratch_path(spark, "checked"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        checked = stream_checked_lines(spark, source, max_files_per_trigger=FILES_PER_TRIGGER)
        finish(start_with_quarantine(checked, path, checkpoint, available_now=True))
    kept = read_accepted(spark, path).withColumn("text", F.lit(None).cast("string"))
    return kept.unionByName(
        read_quarantined(spark, path).select("text"), allowMissingColumns=True
    )


def cleaned_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages held, and what is left of them after the clean-up."""
    layout = _layout(spark)
    _silver(spark, _event_files(spark, sf_dir), layout)
    finish(start_gold(gold_view(spark, layout), layout, available_now=True))
    gold = spark.table(layout.gold_table).agg(F.sum("customer_count")).first()[0]
    views = [t.name for t in spark.catalog.listTables() if t.name.startswith(layout.prefix)]
    tables = [t.name for t in spark.catalog.listTables(layout.database) if not t.isTemporary]
    before = (gold, len(views), len(tables))
    clean_up(spark, layout)
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith(layout.prefix)]
    running = sum(query.isActive for query in layout.queries)
    exists = spark.catalog.databaseExists(layout.database)
    return spark.createDataFrame(
        [(*before, len(left), int(exists), running)],
        "counted bigint, views int, tables int, views_left int, databases_left int, running int",
    )


def gold_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors lose their name; their group counts 0."""
    name = F.nullif(F.col("event_type"), F.lit("error")).alias("event_name")
    return count_by(table(spark, sf_dir, "events").select(name), "event_name", "customer_count")


def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_json_lines(
        spark, _event_files(spark, sf_dir), max_files_per_trigger=FILES_PER_TRIGGER
    )
    reference = stand_ins.users(spark, sf_dir).withColumnRenamed("custkey", "user_id")
    reference = reference.withColumn("user_id", F.col("user_id").cast("string"))
    path = scratch_path(spark, "joined")
    checkpoint = scratch_path(spark, "checkpoint")
    joined = join_reference_data(events, reference, "user_id")
    finish(append_to_files(joined, path, checkpoint, available_now=True))
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        dim_date,
        dim_date_lagging_fiscal,
        dim_date_empty_range,
        dim_date_extend,
        dim_date_first_20,
        dim_users,
        dim_users_grown,
        dim_products,
        fact_orders_joined,
        fact_orders,
        fact_orders_calendar_key,
        merge_null_safe,
        merge_suffixes,
        key_violation_report,
        numbered_events,
        first_event_per_user,
        reshaped_orders,
        coerced_prices,
        order_preview,
        ingest_summary,
        csv_text,
        csv_typed,
        csv_multiline,
        csv_ragged,
        csv_inferred,
        csv_as_json,
        json_lines,
        json_array,
        json_array_split,
        json_split,
        json_split_indexed,
        json_split_nested,
        converted_orders,
        converted_events,
        replaced_documents,
        appended_documents,
        appended_once,
        matching_documents,
        updated_table,
        foreign_table,
        events_bronze,
        events_silver,
        events_gold,
        events_quarantine,
        cleaned_up,
        gold_null_group,
        stream_static_join,
    ]
}
