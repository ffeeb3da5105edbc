"""JSON scans in three layouts, and the event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.scratch import scratch_path
from starloom.sources.records import JsonElements, find_splits, read_records

# Extensions of compressed files.
COMPRESSED = (".gz", ".bz2", ".zst", ".xz", ".lz4", ".snappy", ".deflate", ".lzo")

# The event schema. Nested objects stay JSON text.
EVENT_SCHEMA = (
    "device string, ecommerce string, event_name string, "
    "event_previous_timestamp long, event_timestamp long, geo string, "
    "items string, traffic_source string, user_first_touch_timestamp long, "
    "user_id string"
)


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """One object per line. Without a schema Spark infers one in an extra pass.

    ``mode`` says what becomes of a broken line: a row of nulls, or with ``FAILFAST`` an error.
    """
    reader = spark.read.option("mode", mode)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Files that each hold one array of objects, pretty or not. A broken file fails.

    Files of more than ``split_bytes``, by default what Spark reads in one task, are cut into
    elements by many tasks; compressed ones cannot be, and others need not. Without a schema
    Spark infers one in an extra pass, for which the elements of cut files are written once.
    """
    if split_bytes is None:
        split_bytes = _bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    # A name per file, as the driver lists them for every scan.
    sizes = {name: size for name, size in files.collect() if size}
    large = [
        name
        for name, size in sizes.items()
        if size > split_bytes and not name.endswith(COMPRESSED)
    ]
    if not large:
        return _whole_arrays(spark, path, schema)
    small = sorted(set(sizes) - set(large))
    elements = _elements(spark, large)
    if schema is None:
        # One to a line: a line break is never part of a JSON string.
        place = scratch_path(spark, "elements")
        elements.select(F.translate("text", "\r\n", "  ")).write.text(place)
        lines = spark.read.json(place, mode="FAILFAST")
        if not small:
            return lines
        whole = _whole_arrays(spark, small, None)
        schema = _merged(lines.schema, whole.schema)
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = elements.select(F.from_json("text", target, {"mode": "FAILFAST"}).alias("row"))
    rows = rows.select(*[F.col("row")[f.name].alias(f.name) for f in target.fields])
    return rows.unionByName(_whole_arrays(spark, small, target)) if small else rows


def _whole_arrays(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None
) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader if schema is None else reader.schema(schema)).json(path)


def _elements(spark: SparkSession, path: list[str]) -> DataFrame:
    """``text`` of every object of arrays; between two stands a comma and nothing else."""
    grammar = JsonElements()
    records = read_records(spark, path, grammar, find_splits(spark, path, grammar))
    found = F.regexp_extract("text", r"(?s)^\s*+,?\s*+(\{.*)$", 1)
    begun = F.regexp_extract("text", r"(?s)^\ufeff?\s*+\[\s*+(\{.*)$", 1)
    text = F.when(F.col("first"), begun).when(F.trim("text").startswith("{"), F.lit("")).otherwise(found)
    told = F.concat(F.lit("not an array of objects: "), F.left("text", F.lit(100)))
    return records.select(
        F.when(text == "", F.raise_error(told).cast("string")).otherwise(text).alias("text")
    )


def _merged(one: T.StructType, other: T.StructType) -> T.StructType:
    """Fields of both schemas; those that differ are read as text."""
    kinds = {f.name: f for f in one.fields}
    for field in other.fields:
        known = kinds.setdefault(field.name, field)
        if known.dataType != field.dataType:
            wider = {known.dataType, field.dataType} == {T.LongType(), T.DoubleType()}
            kinds[field.name] = T.StructField(
                field.name, T.DoubleType() if wider else T.StringType()
            )
    return T.StructType(sorted(kinds.values(), key=lambda f: f.name))


def _bytes_of(size: str) -> int:
    """A size as Spark writes it, such as 128MB or 134217728b."""
    digits = size.rstrip("bBkKmMgGtT")
    unit = size[len(digits) :].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def read_json_split(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    position: str | None = None,
) -> DataFrame:
    """Documents of the form ``{"columns": [...], "data": [[...], ...]}``, one per line.

    Each column's position is looked up once per document. Cells are cast to ``schema``, nested
    ones parsed. A column that a document lacks is null; a broken document fails. ``position``
    names a column, put in front, for the rows' positions in ``index``; a document with more or
    fewer positions than rows fails then. Rows of a document keep their order.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if position in target.names:
        raise ValueError(f"column exists already: {position}")
    layout = "columns array<string>, data array<array<string>>"
    if position:
        layout += ", index array<bigint>"
    documents = spark.read.schema(layout).option("mode", "FAILFAST").json(path)
    places = F.array(*[F.array_position("columns", F.lit(f.name)) for f in target.fields])
    if position:
        told = F.lit("a document has more or fewer positions than rows")
        positions = F.when(F.size("index") == F.size("data"), F.col("index")).otherwise(
            F.raise_error(told).cast("array<bigint>")
        )
        paired = documents.select(places.alias("places"), positions.alias("index"), "data")
        rows = paired.select("places", F.explode(F.arrays_zip("index", "data")).alias("row"))
        rows = rows.select("places", "row.index", F.col("row.data").alias("cells"))
    else:
        rows = documents.select(places.alias("places"), F.explode("data").alias("cells"))

    def value(place: int, field: T.StructField) -> Column:
        at = F.col("places")[place]
        cell = F.when(at > 0, F.get("cells", (at - 1).cast("int")))
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(cell, field.dataType, {"mode": "FAILFAST"}).alias(field.name)
        return cell.cast(field.dataType).alias(field.name)

    first = [F.col("index").alias(position)] if position else []
    return rows.select(*first, *[value(place, field) for place, field in enumerate(target.fields)])


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = EVENT_SCHEMA,
    max_files_per_trigger: int | None = 1,
) -> DataFrame:
    """An unbounded scan of a growing directory of JSON-lines files.

    Raise ``max_files_per_trigger`` for large inputs: with 1, a batch is never
    more than one file.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def stream_table(spark: SparkSession, table: str) -> DataFrame:
    """New rows of a table, as an unbounded scan."""
    return spark.readStream.table(table)
