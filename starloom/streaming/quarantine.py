"""Event lines of which some are broken: whole ones are kept as rows, the others as text.

Both go through one stream and one sink, as two partitions of the same files. The sink commits a
batch as a whole, so a line is in one of the two exactly once, also after restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.names import quoted
from starloom.sources.json import EVENT_SCHEMA
from starloom.streaming.sinks import DEFAULT_INTERVAL, append_to_files

BROKEN, TEXT, FILE = "quarantined", "quarantined_text", "quarantined_file"
_CORRUPT = "_corrupt_record"


def _target(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def stream_checked_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = EVENT_SCHEMA,
    max_files_per_trigger: int | None = 1,
) -> DataFrame:
    """Lines of a growing directory with the fields of ``schema``, and whether they are broken.

    A line is broken if it is no JSON object or a field does not have its type. All fields of a
    broken line are null; its text and its file are kept. Blank lines are skipped.
    """
    target = _target(schema)
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path).select("value", F.col("_metadata.file_path").alias("file"))
    read = T.StructType([*target.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.where(F.trim("value") != "").select(
        "value", "file", F.from_json("value", read, options).alias("row")
    )
    broken = F.col("row").isNull() | F.col(f"row.{_CORRUPT}").isNotNull()
    return parsed.select(
        *[F.when(~broken, F.col("row")[f.name]).alias(f.name) for f in target.fields],
        F.when(broken, F.col("value")).alias(TEXT),
        F.when(broken, F.col("file")).alias(FILE),
        broken.alias(BROKEN),
    )


def start_with_quarantine(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the rows of :func:`stream_checked_lines` to files, broken ones apart."""
    return append_to_files(
        lines, path, checkpoint, name, interval, available_now, partition_by=[BROKEN]
    )


def _stored(spark: SparkSession, path: str, target: T.StructType) -> DataFrame:
    kept = [T.StructField(name, T.StringType()) for name in (TEXT, FILE)]
    schema = T.StructType([*target.fields, *kept, T.StructField(BROKEN, T.BooleanType())])
    return spark.read.schema(schema).parquet(path)


def read_accepted(
    spark: SparkSession, path: str, schema: T.StructType | str = EVENT_SCHEMA
) -> DataFrame:
    """The rows of whole lines; files of broken ones are not read."""
    target = _target(schema)
    rows = _stored(spark, path, target).where(~F.col(BROKEN))
    return rows.select(*[quoted(f.name) for f in target.fields])


def read_quarantined(
    spark: SparkSession, path: str, schema: T.StructType | str = EVENT_SCHEMA
) -> DataFrame:
    """``text, source_file`` of broken lines; files of whole ones are not read."""
    rows = _stored(spark, path, _target(schema)).where(F.col(BROKEN))
    return rows.select(F.col(TEXT).alias("text"), F.col(FILE).alias("source_file"))
