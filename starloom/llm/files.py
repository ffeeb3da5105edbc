"""Binary files through Spark's own writer and reader, on any file system it knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(df: DataFrame, path: str, ending: bytes) -> None:
    """Write each row of a binary column as a file that ends with ``ending``.

    The text writer puts a separator behind each row; with one row a file, that is the file's
    last field, such as a format's closing magic number. Files appear when their task commits,
    so a lost executor leaves none behind.
    """
    (
        df.select(F.col(df.columns[0]).cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", ending.decode("latin-1"))
        .text(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every file that is not empty."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    return files.select("path", "content")
