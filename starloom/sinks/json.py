"""JSON exports. Every layout is written in parallel, one part file per task."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.keys import add_row_number
from starloom.sources.csv import read_csv_text

# File name extensions and the codecs they stand for.
CODECS = {
    ".gz": "gzip",
    ".bz2": "bzip2",
    ".zst": "zstd",
}

# About the bytes that tasks join at once: a line of an array file has as many or more, unless it
# is the last.
LINE_BYTES = 1 << 20

# Extensions of compressed files that Spark cannot write.
OTHER_ARCHIVES = (".zip", ".xz", ".tar", ".tar.gz", ".tar.bz2", ".tar.xz", ".tar.zst", ".7z")


def codec_for(path: str, compression: str = "infer") -> str:
    """The codec that ``infer`` finds in the extension of ``path``."""
    if compression != "infer":
        return compression
    if path.lower().endswith(OTHER_ARCHIVES):
        raise ValueError(f"no codec writes {path}; name another file or a compression")
    return next((codec for end, codec in CODECS.items() if path.endswith(end)), "none")


def write_json_lines(
    df: DataFrame, path: str, compression: str = "infer", mode: str = "errorifexists"
) -> None:
    """One object per line, null fields included."""
    (
        df.write.mode(mode)
        .option("compression", codec_for(path, compression))
        .option("ignoreNullFields", False)
        .json(path)
    )


def _record(df: DataFrame, pretty: bool) -> Column:
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return F.to_json(F.struct(*[f"`{name}`" for name in df.columns]), options)


def write_json_array(
    df: DataFrame,
    path: str,
    pretty: bool = True,
    compression: str = "infer",
    rows_per_file: int = 250_000,
    mode: str = "errorifexists",
    bytes_per_file: int = 64 << 20,
) -> None:
    """Files that are each one array of objects, null fields included.

    A file holds at most ``rows_per_file`` objects and, unless one object is longer, about
    ``bytes_per_file`` bytes, however uneven the partitions are, as a reader parses it whole. A
    task passes it on in lines of about a megabyte, so that its memory does not grow with files.
    """

    # A file is so many lines: all but the last of an array hold that many bytes or more, and empty
    # ones behind an array that ends early fill it up, as Spark counts lines to begin a file.
    lines_per_file = max(1, -(-bytes_per_file // LINE_BYTES))
    line_bytes = LINE_BYTES

    # Defined here so that it travels to executors that lack this package.
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []  # Of the line that is next.
        rows = size = line = lines = 0
        written = False

        def values(texts: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([texts], ["value"])

        def joined(end: str) -> pa.RecordBatch:
            records = pa.concat_arrays([pa.array([], pa.string()), *held])
            whole = pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)
            text = pc.binary_join(whole, ",\n")
            return values(pc.binary_join_element_wise("" if lines else "[", text, end, ""))

        for batch in batches:
            records = batch.column(0)
            # The bytes up to each record, with what stands between two.
            ends = np.cumsum(pc.binary_length(records).to_numpy() + 2, dtype=np.int64)
            start = 0
            while start < len(records):
                before = int(ends[start - 1]) if start else 0
                fitting = int(np.searchsorted(ends, before + bytes_per_file - size, "right"))
                end = min(start + rows_per_file - rows, fitting)
                if end <= start and not rows:
                    end = start + 1  # One that is longer than a file should be.
                if end <= start:
                    yield joined("]")
                    yield values(pa.array([""] * (lines_per_file - lines - 1), pa.string()))
                    held, rows, size, line, lines, written = [], 0, 0, 0, 0, True
                    continue
                if line >= line_bytes:
                    yield joined(",")
                    held, line, lines = [], 0, lines + 1
                end = min(end, int(np.searchsorted(ends, before + line_bytes - line)) + 1)
                held.append(records.slice(start, end - start))
                taken = int(ends[end - 1]) - before
                rows, size, line, start = rows + end - start, size + taken, line + taken, end
        if rows or not written:
            yield joined("]")

    records = df.select(_record(df, pretty).alias("value"))
    (
        records.mapInArrow(arrays, "value string")
        .write.mode(mode)
        .option("maxRecordsPerFile", lines_per_file)
        .option("compression", codec_for(path, compression))
        .text(path)
    )


def _cells(df: DataFrame) -> Column:
    """The values of a row as the text of a JSON array of mixed types."""
    options = {"ignoreNullFields": "false"}

    def cell(name: str) -> Column:
        boxed = F.to_json(F.array(f"`{name}`"), options)
        return F.substring(boxed, F.lit(2), F.length(boxed) - 2)

    return F.concat(F.lit("["), F.concat_ws(",", *[cell(name) for name in df.columns]), F.lit("]"))


def write_json_split(
    df: DataFrame,
    path: str,
    compression: str = "infer",
    rows_per_document: int = 1000,
    mode: str = "errorifexists",
    order_by: str | Sequence[str | Column] | None = None,
) -> None:
    """Documents of column names, row positions and rows of values, one per line.

    A document holds at most ``rows_per_document`` rows, so that none outgrows memory and the
    files stay splittable. With ``order_by`` positions count all rows from 0 in that order, over
    all documents, and a document holds rows that follow each other; without, they count within
    a document.
    """
    columns, line_bytes = json.dumps(df.columns), LINE_BYTES
    cells = _cells(df).alias("value")
    if order_by is None:
        rows = df.select(cells, F.lit(None).cast("long").alias("position"))
    else:
        name = "position"
        while name in df.columns:
            name += "_"
        numbered = add_row_number(df, name, order_by, start=0)
        rows = numbered.select(cells, F.col(name).alias("position"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(values: pa.Array, positions: pa.Array) -> pa.RecordBatch:
            sizes = [min(rows_per_document, len(values) - i) for i in range(0, len(values), rows_per_document)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32())
            if positions.null_count:
                positions = pa.array(np.concatenate([np.arange(n) for n in sizes]), pa.int64())
            texts = [
                pc.binary_join(pa.ListArray.from_arrays(offsets, part), ",")
                for part in (positions.cast(pa.string()), values)
            ]
            parts = [f'{{"columns":{columns},"index":[', texts[0], '],"data":[', texts[1], "]}", ""]
            return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*parts)], ["value"])

        held: list[tuple[pa.Array, pa.Array]] = []
        rows = 0
        def parts() -> Iterator[pa.RecordBatch]:
            """Batches, which are bounded by rows, cut into about a megabyte."""
            for batch in batches:
                sizes = pc.binary_length(batch["value"]).to_numpy().astype(np.int64)
                cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // line_bytes)) + 1
                for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                    yield batch.slice(low, high - low)

        for part in parts():
            held.append((part["value"], part["position"]))
            rows += part.num_rows
            if rows >= rows_per_document:
                values, positions = (pa.concat_arrays(x) for x in zip(*held))
                full = rows - rows % rows_per_document
                yield made(values.slice(0, full), positions.slice(0, full))
                held, rows = [(values.slice(full), positions.slice(full))], rows - full
        if rows:
            yield made(*(pa.concat_arrays(x) for x in zip(*held)))

    (
        rows.mapInArrow(documents, "value string")
        .write.mode(mode)
        .option("compression", codec_for(path, compression))
        .text(path)
    )


def csv_to_json(
    spark: SparkSession,
    csv_path: str,
    json_path: str,
    layout: str = "array",
    rest: str | None = None,
) -> None:
    """Convert CSV to JSON with every value a string, as arrays or as lines.

    Surplus fields are an error, or an array under the name ``rest``.
    """
    rows = read_csv_text(spark, csv_path, rest)
    if layout == "array":
        write_json_array(rows, json_path)
    elif layout == "lines":
        write_json_lines(rows, json_path)
    else:
        raise ValueError(f"layout is array or lines, not {layout}")
