"""Helpers that the operators share."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.scratch import scratch_path

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Long texts are cut into blocks of about so many bytes, at white space.
BLOCK_BYTES = 1 << 20
TASK_GROUPS = 64
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def text_or_empty(name: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, LETTERS.upper(), LETTERS)


def unused(name: str, df: DataFrame) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(id_column: str, text_column: str) -> Column:
    """What a row is known by where decisions are taken: its id, which may be null, and its text."""
    text = F.md5(text_or_empty(text_column).cast("binary"))
    return F.struct(column(id_column).alias("doc_id"), text.alias("text_md5"))


def without_rows(
    df: DataFrame, dropped: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``df`` whose :func:`row_key` is not in ``dropped``, a frame of one column.

    Null ids are equal here, so rows that have none follow decisions too.
    """
    name = unused("dropped", df)
    key, gone = row_key(id_column, text_column), F.col(name)
    same = key["doc_id"].eqNullSafe(gone["doc_id"]) & (key["text_md5"] == gone["text_md5"])
    return df.join(dropped.distinct().toDF(name), same, "left_anti")


def held_out(name: str) -> Column:
    """Whether a row lies in the fold that no model learns from (a null id does)."""
    remainder = F.crc32(column(name).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    Later steps read the files, so they are neither recomputed nor lost with an executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [known, root]))
        spark.sparkContext.environment["PYTHONPATH"] = joined


class Memory(dict):
    """Results by key, made when they are first asked for.

    Full, it keeps what it holds as a second layer and starts anew; what is asked for again
    moves up, all else is forgotten when it is full next time.
    """

    def __init__(self, make: Callable, entries: int) -> None:
        super().__init__()
        self._make, self._entries = make, entries
        self._older: dict = {}

    def __missing__(self, key):
        found = self._older.get(key)
        if found is None:
            found = self._make(key)
        if len(self) >= self._entries:
            self._older = dict(self)
            self.clear()
        self[key] = found
        return found


def add_vectors(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """``keys, vector``: the sums of a binary column ``vector``, numpy arrays of one kind.

    Tasks are added up in ``TASK_GROUPS`` groups first, so that no group holds them all.
    """

    def summed(frame: DataFrame, by: list[str]) -> DataFrame:
        schema = frame.select(*by, "vector").schema

        def run(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), dtype=kind) for x in table["vector"])
            first = [table[key].slice(0, 1) for key in by]
            return pa.table([*first, pa.array([total.tobytes()])], names=[*by, "vector"])

        return frame.groupBy(*by).applyInArrow(run, schema)

    grouped = df.withColumn("task_group", F.spark_partition_id() % TASK_GROUPS)
    return summed(summed(grouped, [*keys, "task_group"]), keys)


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of bounded size; one empty list if there are none."""
    if len(data) <= 2 * BLOCK_BYTES:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = _SPACE.search(data, min(start + BLOCK_BYTES, len(data)))
        end = end.start() if end else len(data)
        yield data[start:end].split()
        start = end


def text_blocks(text: str) -> Iterator[list[str]]:
    """What stands between single spaces, in lists of bounded size."""
    start = 0
    while start <= len(text):
        end = text.find(" ", start + BLOCK_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].split(" ")
        start = end + 1


def shingles(data: bytes, words: int) -> Iterator[list[bytes]]:
    """The shingles of ``words`` words, space-joined, in lists of bounded size.

    A text of fewer words is one shingle; one without words has none.
    """
    held: list[bytes] = []
    seen = False
    for block in word_blocks(data):
        held += block
        if len(held) >= words:
            seen = True
            yield list(map(b" ".join, zip(*(held[i:] for i in range(words)))))
            held = held[len(held) - words + 1 :]
    if held and not seen:
        yield [b" ".join(held)]


def arrow_slices(batches, columns: list[str], most_bytes: int = 16 << 20):
    """Cut Arrow batches into ones of about ``most_bytes`` at most, a row at least."""
    for batch in batches:
        rows = batch.num_rows
        size = max(1, sum(batch.column(batch.schema.get_field_index(c)).nbytes for c in columns))
        step = max(1, min(rows, rows * most_bytes // size)) if rows else 1
        for start in range(0, rows, step):
            yield batch.slice(start, step)
