"""Records that span lines, read by all splits of a file at once.

Spark cuts large files into splits, but where a record ends can depend on everything before it:
a line break may stand inside a quoted field, a brace inside a string. So a first pass tells for
every split what it would do to each state that it may begin in. These few steps are put
together in order, which gives the state that each split really begins in, and a second pass
cuts records in all splits on their own. What begins in one split and ends in another is pieced
together by the way.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.scratch import scratch_path

# What tasks run travels with them, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Chunks of about so many bytes are looked at together.
RUN_BYTES = 1 << 20

_PLAIN = r'(?:[^",][^,]*)?'
_QUOTED = r'"(?:[^"]|"")*"(?:[^,"][^,]*)?'
_FIELDS = f"(?:(?:{_QUOTED}|{_PLAIN}),)*"
_OPEN = r'"(?:[^"]|"")*$'


class BrokenFile(ValueError):
    """A file ends inside a record."""


class CsvLines:
    """Lines; state 1 is inside a quoted field.

    A quote opens a field only at its start, two of them inside stand for one, and what follows
    the closing one belongs to the field as it is.
    """

    separator = "\n"
    final_depth = 0
    #: Lines that may change the state, or that other readers take for two.
    matters = r'"|\r(?s:.)'
    ending = ""

    def steps(self, chunks: pa.Array):
        """The state after each chunk and the change of depth, from state 0 and from state 1."""
        size = len(chunks)
        ends, none = (np.zeros(size, np.int8), np.ones(size, np.int8)), np.zeros(size, np.int64)
        quoted = pc.match_substring(chunks, '"').to_numpy(zero_copy_only=False)
        if quoted.any():
            some = chunks.filter(pa.array(quoted))
            for start, pattern in enumerate(
                (f"(?s)^{_FIELDS}{_OPEN}",
                 f'(?s)^(?:[^"]|"")*(?:"(?:[^,"][^,]*)?,{_FIELDS}{_OPEN}|$)')
            ):
                found = pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
                ends[start][quoted] = found
        return *ends, none, none

    def is_end(self, states: np.ndarray, depths: np.ndarray) -> np.ndarray:
        return states == 0

    def inside(self, state: int, depth: int) -> bool:
        return state == 1

    def kept(self, records: pa.Array) -> pa.Array:
        """Blank lines are no records."""
        return records.filter(pc.invert(pc.is_in(records, pa.array(["", "\r"]))))

    def checked_rest(self, rest: str) -> None:
        raise BrokenFile(f"a file ends inside a quoted field: {rest[:100]!r}")


class JsonElements:
    """What stands before each closing brace; state 1 is inside a string, depth counts brackets."""

    separator = "}"
    #: An array is closed behind the last brace, and one more is counted for the file's end.
    final_depth = -1
    matters = None
    ending = "}"

    def steps(self, chunks: pa.Array):
        offsets = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset :][: len(chunks) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)[low:high]
        quotes = np.flatnonzero(data == 0x22)
        if len(quotes):
            # A quote is one unless an odd number of backslashes stands before it.
            other = np.where(data != 0x5C, np.arange(len(data)), -1)
            last = np.maximum.accumulate(other)
            before = np.where(quotes > 0, last[np.maximum(quotes, 1) - 1], -1)
            quotes = quotes[(quotes - 1 - before) % 2 == 0]
        edges = offsets.astype(np.int64) - low
        first = np.searchsorted(quotes, edges)
        odd = (np.diff(first) % 2).astype(np.int8)
        marks = np.flatnonzero((data | 0x20 == 0x7B) | (data | 0x20 == 0x7D))
        rise = np.where(data[marks] | 0x20 == 0x7B, 1, -1)
        chunk = np.searchsorted(edges, marks, "right") - 1
        within = (np.searchsorted(quotes, marks) - first[chunk]) % 2
        size = len(chunks)
        depths = [
            np.bincount(chunk[within == side], weights=rise[within == side], minlength=size)
            for side in (0, 1)
        ]
        # The brace that ends a chunk counts if it is in no string.
        ends = (odd, 1 - odd)
        depths = [(depths[side] - (ends[side] == 0)).astype(np.int64) for side in (0, 1)]
        return *ends, *depths

    def is_end(self, states: np.ndarray, depths: np.ndarray) -> np.ndarray:
        return (states == 0) & (depths == 1)

    def inside(self, state: int, depth: int) -> bool:
        return (state, depth) not in ((0, 0), (0, 1), (0, self.final_depth))

    def kept(self, records: pa.Array) -> pa.Array:
        return records

    def checked_rest(self, rest: str) -> None:
        """What stands behind the last element; an array of none is all rest."""
        if "".join(rest.split()).lstrip("﻿") not in ("]", "[]"):
            raise BrokenFile(f"not the end of an array of objects: {rest[:100]!r}")


def followed(ends0: np.ndarray, ends1: np.ndarray, start: int) -> np.ndarray:
    """The state after each chunk, beginning in ``start``."""
    constant, swaps = ends0 == ends1, np.cumsum((ends0 == 1) & (ends1 == 0))
    last = np.maximum.accumulate(np.where(constant, np.arange(len(ends0)), -1))
    known = last >= 0
    base = np.where(known, ends0[last], start)
    return base ^ (swaps - np.where(known, swaps[last], 0)) & 1


def _depths(states, start_state, start_depth, change0, change1) -> np.ndarray:
    before = np.concatenate([[start_state], states[:-1]])
    return start_depth + np.cumsum(np.where(before == 0, change0, change1))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """``file, start, chunks`` of what belongs to one split, about a megabyte at a time.

    The steps take many times the bytes of their chunks, and a batch is bounded by rows.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch["file"].to_numpy(), batch["start"].to_numpy()
        sizes = pc.binary_length(batch["value"]).to_numpy().astype(np.int64)
        run = np.cumsum(sizes) // RUN_BYTES
        changed = (np.diff(file) != 0) | (np.diff(start) != 0) | (np.diff(run) != 0)
        cuts = np.flatnonzero(changed) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
            yield int(file[low]), int(start[low]), batch["value"].slice(low, high - low)


class Splits:
    """Where each split of some files begins: state and depth."""

    def __init__(self, rows: list[tuple], grammar) -> None:
        """Of ``file, start, end0, end1, depth0, depth1, breaks0, breaks1`` of splits."""
        files, starts, states, depths = [], [], [], []
        #: Whether any record has several chunks, and whether any may span splits.
        self.broken_lines = self.spanning = False
        #: The last state and depth of each file.
        self.last: dict[int, tuple[int, int]] = {}
        for file, start, *of in sorted(rows):
            state, depth = self.last.get(file, (0, 0))
            self.broken_lines |= bool(of[4 + state])
            state, depth = of[state], depth + of[2 + state]
            self.spanning |= grammar.inside(state, depth)
            self.last[file] = state, depth
            files.append(file)
            starts.append(start)
            states.append(state)
            depths.append(depth)
        #: What tasks need of it, some 20 bytes a split.
        self.arrays = (
            np.array(files, np.int64),
            np.array(starts, np.int64),
            np.array(states, np.int8),
            np.array(depths, np.int32),
        )


def begin(arrays: tuple, file: int, start: int) -> tuple[int, int]:
    """The state and depth that a split begins in: those after the split before it."""
    files, starts, states, depths = arrays
    low, high = np.searchsorted(files, file, "left"), np.searchsorted(files, file, "right")
    place = low + np.searchsorted(starts[low:high], start)
    if place == low:
        return 0, 0
    return int(states[place - 1]), int(depths[place - 1])


class Cutter:
    """Cuts the chunks of one split, which come a batch at a time, into records."""

    def __init__(self, grammar, begins: tuple[int, int]) -> None:
        self._grammar = grammar
        self._state, self._depth = begins
        self._pending: list[str] = []
        #: Whether what comes first began in an earlier split.
        self._continues = grammar.inside(*begins)

    def records(self, chunks: pa.Array) -> tuple[pa.Array, str | None]:
        """The whole records that end here, and the end of one that began in another split."""
        ends0, ends1, change0, change1 = self._grammar.steps(chunks)
        states = followed(ends0, ends1, self._state)
        depths = _depths(states, self._state, self._depth, change0, change1)
        self._state, self._depth = int(states[-1]), int(depths[-1])
        ends = np.flatnonzero(self._grammar.is_end(states, depths)) + 1
        if not len(ends):
            self._pending += chunks.to_pylist()
            return pa.array([], pa.string()), None
        head, begun = None, []
        if self._pending or self._continues:
            parts = [*self._pending, *chunks.slice(0, int(ends[0])).to_pylist()]
            text = self._grammar.separator.join(parts)
            head, begun = (text, []) if self._continues else (None, [text])
        else:
            ends = np.concatenate([[0], ends])
        self._continues = False
        self._pending = chunks.slice(int(ends[-1])).to_pylist()
        if int(ends[-1]) - int(ends[0]) == len(ends) - 1:
            records = chunks.slice(int(ends[0]), len(ends) - 1)
        else:
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunks)
            records = pc.binary_join(lists, self._grammar.separator)
        return self._grammar.kept(pa.concat_arrays([pa.array(begun, pa.string()), records])), head

    def rest(self) -> tuple[bool, str] | None:
        """What is left at the end of the split, and whether a record begins with it."""
        if not self._pending:
            return None
        text = self._grammar.separator.join(self._pending)
        if not self._continues and (self._state, self._depth) == (0, self._grammar.final_depth):
            self._grammar.checked_rest(text)
            return None
        return not self._continues, text


def _chunks(spark: SparkSession, path: str | list[str], grammar) -> DataFrame:
    rows = spark.read.option("lineSep", grammar.separator).text(path)
    return rows.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def find_splits(spark: SparkSession, path: str | list[str], grammar) -> Splits:
    """The first pass over files. Fails if one of them ends inside a record.

    The driver gets a row of 50 bytes for each split, of which it holds more for every scan.
    """
    chunks = _chunks(spark, path, grammar)
    some = chunks.where(F.col("value").rlike(grammar.matters)) if grammar.matters else chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "end0", "end1", "depth0", "depth1", "breaks0", "breaks1"]
        now, held = None, None

        def row() -> pa.RecordBatch:
            values = [*now, *(x[i] for i in range(3) for x in held)]
            return pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in values], names)

        for file, start, values in _runs(batches):
            if now != (file, start):
                if now is not None:
                    yield row()
                now, held = (file, start), [[0, 0, False], [1, 0, False]]
            made = grammar.steps(values)
            torn = bool(pc.any(pc.match_substring_regex(values, "\r(?s:.)")).as_py())
            for side in held:
                states = followed(made[0], made[1], side[0])
                side[1] = int(_depths(states, side[0], side[1], made[2], made[3])[-1])
                side[0] = int(states[-1])
                side[2] |= torn or bool((states == 1).any())
        if now is not None:
            yield row()

    kinds = "file long, start long, end0 long, end1 long, depth0 long, depth1 long, "
    rows = some.mapInArrow(run, kinds + "breaks0 long, breaks1 long").collect()
    splits = Splits([tuple(row) for row in rows], grammar)
    for file, last in splits.last.items():
        if last != (0, grammar.final_depth):
            found = spark.read.text(path).select("_metadata.file_path")
            name = found.where(F.xxhash64("file_path") == file).first()
            raise BrokenFile(f"a file ends inside a record: {name[0]}")
    return splits


def read_records(
    spark: SparkSession, path: str | list[str], grammar, splits: Splits
) -> DataFrame:
    """``first, text`` of every record; ``first`` marks those that files begin with.

    Large files are read by many tasks. Records that lie in one split come in order, those that
    span splits last; they are found by a pass of their own, which keeps nothing else, and are
    written to the shared folder.
    """
    chunks = _chunks(spark, path, grammar)
    begins = spark.sparkContext.broadcast(splits.arrays)

    def cut(batches):
        """``now, chunks, cutter`` of every piece of a split, and without chunks at its end."""
        now, cutter = None, None
        for file, start, values in _runs(batches):
            if now != (file, start):
                if now is not None:
                    yield now, None, cutter
                now, cutter = (file, start), Cutter(grammar, begin(begins.value, file, start))
            yield now, values, cutter
        if now is not None:
            yield now, None, cutter

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for now, values, cutter in cut(batches):
            if values is None:
                cutter.rest()
                continue
            texts, _ = cutter.records(values)
            if len(texts):
                first = np.zeros(len(texts), dtype=bool)
                first[0], seen = now[1] == 0 and now != seen, now
                yield pa.RecordBatch.from_arrays([pa.array(first), texts], ["first", "text"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "begins", "first", "text"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        seen = None
        for now, values, cutter in cut(batches):
            row = None
            if values is None:
                left = cutter.rest()
                if left:
                    row = (*now, int(left[0]), now[1] == 0 and now != seen, left[1])
            else:
                texts, head = cutter.records(values)
                seen = now if len(texts) else seen
                if head is not None:
                    row = (*now, 0, False, head)
            if row:
                arrays = [pa.array([x], kind) for x, kind in zip(row, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    records = chunks.mapInArrow(whole, "first boolean, text string")
    if splits.spanning:
        fields = "file long, start long, begins int, first boolean, text string"
        place = scratch_path(spark, "pieces")
        chunks.mapInArrow(pieces, fields).write.parquet(place)
        # At most two a split: the rest of a record, and then the beginning of the next one.
        order = Window.partitionBy("file").orderBy("start", "begins")
        numbered = spark.read.schema(fields).parquet(place).withColumn(
            "number", F.sum("begins").over(order)
        )
        joined = numbered.groupBy("file", "number").agg(
            F.max("first").alias("first"),
            F.array_sort(F.collect_list(F.struct("start", "text"))).alias("of"),
        )
        text = F.array_join(F.transform("of", lambda x: x["text"]), grammar.separator)
        records = records.unionByName(joined.select("first", text.alias("text")))
    return records.withColumn("text", F.concat("text", F.lit(grammar.ending)))
