"""Token ids in binary files of Simple-8b words, ordered by document."""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm import simple8b
from starloom.llm.common import (
    Memory,
    arrow_slices,
    column,
    ready_workers,
    stored,
    text_or_empty,
)
from starloom.llm.files import read_files, write_files

END_ID = 0
#: A file is closed once it holds so many ids; a document is never divided.
FILE_IDS = 2_000_000
#: Entries of each layer of a worker's memories.
MEMO_ENTRIES = 400_000

# Fixed values of the file format: six counts, then the closing magic number.
_FOOTER = struct.Struct("<6Q")
MAGIC = b"\xffS8B"

_UNSAFE = re.compile(r"\s ")
#: Marks that may close a word; an apostrophe may begin a piece together with letters.
_TAIL = "".join(sorted(set(string.punctuation) - {"'"}))


class _Letters(dict):
    """What a byte-level tokenizer makes of a character before it looks up pieces."""

    def __init__(self) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        self._step = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = made = self._step.pre_tokenize_str(chr(code))[0][0]
        return made

_LINES = re.compile(r"\S+(?:\n\S+)+")


def _mapped(letters: str, table: _Letters) -> str:
    """Letters as the model has them; ASCII ones are as they are."""
    return letters if letters.isascii() else letters.translate(table)


class TextEncoder:
    """Encodes texts with a tokenizer file, remembering the ids of words.

    A byte-level tokenizer never joins what stands before a space that follows a word with
    that space, so texts are cut there and each different word is encoded once. Words of
    letters with closing marks are encoded as letters and marks apart, as the tokenizer splits
    them there too. Other tokenizers, texts with runs of white space, and texts with special
    tokens are encoded whole.
    """

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self._tokenizer.to_str())
        step = parts["pre_tokenizer"] or {}
        self._by_word = (
            parts["normalizer"] is None
            and parts["model"]["type"] == "BPE"
            and step.get("type") == "ByteLevel"
            and not step["add_prefix_space"]
            and step["use_regex"]
        )
        self._special = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]
        self._letters = _Letters()
        self._model, self._space = self._tokenizer.model, self._letters[ord(" ")]
        self._words = Memory(self._word, MEMO_ENTRIES)
        self._cores = Memory(self._core, MEMO_ENTRIES)
        self._lines = Memory(self._line, MEMO_ENTRIES // 2)
        self._tails = Memory(self.whole, MEMO_ENTRIES // 2)

    def whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _piece(self, letters: str) -> bytes:
        return array("I", [piece.id for piece in self._model.tokenize(letters)]).tobytes()

    def _core(self, letters: str) -> bytes:
        """A space and letters, which the tokenizer takes as one word."""
        return self._piece(self._space + _mapped(letters, self._letters))

    def _line(self, word: str) -> bytes:
        """What stands behind a line break."""
        core = word.rstrip(_TAIL)
        if not core.isalpha():
            return self.whole(word)
        return self._piece(_mapped(core, self._letters)) + self._tails[word[len(core) :]]

    def _word(self, word: str) -> bytes:
        """What stands behind a space, and the space."""
        core = word.rstrip(_TAIL)
        if core.isalpha():
            if len(core) == len(word):
                return self._cores[core]
            return self._cores[core] + self._tails[word[len(core) :]]
        lines = word.split("\n")
        if len(lines) > 1 and _LINES.fullmatch(word):
            # A single line break is a piece of its own.
            made = [self._words[lines[0]]]
            for line in lines[1:]:
                made += (self._tails["\n"], self._lines[line])
            return b"".join(made)
        return self.whole(" " + word)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not self._by_word or _UNSAFE.search(text) or any(x in text for x in self._special):
            return self.whole(text)
        first, *others = text.split(" ")
        return self.whole(first) + b"".join(map(self._words.__getitem__, others))


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a file; tasks share it."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


class _TokenFile:
    def __init__(self, place: int) -> None:
        self.place, self.ids = place, 0
        self._chunks: list[bytes] = []
        self._documents: list[int | None] = []
        self._counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        count = len(ids) // 4
        self._chunks.append(ids)
        self._documents.append(doc_id)
        self._counts.append(count)
        self.ids += count

    def finish(self) -> bytes:
        """The file without its magic number, which the writer adds."""
        ids = np.frombuffer(b"".join(self._chunks), dtype="<u4")
        words, sizes, escaped = simple8b.encode(ids)
        missing = np.array([doc_id is None for doc_id in self._documents], dtype=np.uint8)
        documents = np.array([doc_id or 0 for doc_id in self._documents], dtype="<i8")
        task = TaskContext.get()
        counts = (len(ids), len(words), len(escaped), len(documents))
        footer = _FOOTER.pack(*counts, task.partitionId() if task else 0, self.place)
        arrays = (words.astype("<u8"), escaped.astype("<u8"), documents,
                  np.array(self._counts, dtype="<u8"), missing, sizes)
        return b"".join([*(array.tobytes() for array in arrays), footer])


class TokenFileReader:
    """A token file in memory; blocks are decoded as they are asked for."""

    def __init__(self, content: bytes) -> None:
        end = len(content) - len(MAGIC)
        if content[end:] != MAGIC:
            raise ValueError("not a file of token ids")
        footer = end - _FOOTER.size
        self.ids, words, escaped, documents, self.partition, self.place = _FOOTER.unpack(
            content[footer:end]
        )
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            start, at = at, at + count * np.dtype(kind).itemsize
            return np.frombuffer(content, kind, count, start)

        self._words, self._escaped = take("<u8", words), take("<u8", escaped)
        self.documents, self.counts = take("<i8", documents), take("<u8", documents).astype("i8")
        self.missing = take("u1", documents).astype(bool)
        sizes = take("u1", -(-self.ids // simple8b.BLOCK))
        if at != footer:
            raise ValueError("broken file of token ids")
        #: Where each block's words begin.
        self.offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` on; only their blocks are decoded."""
        if not count:
            return np.zeros(0, dtype="<u4")
        first, last = start // simple8b.BLOCK, -(-(start + count) // simple8b.BLOCK)
        words = self._words[self.offsets[first] : self.offsets[last]]
        start -= first * simple8b.BLOCK
        return simple8b.decode(words, self._escaped)[start : start + count].astype("<u4")


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending ``doc_id`` order.

    ``tokenizer`` is a file of the tokenizers library that every worker can open. A null text is
    empty and has the end id only. Null document ids come first; rows with the same id stand
    together in the order of a hash of their text. A document may be longer than a file's usual
    size. An empty table gives no files with content; other columns are not looked at.
    """
    ready_workers(df.sparkSession)
    rows = df.select(
        column(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")
    )
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(file: _TokenFile) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": pa.array([file.finish()], pa.binary())})

        encode = encoder(tokenizer).encode
        file = _TokenFile(0)
        for part in arrow_slices(batches, ["text"], 4 << 20):
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"]):
                file.add(doc_id, encode(text.as_py()) + end)
                if file.ids >= FILE_IDS:
                    yield closed(file)
                    file = _TokenFile(file.place + 1)
        if file.ids:
            yield closed(file)

    write_files(ordered.mapInArrow(run, "file binary"), path, MAGIC)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``partition, place, doc_id, file_start, ids`` of every document (``ids`` is binary:
    little-endian unsigned 32-bit integers, the end id included)."""
    return _read(spark, path, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in files under ``path``.

    ``start`` counts the ids of all documents before it, over all files in their order.
    """
    read = _read(spark, path, "ids_crc32 long", zlib.crc32, pa.int64())
    rows = stored(read, "token_digests")
    files = rows.groupBy("partition", "place").agg(F.sum("n_tokens").alias("held"))
    # One row per file, so one task can add them up.
    before = Window.orderBy("partition", "place").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        "partition", "place", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base")
    )
    return rows.join(files, ["partition", "place"]).select(
        "doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _read(spark: SparkSession, path: str, field: str, of, kind: pa.DataType) -> DataFrame:
    ready_workers(spark)
    name = field.split()[0]
    schema = "partition long, place long, doc_id long, file_start long, n_tokens long, " + field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                file = TokenFileReader(content.as_py())
                yield from _documents(file, name, of, kind)

    return read_files(spark, path).mapInArrow(run, schema)


def _documents(file: TokenFileReader, name: str, of, kind: pa.DataType):
    """Documents of a file, decoded some blocks at a time."""
    ends = np.cumsum(file.counts)
    starts = ends - file.counts
    first = 0
    while first < len(ends):
        # Documents up to a quarter of a million ids, one at least.
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + 250_000, "right")))
        ids = file.read(int(starts[first]), int(ends[last - 1] - starts[first]))
        cuts = ends[first : last - 1] - starts[first]
        here = slice(first, last)
        size = last - first
        columns = {
            "partition": pa.array(np.full(size, file.partition, dtype=np.int64)),
            "place": pa.array(np.full(size, file.place, dtype=np.int64)),
            "doc_id": pa.array(file.documents[here], mask=file.missing[here]),
            "file_start": pa.array(starts[here]),
            "n_tokens": pa.array(file.counts[here]),
            name: pa.array([of(part) for part in np.split(ids, cuts)], kind),
        }
        yield pa.RecordBatch.from_pydict(columns)
        first = last
