"""Byte-pair encoding with word ends, by a lexicon of frequent words and exact merging.

Words are what stands between ASCII white space. The corpus is counted once, its frequent words
are compiled with their ids into a transducer (:mod:`starloom.llm.lexicon`), and every worker
maps that file into memory. A batch's different words walk it together; those it does not hold
are merged pair by pair, as the tokenizer file's ranks say.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import lexicon
from starloom.llm.common import (
    BLOCK_BYTES,
    Memory,
    arrow_slices,
    ready_workers,
    stored,
    text_or_empty,
)
from starloom.llm.files import read_files, write_files
from starloom.llm.lexicon import WORD_BYTES, Lexicon, ragged
from starloom.names import quoted
from starloom.scratch import scratch_path

#: The lexicon has at most so many words, the most frequent ones; all others are merged.
LEXICON_WORDS = 1 << 17
#: It has none that occurs less often.
LEAST_COUNT = 3
#: Bytes of text that are encoded together.
SLICE_BYTES = 3 << 20
#: Entries of each layer of a worker's memory of merged words, and of pieces of words.
MEMO_ENTRIES = 100_000
#: Words of more symbols are merged with a heap.
SHORT = 128
#: Steps a doubling of the frequencies by which the lexicon's least one is found.
STEPS = 8

_SPACE = regex.compile(rb"[\x20\x09-\x0d]")
#: Printable ASCII and letters of Latin-1: every version of Unicode treats them alike.
_PLAIN = regex.compile(r"[!-~À-ÿ]*")
_NO_RANK = 1 << 60


class WordBpe:
    """A tokenizer file's byte-pair encoding of words, merged here.

    The file must be a byte-level BPE that drops white space and marks word ends. Words of other
    than plain characters are normalised and split by the tokenizers library; words that hold a
    special token are encoded by it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        parts = json.loads(self._tokenizer.to_str())
        model, steps = parts["model"], parts["pre_tokenizer"]
        kinds = [step["type"] for step in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = steps.get("pretokenizers", [])
        if (
            model["type"] != "BPE"
            or not model["end_of_word_suffix"]
            or kinds != ["NFC", "Replace", "Lowercase"]
            or parts["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
            or [step["type"] for step in splits] != ["Split", "ByteLevel"]
            or splits[0]["behavior"] != "Removed"
            or not splits[0]["invert"]
            or splits[1]["add_prefix_space"]
            or splits[1]["use_regex"]
            or any(model[x] for x in ("dropout", "ignore_merges", "byte_fallback", "fuse_unk"))
            or parts["decoder"] is not None
            or parts["post_processor"] is not None
        ):
            raise ValueError("not a byte-pair encoding of words without white space")
        self._pieces = regex.compile(splits[0]["pattern"]["Regex"])
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        self._letters = _byte_letters()
        self._first = [vocabulary[letter] for letter in self._letters]
        self._last = [vocabulary[letter + end] for letter in self._letters]
        self._byte_of = {letter: byte for byte, letter in enumerate(self._letters)}
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        #: By pair of ids: rank. By rank: id.
        self._ranks: dict[tuple[int, int], int] = {}
        self._made: list[int] = []
        for rank, (left, right) in enumerate(merges):
            self._ranks[vocabulary[left], vocabulary[right]] = rank
            self._made.append(vocabulary[left + right])
        #: Pieces of words, as words differ in capitals and marks more than in letters.
        self._known = Memory(self._merged, MEMO_ENTRIES // 2)
        known = self._tokenizer.get_vocab(with_added_tokens=True)
        self.written = [b""] * (max(known.values()) + 1)
        for token, number in known.items():
            self.written[number] = token.encode()
        self._special = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of a word without ASCII white space; bytes that are no UTF-8 are replaced."""
        text = word.decode("utf-8", "replace")
        if any(special in text for special in self._special):
            return self._tokenizer.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        if _PLAIN.fullmatch(text):
            for piece in self._pieces.findall(text.lower()):
                ids += self._known[piece.encode()]
            return ids
        normal = self._tokenizer.normalizer.normalize_str(text)
        for piece, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            ids += self._known[bytes(map(self._byte_of.__getitem__, piece))]
        return ids

    def _merged(self, data: bytes) -> list[int]:
        """Join the pair of least rank, the first of equal ones, until none has a rank."""
        ids = [self._first[byte] for byte in data[:-1]]
        ids.append(self._last[data[-1]])
        if len(ids) > SHORT:
            return self._merged_by_heap(ids)
        ranks_of = self._ranks.get
        ranks = [ranks_of(pair, _NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NO_RANK:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [self._made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = ranks_of((ids[at - 1], ids[at]), _NO_RANK)
            if at < len(ranks):
                ranks[at] = ranks_of((ids[at], ids[at + 1]), _NO_RANK)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same in time that hardly grows faster than the word."""
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [
            (rank, at)
            for at, pair in enumerate(zip(ids, ids[1:]))
            if (rank := self._ranks.get(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            # A pair that has changed since has no place or another rank.
            if ids[at] < 0 or right >= size or self._ranks.get((ids[at], ids[right])) != rank:
                continue
            ids[at], ids[right] = self._made[rank], -1
            after[at] = right = after[right]
            if right < size:
                before[right] = at
            for left, end in ((before[at], at), (at, right)):
                if left >= 0 and end < size:
                    made = self._ranks.get((ids[left], ids[end]))
                    if made is not None:
                        heapq.heappush(heap, (made, left))
        return [number for number in ids if number >= 0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of ids with spaces between them, as a tokenizer without decoder gives it."""
        return b" ".join(map(self.written.__getitem__, ids.tolist()))


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


_encoders: dict[str, WordBpe] = {}
_lexicons: dict[str, Lexicon] = {}
_merged: dict[str, Memory] = {}


def word_bpe(path: str) -> WordBpe:
    """The worker's tokenizer for a file; tasks share it."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]


def mapped_lexicon(name: str) -> Lexicon:
    """A lexicon that Spark has brought to this executor, mapped into memory."""
    if name not in _lexicons:
        _lexicons.clear()
        with open(SparkFiles.get(name), "rb") as file:
            _lexicons[name] = Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    return _lexicons[name]


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size, cut at white space."""
    if len(text) <= 2 * SLICE_BYTES:
        yield text
        return
    start = 0
    while start < len(text):
        end = _SPACE.search(text, min(start + BLOCK_BYTES, len(text)))
        end = end.start() if end else len(text)
        yield text[start:end]
        start = end


def _split(texts: list[bytes]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Where each text's words end, and the words as places in a list of different ones."""
    # The kernel looks at bytes only, so it may take them for a string.
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
    offsets = lists.offsets.to_numpy()
    words = lists.values.view(pa.binary()).dictionary_encode()
    return offsets, words


def _groups(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[list[int], list[bytes]]]:
    rows: list[int] = []
    held: list[bytes] = []
    size = 0
    for row, text in texts:
        rows.append(row)
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield rows, held
            rows, held, size = [], [], 0
    if rows:
        yield rows, held


def encode_texts(texts: list[bytes], bpe: WordBpe, known: Lexicon, merged: Memory) -> list[bytes]:
    """The ids of each text as little-endian 32-bit integers."""
    made: list[list[bytes]] = [[] for _ in texts]
    parts = ((row, part) for row, text in enumerate(texts) for part in _cut(text))
    for rows, group in _groups(parts):
        ends, words = _split(group)
        different = words.dictionary
        data = np.frombuffer(different.buffers()[2] or b"", dtype=np.uint8)
        edges = np.frombuffer(different.buffers()[1], dtype=np.int32)[: len(different) + 1]
        starts, sizes = edges[:-1].astype(np.int64), np.diff(edges).astype(np.int64)
        found, counts, ids = known.look_up(data, starts, sizes)
        others = np.flatnonzero(~found)
        words_of = different.take(pa.array(others)).to_numpy(zero_copy_only=False)
        unseen = [merged[word] for word in words_of]
        pool = np.concatenate([ids, np.frombuffer(b"".join(unseen), dtype="<u4")])
        places = np.zeros(len(different), dtype=np.int64)
        places[found] = np.cumsum(counts[found]) - counts[found]
        counts[others] = [len(x) // 4 for x in unseen]
        places[others] = len(ids) + np.cumsum(counts[others]) - counts[others]
        which = words.indices.to_numpy()
        all_ids = ragged(pool, places[which], counts[which])
        after = np.concatenate([[0], np.cumsum(counts[which])])[ends]
        for row, start, end in zip(rows, after[:-1].tolist(), after[1:].tolist()):
            made[row].append(all_ids[start:end].tobytes())
    return [b"".join(x) for x in made]


def word_counts(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``word`` (binary)``, n``: how often each word occurs in all texts, long ones left out."""
    ready_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["text"]):
            texts = part["text"].cast(pa.binary()).to_pylist()
            cuts = ((0, piece) for text in texts for piece in _cut(text))
            for _, group in _groups(cuts):
                _, words = _split(group)
                different = words.dictionary
                n = np.bincount(words.indices.to_numpy(), minlength=len(different))
                sizes = pc.binary_length(different).to_numpy(zero_copy_only=False)
                chosen = pa.array((sizes > 0) & (sizes <= WORD_BYTES))
                yield pa.RecordBatch.from_arrays(
                    [different.filter(chosen), pa.array(n, pa.int64()).filter(chosen)],
                    ["word", "n"],
                )

    texts = df.select(text_or_empty(text_column).alias("text"))
    counted = texts.mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The words of ``word, n`` that are frequent enough for at most ``most`` to be so.

    The least frequency is found from the number of words in each of a few hundred classes, so
    nothing is sorted; all words of a frequency are in or out together.
    """
    place = F.floor(F.log2(F.col("n").cast("double")) * STEPS).cast("int")
    # At most 64 doublings of STEPS classes.
    classes = counts.groupBy(place.alias("place")).count().collect()
    least, held = 64 * STEPS, 0
    for place_found, size in sorted(classes, reverse=True):
        held += size
        if held > most:
            break
        least = place_found
    return counts.where(place >= least)


def build_lexicon(df: DataFrame, tokenizer: str, text_column: str = "text") -> str:
    """Compile the frequent words of all texts; the name under which executors have the file.

    The words that are compiled are at most ``LEXICON_WORDS`` of ``WORD_BYTES`` bytes. The file
    goes to the shared folder, and from there to every executor, also one that starts later.
    """
    spark = df.sparkSession
    counts = word_counts(df, text_column).where(F.col("n") >= LEAST_COUNT)
    frequent = frequent_words(stored(counts, "word_counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            made = [bpe.word_ids(word) for word in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["word"], pa.array(made, pa.list_(pa.int32()))], ["word", "ids"]
            )

    found = frequent.select("word").mapInArrow(run, "word binary, ids array<int>").toArrow()
    entries = zip(found["word"].to_pylist(), map(tuple, found["ids"].to_pylist()))
    content = lexicon.compile_lexicon(sorted(entries))
    path = scratch_path(spark, "lexicon")
    write_files(spark.createDataFrame([(content,)], "file binary"), path, lexicon.MAGIC)
    written = read_files(spark, path).select("path").first()[0]
    spark.sparkContext.addFile(written)
    return os.path.basename(written)


def encode_words(
    df: DataFrame,
    tokenizer: str,
    text_column: str = "text",
    ids_column: str = "ids",
    decoded_column: str | None = "decoded",
    lexicon_name: str | None = None,
) -> DataFrame:
    """``df`` with the ids of its texts (binary: little-endian unsigned 32-bit integers).

    ``tokenizer`` is a file that every worker can open. ``decoded_column`` adds what the ids
    stand for, read from them alone: the tokens with spaces between. ``lexicon_name`` is a
    lexicon of :func:`build_lexicon`; without one, it is built from ``df``. It changes no result,
    as words that it does not hold are merged exactly.

    A null text counts as empty and has no ids. Long texts are cut at white space, where no
    token can span, and their ids joined. Bytes that are no UTF-8 are replaced. Rows are
    independent, so ties and repeated rows mean nothing; an empty table stays empty. Columns
    named as the new ones are replaced, all others are kept.
    """
    spark = df.sparkSession
    ready_workers(spark)
    name = lexicon_name or build_lexicon(df, tokenizer, text_column)
    new = {ids_column: T.BinaryType()}
    if decoded_column:
        new[decoded_column] = T.StringType()
    others = [c for c in df.columns if c.lower() not in {x.lower() for x in new}]
    # Tasks know columns by their places, as names may hold anything.
    rows = df.select(
        *[F.col(quoted(c)).alias(f"c{place}") for place, c in enumerate(others)],
        text_or_empty(text_column).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = word_bpe(tokenizer), mapped_lexicon(name)
        if tokenizer not in _merged:
            _merged[tokenizer] = Memory(
                lambda word: np.array(bpe.word_ids(word), dtype="<u4").tobytes(), MEMO_ENTRIES
            )
        for part in arrow_slices(batches, ["text"], SLICE_BYTES):
            texts = part["text"].cast(pa.binary()).to_pylist()
            ids = encode_texts(texts, bpe, known, _merged[tokenizer])
            made = [pa.array(ids, pa.binary())]
            if decoded_column:
                decoded = [bpe.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
                made.append(pa.array(decoded, pa.binary()).view(pa.string()))
            kept = [part[f"c{i}"] for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*others, *new])

    schema = T.StructType([df.schema[c] for c in others])
    for field, kind in new.items():
        schema = schema.add(field, kind)
    return rows.mapInArrow(run, schema)
