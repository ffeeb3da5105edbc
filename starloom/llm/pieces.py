"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is the composition of three parts that are compiled from a model file. The
normaliser writes a mark for each space and one in front. The pieces are arcs that read their
characters and write their id. The byte fallback reads any character that no piece covers and
writes the ids of its UTF-8 bytes. Composing it with a text gives a lattice of pieces, and the
result is the lightest path in the tropical semiring (weights add along a path, the least sum
wins).

In a unigram model an arc weighs the negative score of its piece. A byte-pair model is weighed
on the transitions between arcs: zero where two neighbours are stable, that is where merging
their joined characters by score gives these two pieces again, and infinite elsewhere. A text's
merged form is the only path all of whose neighbours are stable, so it is the only one of finite
weight, and one path per place of the text is all that has to be kept.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.common import Memory, arrow_slices, column, ready_workers

MARK = "▁"
#: Entries of each layer of a worker's memories.
MEMO_ENTRIES = 250_000
#: Longer parts are not remembered.
MEMO_CHARS = 64

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "


class Transducer:
    """The compiled model file of a byte-fallback model."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kind = model.normalizer_spec, model.trainer_spec.model_type
        others = {piece.type for piece in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only normalisers that keep all characters are compiled")
        if not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space must be a mark in front of a word")
        if others or kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models of normal pieces are compiled")
        self._prefix = MARK if rules.add_dummy_prefix else ""
        self._bpe = kind == BPE
        self._scores: dict[str, float] = {}
        self._ids: dict[str, tuple[int, ...]] = {}
        self._bytes: dict[int, int] = {}
        self.written: list[bytes] = []
        self._unknown = 0
        for number, piece in enumerate(model.pieces):
            text = b""
            if piece.type == NORMAL:
                self._scores[piece.piece] = piece.score
                self._ids[piece.piece] = (number,)
                text = piece.piece.replace(MARK, " ").encode()
            elif piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self._bytes[value] = number
                text = bytes([value])
            elif piece.type == UNKNOWN:
                self._unknown = number
                text = UNKNOWN_TEXT.encode()
            self.written.append(text)
        self._trie: dict = {}
        for piece in self._scores:
            node = self._trie
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = piece
        #: Neighbouring characters that some piece spans; all paths meet between others.
        self._spanned = {a + b for piece in self._scores for a, b in zip(piece, piece[1:])}
        self._by_word = not any(MARK in piece.lstrip(MARK) for piece in self._scores)
        self._fallback = UNKNOWN_PENALTY - min(self._scores.values(), default=0.0)
        self._words = Memory(self._word, MEMO_ENTRIES)
        self._parts = Memory(self._part, MEMO_ENTRIES)
        self._stable: dict[str, dict[str, bool]] = {}

    def _fallback_ids(self, character: str) -> tuple[int, ...]:
        try:
            return tuple(self._bytes[value] for value in character.encode())
        except KeyError:
            return (self._unknown,)

    def _merged(self, text: str) -> list[str]:
        """The byte-pair form of a short text: the best-scored neighbours are joined first."""
        symbols = list(text)
        while True:
            best, place = -math.inf, -1
            for i in range(len(symbols) - 1):
                score = self._scores.get(symbols[i] + symbols[i + 1])
                if score is not None and score > best:
                    best, place = score, i
            if place < 0:
                return symbols
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]

    def _is_stable(self, before: str, piece: str) -> bool:
        wanted = [before, piece] if before else [piece]
        return self._merged(before + piece) == wanted

    def _arcs(self, text: str, start: int) -> list[str]:
        """The pieces that begin at a place, and its character if none is that short."""
        node, arcs = self._trie, []
        for place in range(start, len(text)):
            node = node.get(text[place])
            if node is None:
                break
            piece = node.get("")
            if piece:
                arcs.append(piece)
        if not arcs or len(arcs[0]) > 1:
            arcs.append(text[start])
        return arcs

    def _path(self, text: str) -> list[str]:
        """The pieces (or uncovered characters) of the lightest path over ``text``."""
        size = len(text)
        last = [""] * (size + 1)
        if self._bpe:
            for start in range(size):
                before = last[start]
                stable = self._stable.get(before)
                if stable is None:
                    if len(self._stable) >= MEMO_ENTRIES:
                        self._stable.clear()
                    stable = self._stable[before] = {}
                for piece in self._arcs(text, start):
                    end = start + len(piece)
                    if not last[end]:
                        fits = stable.get(piece)
                        if fits is None:
                            fits = stable[piece] = self._is_stable(before, piece)
                        if fits:
                            last[end] = piece
        else:
            weights = [0.0] + [math.inf] * size
            for start in range(size):
                for piece in self._arcs(text, start):
                    end = start + len(piece)
                    weight = weights[start] - self._scores.get(piece, -self._fallback)
                    if weight < weights[end]:
                        weights[end], last[end] = weight, piece
        path, end = [], size
        while end:
            path.append(last[end])
            end -= len(last[end])
        return path[::-1]

    def _part(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self._path(text):
            ids += self._ids.get(piece) or self._fallback_ids(piece)
        return array("i", ids).tobytes()

    def _segment(self, text: str) -> bytes:
        """The ids of normalised characters, a part at a time."""
        spanned, start, parts = self._spanned, 0, []
        for place in [*range(1, len(text)), len(text)]:
            if text[place - 1 : place + 1] not in spanned:
                part = text[start:place]
                known = len(part) <= MEMO_CHARS
                parts.append(self._parts[part] if known else self._part(part))
                start = place
        return b"".join(parts)

    def _word(self, word: str) -> bytes:
        return self._segment(MARK + word)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        words = text.split(" ")
        whole = not (self._by_word and self._prefix) or "" in words or MARK in text
        if whole or max(map(len, words)) > MEMO_CHARS:
            normal = self._prefix + text.replace(" ", MARK)
            return b"".join(map(self._segment, re.findall(f"{MARK}*[^{MARK}]*", normal)[:-1]))
        return b"".join(map(self._words.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the transducer read backwards."""
        written = self.written
        data = b"".join([written[number] for number in ids.tolist()])
        if self._prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


_transducers: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The worker's compiled model; tasks share it."""
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def _added(df: DataFrame, kinds: dict[str, T.DataType], source: str, of, arrow) -> DataFrame:
    """``df`` with columns made from another; columns of these names are replaced."""
    ready_workers(df.sparkSession)
    source = next(c for c in df.columns if c.lower() == source.lower())
    others = [c for c in df.columns if c.lower() not in {name.lower() for name in kinds}]
    fields = [df.schema[c] for c in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = of()
        for part in arrow_slices(batches, [source], 4 << 20):
            made = arrow(make, part[source])
            columns = [*(part[c] for c in others), *made]
            yield pa.RecordBatch.from_arrays(columns, [*others, *kinds])

    schema = T.StructType(fields)
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)


def encode_pieces(
    df: DataFrame,
    model: str,
    text_column: str = "text",
    ids_column: str = "ids",
    decoded_column: str | None = None,
) -> DataFrame:
    """``df`` with the ids of its texts, an ``array<int>``, as a model file encodes them.

    A null text has null ids, an empty one none. Long texts are encoded whole, rows are
    independent, and an empty table stays empty. A column that has the name of ``ids_column``
    is replaced, all others are kept. ``decoded_column`` adds what :func:`decode_pieces` makes
    of the ids, in the same pass.
    """

    def ids(make: Transducer, texts: pa.Array) -> list[pa.Array]:
        found = [None if text is None else make.encode(text) for text in texts.to_pylist()]
        sizes = np.array([0, *(len(x or b"") // 4 for x in found)], dtype=np.int64)
        values = np.frombuffer(b"".join(x or b"" for x in found), dtype="<i4")
        missing = pa.array([x is None for x in found], pa.bool_())
        offsets = pa.array(np.cumsum(sizes), pa.int32())
        made = [pa.ListArray.from_arrays(offsets, pa.array(values), mask=missing)]
        if decoded_column:
            lists = [None if x is None else np.frombuffer(x, dtype="<i4") for x in found]
            decoded = [None if x is None else make.decode(x) for x in lists]
            made.append(pa.array(decoded, pa.string()))
        return made

    text = df.withColumn(text_column, column(text_column).cast("string"))
    kinds: dict[str, T.DataType] = {ids_column: T.ArrayType(T.IntegerType())}
    if decoded_column:
        kinds[decoded_column] = T.StringType()
    return _added(text, kinds, text_column, lambda: transducer(model), ids)


def decode_pieces(
    df: DataFrame, model: str, ids_column: str = "ids", text_column: str = "decoded"
) -> DataFrame:
    """``df`` with the texts that ids stand for; null ids have a null text."""

    def texts(make: Transducer, lists: pa.Array) -> list[pa.Array]:
        values = lists.values.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_pylist()
        valid = lists.is_valid().to_pylist()
        decoded = [
            make.decode(values[start:end]) if known else None
            for start, end, known in zip(offsets, offsets[1:], valid)
        ]
        return [pa.array(decoded, pa.string())]

    return _added(df, {text_column: T.StringType()}, ids_column, lambda: transducer(model), texts)
