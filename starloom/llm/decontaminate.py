"""Benchmark passages in documents, also with other numbers, names or units.

Texts become templates: numbers, names and units are replaced by typed placeholders, so that a
question keeps its template when its values change. Documents meet benchmark items by hashes of
template windows. Where they meet, the values in the slots are compared: values that are equal
in the item must be equal in the document and different ones different, within each type.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    Memory,
    arrow_slices,
    column,
    ready_workers,
    row_key,
    stored,
    text_or_empty,
    without_rows,
)
from starloom.llm.lexicon import ragged

#: Tokens a window. Items that are shorter are one window.
WINDOW = 8
#: At least so many tokens of a window are words, not placeholders.
WINDOW_WORDS = 4
#: A document holds an item when one alignment meets so much of its tokens, or so many of them.
COVERED_SHARE = 0.5
COVERED_TOKENS = 13
#: Items of fewer tokens say too little inside a text; they count where a line is just that.
LEAST_TOKENS = 4
#: Bytes of text that are looked at together.
SLICE_BYTES = 2 << 20
#: Bits of the filter that keeps other windows from being shuffled; its size is fixed.
FILTER_BITS = 1 << 23
#: Entries of each layer of a worker's memory of words.
MEMO_ENTRIES = 400_000

# Words that stand for numbers and units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion dozen".split()
)
UNITS = frozenset(
    "mm cm m km ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms "
    "pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years usd eur gbp dollar dollars euro euros cent cents percent mph kph hz khz mhz ghz "
    "kb mb gb tb w kw kwh v".split()
)
SIGNS = "%$€£"

_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£]|[.!?\n]")
WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
# What is known of a token without its neighbours.
_NUMBER, _SIGN, _UNIT_WORD, _CAPITAL, _ENDS, _NO_TOKEN, _BREAKS = 1, 2, 4, 8, 16, 32, 64
_RECORD = np.dtype([("hash", "<u8"), ("flags", "<u8")])
_RECORD_BYTES = struct.Struct("<QQ")
# An odd number, and what it is multiplied with to give 1 in 64 bits.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACEHOLDERS = np.array([0, 0x51ED270B, 0x2545F491, 0x6C62272E], dtype=np.uint64)


def _token_records(word: str) -> bytes:
    """The tokens of what stands between two spaces, as records."""
    core = word.rstrip(".,")
    if core.isalpha():
        low = core.lower()
        flag = _NUMBER if low in NUMBER_WORDS else _UNIT_WORD if low in UNITS else 0
        if flag != _NUMBER and core[0] != low[0] and len(core) > 1 and core[1:] == low[1:]:
            flag |= _CAPITAL
        if len(core) < len(word) and "." in word[len(core) :]:
            flag |= _ENDS
        return _RECORD_BYTES.pack(xxhash.xxh64_intdigest(low), flag)
    records: list[list[int]] = []
    for token in _TOKEN.findall(word):
        first, low = token[0], token.lower()
        if first in ".!?\n":
            if not records:
                records.append([0, _NO_TOKEN])
            records[-1][1] |= _ENDS | (_BREAKS if first == "\n" else 0)
            continue
        flag = 0
        if first.isdigit() or low in NUMBER_WORDS:
            flag = _NUMBER
        elif first in SIGNS:
            flag = _SIGN
        else:
            flag = _UNIT_WORD if low in UNITS else 0
            if first != low[0] and len(token) > 1 and token[1:] == low[1:]:
                flag |= _CAPITAL
        records.append([xxhash.xxh64_intdigest(low), flag])
    return b"".join([_RECORD_BYTES.pack(*record) for record in records])


_records = Memory(_token_records, MEMO_ENTRIES)


class Tokens:
    """The tokens of some texts behind each other."""

    def __init__(self, texts: pa.Array) -> None:
        # The words of all texts, each different one looked up once.
        lists = pc.split_pattern(texts, " ")
        words = lists.values.dictionary_encode()
        known = [_records[word] for word in words.dictionary.to_numpy(zero_copy_only=False)]
        counts = np.array([len(x) for x in known], dtype=np.int64) // _RECORD.itemsize
        which = words.indices.to_numpy()
        pool = np.frombuffer(b"".join(known), dtype=_RECORD)
        tokens = ragged(pool, (np.cumsum(counts) - counts)[which], counts[which])
        ends = np.concatenate([[0], np.cumsum(counts[which])])[lists.offsets.to_numpy()]
        row = np.repeat(np.arange(len(texts)), np.diff(ends))
        flags = tokens["flags"]
        begins = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
        opening = begins | _behind(flags & _ENDS != 0)
        line = np.cumsum(begins | _behind(flags & _BREAKS != 0))
        real = flags & _NO_TOKEN == 0
        #: Of each token: a hash in lower case, and its text, line and place.
        self.hashes, flags, self.row = tokens["hash"][real], flags[real], row[real]
        self.line, opening = line[real], opening[real]
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.place = np.arange(len(self.row)) - (np.cumsum(self.counts) - self.counts)[self.row]
        number, capital = flags & _NUMBER != 0, flags & _CAPITAL != 0
        after_number = _behind(number) & (self.place > 0)
        #: Its type: a name is a capitalised word inside a sentence; a unit is a unit word behind
        #: a number, or a percent or money sign.
        self.kinds = np.where(capital & ~opening, NAME, WORD)
        self.kinds[(flags & _SIGN != 0) | (flags & _UNIT_WORD != 0) & after_number] = UNIT
        self.kinds[number] = NUMBER
        #: Where words are capitalised that open a sentence.
        self.opening = capital & opening & (self.kinds == WORD)

    def readings(self) -> Iterator[tuple[np.ndarray, int]]:
        """Types of tokens, and the least number of words in a window.

        The template is the first. The others have capitals that open a sentence as names, and
        all tokens as they are in lower case, where windows need no words.
        """
        yield self.kinds, WINDOW_WORDS
        if self.opening.any():
            yield np.where(self.opening, NAME, self.kinds), WINDOW_WORDS
        yield np.zeros(len(self.kinds), dtype=self.kinds.dtype), 0


def _behind(marks: np.ndarray) -> np.ndarray:
    """Whether the one before is marked."""
    return np.concatenate([[False], marks[:-1]])[: len(marks)]


def template(text: str, opening_names: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each token in lower case, and its type.

    With ``opening_names`` a capitalised word is a name anywhere.
    """
    tokens = Tokens(pa.array([text], pa.string()))
    kinds = np.where(tokens.opening, NAME, tokens.kinds) if opening_names else tokens.kinds
    return tokens.hashes, kinds


_powers = [np.ones(1, dtype=np.uint64)] * 2


def _powers_of(count: int) -> list[np.ndarray]:
    """The powers of a factor and of its inverse, kept as far as they were needed."""
    if len(_powers[0]) < count:
        for place, factor in enumerate((_FACTOR, _INVERSE)):
            made = np.full(2 * count, factor, dtype=np.uint64)
            made[0] = 1
            _powers[place] = np.multiply.accumulate(made)
    return _powers


class Windows:
    """Hashes of the windows of one reading, of any size, from sums over the tokens before."""

    def __init__(self, tokens: Tokens, kinds: np.ndarray, least_words: int) -> None:
        self._row, self._least = tokens.row, least_words
        coded = np.where(kinds == WORD, tokens.hashes, _PLACEHOLDERS[kinds])
        powers, self._inverse = _powers_of(len(coded) + 1)
        zero = np.zeros(1, dtype=np.uint64)
        self._sums = np.concatenate([zero, np.cumsum(coded * powers[: len(coded)], dtype=np.uint64)])
        self._words = np.concatenate([[0], np.cumsum(kinds == WORD)]) if least_words else None

    def hashes(self, size: int) -> np.ndarray:
        """A hash per first token; zero where a window would leave its text or has few words."""
        count = len(self._row) - size + 1
        made = np.zeros(len(self._row), dtype=np.uint64)
        if count < 1 or size < 1:
            return made.view(np.int64)
        total = (self._sums[size:] - self._sums[:count]) * self._inverse[:count]
        total ^= total >> np.uint64(29)
        total = total * _FACTOR + np.uint64(size)
        total ^= total >> np.uint64(32)
        total[self._row[size - 1 :] != self._row[:count]] = 0
        if self._words is not None:
            total[self._words[size:] - self._words[:count] < self._least] = 0
        made[:count] = total
        return made.view(np.int64)


_FIELDS = "key {kind}, hash long, place int, tokens int, size int, slots array<long>"


def _windows(df: DataFrame, choose) -> DataFrame:
    """``key, hash, place, tokens, size, slots`` of the windows that are chosen.

    ``choose`` gives ``size, mask`` for tokens and what makes hashes of a size. ``slots`` has the
    value of each placeholder, typed, and zero for words. A window that is the same in several
    readings is given once.
    """
    ready_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["text"], SLICE_BYTES):
            tokens = Tokens(part["text"].cast(pa.string()))
            seen: dict[int, list[np.ndarray]] = {}
            for kinds, least_words in tokens.readings():
                windows = Windows(tokens, kinds, least_words)
                slots = None
                for size, made, chosen in choose(tokens, windows):
                    for other in seen.get(size, []):
                        chosen = chosen[made[chosen] != other[chosen]]
                    seen.setdefault(size, []).append(made)
                    if not len(chosen):
                        continue
                    if slots is None:
                        typed = tokens.hashes * np.uint64(4) + kinds.astype(np.uint64)
                        slots = np.where(kinds == WORD, np.uint64(0), typed).view(np.int64)
                    values = slots[chosen[:, None] + np.arange(size)].ravel()
                    edges = pa.array(np.arange(len(chosen) + 1) * size, pa.int32())
                    row = tokens.row[chosen]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["key"].take(pa.array(row)),
                            pa.array(made[chosen]),
                            pa.array(tokens.place[chosen], pa.int32()),
                            pa.array(tokens.counts[row], pa.int32()),
                            pa.array(np.full(len(chosen), size), pa.int32()),
                            pa.ListArray.from_arrays(edges, pa.array(values)),
                        ],
                        ["key", "hash", "place", "tokens", "size", "slots"],
                    )

    kind = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, _FIELDS.format(kind=kind))


def _of_items(tokens: Tokens, windows: Windows):
    """All windows, or a whole text of fewer tokens."""
    sizes = np.minimum(tokens.counts, WINDOW)
    of = sizes[tokens.row]
    for size in np.unique(sizes[sizes > 0]).tolist():
        made = windows.hashes(size)
        yield size, made, np.flatnonzero((made != 0) & (of == size))


def _passing(sizes: list[int], bits):
    """Windows of the given sizes whose bit is set in the filter.

    Where an item has fewer than ``LEAST_TOKENS``, only a line that is just that counts.
    """

    def choose(tokens: Tokens, windows: Windows):
        filled = np.frombuffer(bits.value, np.uint8)
        for size in sizes:
            made = windows.hashes(size)
            place = made & (FILTER_BITS - 1)
            hit = filled[place >> 3] >> (place & 7).astype(np.uint8) & 1
            chosen = np.flatnonzero(hit.astype(bool) & (made != 0))
            if size < LEAST_TOKENS and len(chosen):
                line = np.concatenate([[-1], tokens.line, [-1]])
                last = chosen + size - 1
                whole = line[chosen + 1] == line[last + 1]
                whole &= (line[chosen] != line[chosen + 1]) & (line[last + 2] != line[last + 1])
                chosen = chosen[whole]
            yield size, made, chosen

    return choose


def _tokens_of(places: list[int], size: int) -> int:
    """Tokens under windows at sorted places."""
    return sum(min(b - a, size) for a, b in zip(places, places[1:])) + size if places else 0


def consistent_tokens(windows: list[tuple[int, list[tuple[int, int]]]], size: int) -> int:
    """The most tokens under windows whose slots map one to one.

    ``windows`` has places and ``(slot, doc_slot)`` pairs. Tried are the windows without a
    changed value, those that agree with the most frequent pairs, and every run of windows.
    """
    windows = sorted((place, frozenset(pairs)) for place, pairs in windows)
    counts = Counter(pair for _, pairs in windows for pair in pairs)
    chosen, taken = {}, set()
    for a, b in sorted(counts, key=lambda pair: (-counts[pair], pair[0] != pair[1], pair)):
        if a not in chosen and b not in taken:
            chosen[a] = b
            taken.add(b)
    same = [place for place, pairs in windows if all(a == b for a, b in pairs)]
    agreeing = [place for place, pairs in windows if all(chosen.get(a) == b for a, b in pairs)]
    best = max(_tokens_of(same, size), _tokens_of(agreeing, size))
    steps = [0, *(min(b[0] - a[0], size) for a, b in zip(windows, windows[1:]))]
    before = list(accumulate(steps))
    held, sides, clashes, first = Counter(), Counter(), 0, 0
    for last, (_, pairs) in enumerate(windows):
        for a, b in pairs:
            held[a, b] += 1
            if held[a, b] == 1:
                for side in ((0, a), (1, b)):
                    clashes += sides[side] > 0
                    sides[side] += 1
        while clashes:
            for a, b in windows[first][1]:
                held[a, b] -= 1
                if held[a, b] == 0:
                    for side in ((0, a), (1, b)):
                        sides[side] -= 1
                        clashes -= sides[side] > 0
            first += 1
        if first <= last:
            best = max(best, before[last] - before[first] + size)
    return best


def _cut_at_clashes(aligned: DataFrame) -> DataFrame:
    """``covered`` found anew for alignments that have ``windows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            covered = part["covered"].to_pylist()
            for row, (windows, size) in enumerate(zip(part["windows"], part["size"])):
                if windows.is_valid:
                    made = [
                        (w["place"], [(p["slots"], p["doc_slots"]) for p in w["pairs"]])
                        for w in windows.as_py()
                    ]
                    covered[row] = consistent_tokens(made, size.as_py())
            names = [*kept, "covered"]
            columns = [*(part[name] for name in kept), pa.array(covered, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = ["doc_id", "item_id", "tokens"]
    fields = [f"{name} {aligned.schema[name].dataType.simpleString()}" for name in kept]
    return aligned.select(*kept, "size", "covered", "windows").mapInArrow(
        run, ", ".join([*fields, "covered int"])
    )


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(column(id_column).alias("key"), text_or_empty(text_column).alias("text"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``doc_id, item_id, matched_tokens, item_tokens`` of documents that hold an item.

    Windows of ``WINDOW`` template tokens are joined by hash. All that a document shares with an
    item at one distance is an alignment; its slots must map one to one, and it must cover
    ``COVERED_TOKENS`` of the item's tokens or ``COVERED_SHARE`` of them. Where slots clash, the
    part that is consistent counts, so one edited value hides no passage. The pair's best
    alignment is reported.

    Windows of fewer than ``WINDOW_WORDS`` words say too little as templates. So texts also meet
    in windows of equal tokens in lower case, however few words these have, and in templates that
    take a capital which opens a sentence for a name's. An item of fewer than ``WINDOW`` tokens
    is one window, and one of fewer than ``LEAST_TOKENS`` is found only where a line of the
    document holds nothing else.

    Null and empty texts hold nothing. Very long ones are searched whole. Rows with a null id are
    reported with it; rows repeated with their id are one document, repeated items one item.
    Empty tables give an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    wanted = stored(
        _windows(_texts(items, item_column, item_text_column), _of_items)
        .dropDuplicates(["key", "hash", "place"]),
        "item_windows",
    )
    # At most WINDOW different sizes.
    sizes = sorted(row[0] for row in wanted.select("size").distinct().collect())
    # At most FILTER_BITS places, however many items there are.
    places = wanted.select(F.col("hash").bitwiseAND(FILTER_BITS - 1).alias("bit")).distinct()
    set_bits = np.zeros(FILTER_BITS, dtype=bool)
    set_bits[places.toArrow()["bit"].to_numpy()] = True
    bits = spark.sparkContext.broadcast(np.packbits(set_bits, bitorder="little").tobytes())
    met = _windows(_texts(docs, id_column, text_column), _passing(sizes, bits))
    met = met.select(
        F.col("key").alias("doc_id"), "hash", "size",
        F.col("place").alias("doc_place"), F.col("slots").alias("doc_slots"),
    )
    wanted = wanted.select(
        F.col("key").alias("item_id"), "hash", "size", "place", "tokens", "slots"
    )
    both = met.join(wanted, ["hash", "size"]).withColumn(
        "pairs",
        F.filter(F.arrays_zip("slots", "doc_slots"), lambda pair: pair["slots"] != 0),
    )
    aligned = both.groupBy(
        "doc_id", "item_id", "tokens", "size", (F.col("doc_place") - F.col("place")).alias("shift")
    ).agg(
        F.sort_array(F.collect_set("place")).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.collect_set(F.struct("place", "pairs")).alias("windows"),
    )
    one_to_one = (
        F.size("pairs") == F.size(F.array_distinct(F.col("pairs.slots")))
    ) & (F.size("pairs") == F.size(F.array_distinct(F.col("pairs.doc_slots"))))
    steps = F.zip_with(
        F.expr("slice(places, 2, size(places))"),
        F.expr("slice(places, 1, size(places) - 1)"),
        lambda after, before: F.least(after - before, F.col("size")),
    )
    covered = F.aggregate(steps, F.col("size"), lambda total, step: total + step)
    enough = F.least(F.lit(COVERED_TOKENS), F.ceil(F.col("tokens") * COVERED_SHARE))
    aligned = aligned.withColumn("covered", covered)
    clashing = F.when(~one_to_one, F.col("windows"))
    aligned = _cut_at_clashes(aligned.withColumn("windows", clashing))
    return (
        aligned
        .where(F.col("covered") >= enough)
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("covered").cast("long").alias("matched_tokens"),
            F.max("tokens").cast("long").alias("item_tokens"),
        )
    )


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no item, as :func:`find_leaks` finds them.

    A row is known by its id, which may be null, and its text; rows repeated with both share a
    decision. Null and empty texts stay. Long texts are searched whole. An empty table stays
    empty, and without items every row stays. Columns may have any names.
    """
    keyed = docs.select(
        row_key(id_column, text_column).alias("key"), text_or_empty(text_column).alias("text")
    )
    leaks = find_leaks(keyed, items, "key", "text")
    return without_rows(docs, leaks.select("doc_id"), id_column, text_column)
