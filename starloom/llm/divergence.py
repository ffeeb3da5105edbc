"""How the sources of each language differ in their words, by one pass over the texts.

Every task indexes its documents in memory: postings of (term, source) with counts, as a block.
When a block is full it is spilled as a run, sorted by term and cut into hash shards. A shard's
runs are merged with a heap into the terms' frequencies, and frequent terms are kept with their
postings. Pairs of sources are compared over all kept terms: most terms are missing from most
sources, so a sum over all of them is taken as if every term was missing from both, and what
really occurs streams by as corrections.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import (
    arrow_slices,
    column,
    ready_workers,
    stored,
    text_or_empty,
    word_blocks,
)

#: A term is kept in a language that has it in so many documents.
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TERM_RANKS = 10
#: A block is spilled when its postings and terms take about so many bytes.
SPILL_BYTES = 128 << 20
#: Shards for each shuffle partition: a partition merges one after the other.
SHARDS_A_PARTITION = 8
#: Sums that a task keeps before it hands them on, one for each pair of sources it has met.
HELD_PAIRS = 1 << 21

_POSTING_BYTES, _TERM_BYTES = 24, 200


def _as_term(byte: int) -> int:
    if 0x41 <= byte <= 0x5A:
        return byte + 0x20
    return byte if byte >= 0x80 or 0x61 <= byte <= 0x7A else 0x20


#: Letters in lower case and all bytes of characters beyond ASCII; anything else is a space.
TERM_BYTES = bytes(map(_as_term, range(256)))


class _Numbers(dict):
    """A number per key, in the order of first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Block:
    """Postings of some documents, in memory."""

    def __init__(self) -> None:
        self._terms, self._groups = _Numbers(), _Numbers()
        self._keys: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._postings = 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        """Count a document, a part of a long text at a time."""
        number = self._terms.__getitem__
        parts = [
            np.fromiter(map(number, words), dtype=np.int64, count=len(words))
            for words in word_blocks(text.translate(TERM_BYTES))
        ]
        terms, counts = np.unique(np.concatenate(parts), return_counts=True)
        if len(terms):
            self._keys.append(terms << 32 | self._groups[lang, source])
            self._counts.append(counts)
            self._postings += len(terms)

    @property
    def bytes(self) -> int:
        return _POSTING_BYTES * self._postings + _TERM_BYTES * len(self._terms)

    def runs(self, shards: int) -> Iterator[tuple[int, bytes, bytes]]:
        """``shard, first key, run`` of each shard that has terms, the run sorted by key.

        A key is language and term; terms hold no zero byte.
        """
        if not self._postings:
            return
        keys, counts = np.concatenate(self._keys), np.concatenate(self._counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        occurrences = np.add.reduceat(counts, first)
        documents = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        terms, groups = list(self._terms), list(self._groups)
        langs = _Numbers()
        lang_of = np.array([langs[lang] for lang, _ in groups], dtype=np.int64)
        group = keys & 0xFFFFFFFF
        # One entry per language and term.
        entries, entry = np.unique(
            (keys >> 32) * len(langs) + lang_of[group], return_inverse=True
        )
        lang_names = list(langs)
        names = [
            lang_names[lang] + b"\0" + terms[term]
            for term, lang in zip((entries // len(langs)).tolist(), (entries % len(langs)).tolist())
        ]
        shard = np.array([crc32(name) % shards for name in names], dtype=np.int64)
        by_name = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), dtype=np.int64)
        rank[by_name] = np.arange(len(names))
        order = np.lexsort((rank[entry], shard[entry]))
        entry, group = entry[order], group[order]
        occurrences, documents = occurrences[order], documents[order]
        starts = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
        sizes = np.diff(np.append(starts, len(entry)))
        sorted_entries = entry[starts]
        cuts = np.flatnonzero(np.diff(shard[sorted_entries])) + 1
        sources = [source for _, source in groups]
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]):
            held = [names[i] for i in sorted_entries[low:high].tolist()]
            a, b = int(starts[low]), int(starts[high]) if high < len(starts) else len(entry)
            used, places = np.unique(group[a:b], return_inverse=True)
            run = (
                held,
                sizes[low:high].tolist(),
                [sources[i] for i in used.tolist()],
                places.astype("<u4").tobytes(),
                occurrences[a:b].astype("<i8").tobytes(),
                documents[a:b].astype("<i8").tobytes(),
            )
            yield int(shard[sorted_entries[low]]), held[0], pickle.dumps(run)


def _entries(run: bytes) -> Iterator[tuple[bytes, list[tuple[bytes, int, int]]]]:
    """The keys of a run with their postings."""
    keys, sizes, sources, places, occurrences, documents = pickle.loads(run)
    of = [sources[i] for i in np.frombuffer(places, "<u4").tolist()]
    postings = list(
        zip(of, np.frombuffer(occurrences, "<i8").tolist(), np.frombuffer(documents, "<i8").tolist())
    )
    at = 0
    for key, size in zip(keys, sizes):
        yield key, postings[at : at + size]
        at += size


def merge_runs(
    runs: Iterator[tuple[int, bytes, bytes]],
) -> Iterator[tuple[bytes, list[tuple[bytes, int, int]]]]:
    """All keys with their postings, sorted within a shard, equal keys one after the other.

    ``runs`` come by shard and first key, so one is opened only when the merge has reached it.
    """
    heap: list[tuple] = []
    now, serial = None, 0

    def before(key: bytes | None):
        while heap and (key is None or heap[0][0] < key):
            found, number, postings, rest = heap[0]
            yield found, postings
            following = next(rest, None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], number, following[1], rest))

    for shard, first, run in runs:
        yield from before(None if shard != now else first)
        now = shard
        rest = _entries(run)
        key, postings = next(rest)
        heapq.heappush(heap, (key, serial, postings, rest))
        serial += 1
    yield from before(None)


def _totals(merged) -> Iterator[tuple[bytes, dict[bytes, int], int]]:
    """``key, counts by source, documents`` of equal keys taken together."""
    last, counts, documents = None, {}, 0
    for key, postings in merged:
        if key != last:
            if last is not None:
                yield last, counts, documents
            last, counts, documents = key, {}, 0
        for source, n, seen in postings:
            counts[source] = counts.get(source, 0) + n
            documents += seen
    if last is not None:
        yield last, counts, documents


def _texts_of(array: pa.Array) -> list[bytes]:
    return array.cast(pa.binary()).to_pylist()


def term_frequencies(rows: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, postings`` (``source, n``) of the terms that enough documents of a language have.

    ``rows`` has ``text, lang, source`` without nulls. Sources without the term have no posting.
    """
    spark = rows.sparkSession
    ready_workers(spark)
    shards = SHARDS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spilled(block: Block) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []
            for run in block.runs(shards):
                held.append(run)
                if len(held) == 1000:
                    yield _records(held, ("shard", "first", "run"), _RUN)
                    held = []
            yield _records(held, ("shard", "first", "run"), _RUN)

        block = Block()
        for part in arrow_slices(batches, ["text"]):
            for row in zip(*(_texts_of(part[name]) for name in ("lang", "source", "text"))):
                block.add(*row)
                if block.bytes >= SPILL_BYTES:
                    yield from spilled(block)
                    block = Block()
        yield from spilled(block)

    runs = rows.select("text", "lang", "source").mapInArrow(
        index, "shard int, first binary, run binary"
    )
    dealt = runs.repartition("shard").sortWithinPartitions("shard", "first")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arriving = (
            row
            for part in arrow_slices(batches, ["run"], 1 << 20)
            for row in zip(*(part[name].to_pylist() for name in ("shard", "first", "run")))
        )
        held: list[tuple] = []
        for key, counts, documents in _totals(merge_runs(arriving)):
            if documents >= least_documents:
                lang, term = key.rsplit(b"\0", 1)
                postings = [{"source": source, "n": n} for source, n in sorted(counts.items())]
                held.append((lang, term, postings))
                if len(held) == 4000:
                    yield _records(held, ("lang", "term", "postings"), _FREQUENCY)
                    held = []
        yield _records(held, ("lang", "term", "postings"), _FREQUENCY)

    kinds = "lang binary, term binary, postings array<struct<source: binary, n: bigint>>"
    merged = dealt.mapInArrow(merge, kinds)
    return merged.select(
        F.col("lang").cast("string"),
        F.col("term").cast("string"),
        F.col("postings").cast("array<struct<source: string, n: bigint>>"),
    )


_RUN = (pa.int32(), pa.binary(), pa.binary())
_POSTING = pa.struct([("source", pa.binary()), ("n", pa.int64())])
_FREQUENCY = (pa.binary(), pa.binary(), pa.list_(_POSTING))


def _records(rows: list[tuple], names: tuple, kinds: tuple) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _probability(count: str, total: str, terms: str) -> Column:
    """A smoothed share in billionths, rounded down, plus 1; null without terms."""
    size = f"nullif(cast({total} + 2 * {terms} as decimal(20, 0)), 0)"
    share = f"cast({SCALE} as decimal(10, 0)) * cast({count} + 2 as decimal(20, 0)) div {size}"
    return F.expr(f"1 + {share}")


def _divergence_of(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def pair_corrections(terms: DataFrame) -> DataFrame:
    """``lang, one, other, value`` of ``lang, held`` (``source, p, p0``), partial sums.

    For two sources that both have a term: their divergence there, less what it would be if
    either lacked the term, plus what it would be if both did.
    """
    ready_workers(terms.sparkSession)
    names, kinds = ("lang", "one", "other", "value"), (*[pa.string()] * 3, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _PairSums()
        for part in batches:
            for lang, held in zip(part["lang"].to_pylist(), part["held"].to_pylist()):
                held.sort(key=lambda x: x["source"])
                sources = [x["source"] for x in held]
                p, base = (np.array([x[k] for x in held], dtype=np.int64) for k in ("p", "p0"))
                for low in range(0, len(held), 256):
                    # Some sources against all: bounded however many have the term.
                    some = slice(low, low + 256)
                    value = (
                        _divergence(p[some, None], p)
                        - _divergence(p[some, None], base)
                        - _divergence(base[some, None], p)
                        + _divergence(base[some, None], base)
                    )
                    sums.add(lang, sources[some], sources, value)
                    if sums.held > HELD_PAIRS:
                        yield from (_records(rows, names, kinds) for rows in sums.drain())
        yield from (_records(rows, names, kinds) for rows in sums.drain())

    return terms.mapInArrow(run, "lang string, one string, other string, value long")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


class _PairSums:
    """Sums for pairs of sources, kept as rows of numbers."""

    def __init__(self) -> None:
        self._places: dict[str, _Numbers] = {}
        self._rows: dict[tuple[str, str], np.ndarray] = {}
        self.held = 0

    def add(self, lang: str, ones: list[str], others: list[str], values: np.ndarray) -> None:
        places = self._places.setdefault(lang, _Numbers())
        at = np.fromiter(map(places.__getitem__, others), dtype=np.int64, count=len(others))
        for one, row in zip(ones, values):
            total = self._rows.get((lang, one))
            if total is None or len(total) < len(places):
                grown = np.zeros(max(16, 2 * len(places)), dtype=np.int64)
                if total is not None:
                    grown[: len(total)] = total
                    self.held -= len(total)
                self._rows[lang, one] = total = grown
                self.held += len(grown)
            total[at] += row

    def drain(self) -> Iterator[list[tuple]]:
        """All sums but those of a source with itself; nothing is left."""
        for (lang, one), total in self._rows.items():
            names = list(self._places[lang])
            yield [
                (lang, one, names[i], int(total[i]))
                for i in np.flatnonzero(total).tolist()
                if names[i] != one
            ]
        self.__init__()


def _pairs(groups: DataFrame, weights: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language."""
    one = groups.select("lang", "source", "p0", "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    missing = one.join(other, "lang").where("source <> item").select(
        "lang", "source", "item",
        F.coalesce(F.expr(f"terms * {_divergence_of('p0', 'q0')}"), F.lit(0)).alias("value"),
    )
    # Terms of one count in a source are alike to a source that lacks them.
    alike = weights.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    change = f"n * ({_divergence_of('p', 'q0')} - {_divergence_of('p0', 'q0')})"
    present = stored(
        alike.join(other, "lang")
        .where("source <> item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.expr(change)).alias("value")),
        "present",
    )
    mirrored = present.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"
    )
    held = weights.groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "p", "p0")).alias("held")
    )
    both = pair_corrections(held.where(F.size("held") > 1).select("lang", "held"))
    both = both.toDF("lang", "source", "item", "value")
    parts = missing.unionByName(present).unionByName(mirrored).unionByName(both)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets each source of a language apart.

    Terms are runs of letters and of characters beyond ASCII, with A-Z in lower case; a language
    keeps those that ``least_documents`` of its rows have. In a source, or in the whole language,
    a kept term has a share ``p = 1 + floor(10**9 (count + 2) / (N + 2 V))`` of its N occurrences
    of V kept terms, and two shares differ by ``floor((p - q)**2 / (p + q))``; all numbers are
    whole and exact.

    Part ``pair`` has every other source of the language as item, and as value the difference
    summed over all kept terms (0 if there are none). Part ``term`` has the ``term_ranks`` terms
    that differ most from the whole language among those the source has and uses more. Ranks
    count from 1 by falling value, ties by item in UTF-8 order.

    Null texts, languages and sources count as empty ones; a source without terms is compared
    like any other, one that is alone in its language has no pairs. Every row is a document, also
    one that is repeated. Long texts are read in blocks. An empty table gives an empty result;
    other columns are not looked at.
    """
    rows = docs.select(
        text_or_empty(text_column).alias("text"),
        F.coalesce(column(lang_column).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(column(source_column).cast("string"), F.lit("")).alias("source"),
    )
    frequencies = stored(term_frequencies(rows, least_documents), "frequencies")
    whole = F.aggregate("postings", F.lit(0).cast("long"), lambda total, x: total + x["n"])
    counted = frequencies.withColumn("whole", whole)
    langs = counted.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("whole").alias("lang_total")
    )
    postings = counted.select("lang", "term", "whole", F.explode("postings").alias("x")).select(
        "lang", "term", "whole", "x.source", "x.n"
    )
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = stored(
        groups.withColumn("_none", F.lit(0)).select(
            "*", _probability("_none", "total", "terms").alias("p0")
        ).drop("_none"),
        "groups",
    )
    weights = stored(
        postings.join(groups, ["lang", "source"]).select(
            "lang", "term", "source", "p0",
            _probability("n", "total", "terms").alias("p"),
            _probability("whole", "lang_total", "terms").alias("q"),
        ),
        "weights",
    )
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = stored(_pairs(groups, weights), "pairs").withColumn("rank", F.row_number().over(own))
    terms = (
        weights.where("p > q")
        .select(
            "lang", "source", F.col("term").alias("item"),
            F.expr(_divergence_of("p", "q")).alias("value"),
        )
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= term_ranks)
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(columns))
    )
