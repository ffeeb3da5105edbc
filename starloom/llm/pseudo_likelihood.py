"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts each token from the tokens around it, on both sides. The words of all
documents are counted for its vocabulary, and it is trained on all documents: every task takes
steps over its own documents, masking one position in ``MASKED``, and the tasks' networks are
averaged by the number of positions they saw, in ``ROUNDS`` rounds. A document's score is the sum
of the log-probabilities of all its tokens.

The network knows the most frequent tokens one by one and all others by their endings. A token of
an ending has its share of it, by the counts of all documents, so that every token has a
probability of its own and those of all tokens sum to one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    Memory,
    add_vectors,
    arrow_slices,
    column,
    ready_workers,
    stored,
    text_or_empty,
)

#: Tokens are grouped into classes, which are predicted first, and then within their class.
CLASSES = 32
IN_CLASS = 32
VOCABULARY = CLASSES * IN_CLASS
#: Tokens outside the vocabulary are told apart by their ending only.
ENDINGS = 256
WORDS = VOCABULARY - ENDINGS
ENDING_CHARS = 3
#: Counts of the tokens outside the vocabulary are kept in at most so many cells, four bytes each;
#: tokens that share a cell share the mean of their counts.
CELLS = 1 << 22
#: Counts as so often if no document has it.
UNSEEN = 0.5
#: Stands beyond both ends of a document.
EDGE = VOCABULARY

SIDE = 2
WIDTH = 16
MASKED = 4
ROUNDS = 2
BATCH = 4096
RATE = 0.1
#: Parameters are averaged in so many slices.
SLICES = 16
COUNTED_WORDS = 500_000
MEMO_ENTRIES = 300_000

_MARKS = ".,;:!?"
_OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


def tokens_of(word: str) -> list[str]:
    """A word in lower case without its closing marks, and these."""
    core = word.rstrip(_MARKS)
    return [part for part in (core, word[len(core) :]) if part]


@dataclass
class Network:
    """The parameters; every array is of 32-bit floats."""

    embeddings: np.ndarray
    places: np.ndarray
    hidden_bias: np.ndarray
    class_weights: np.ndarray
    class_bias: np.ndarray
    word_weights: np.ndarray
    word_bias: np.ndarray

    @classmethod
    def fresh(cls, counts: np.ndarray) -> Network:
        """Predicts tokens by their counts, wherever they stand."""
        draw = np.random.default_rng(0)

        def small(*shape: int) -> np.ndarray:
            return draw.normal(0, 0.3, shape).astype(np.float32)

        known = (counts + 0.5).reshape(CLASSES, IN_CLASS)
        return cls(
            small(VOCABULARY + 1, WIDTH),
            (1 + small(2 * SIDE, WIDTH)) / (2 * SIDE),
            np.zeros(WIDTH, dtype=np.float32),
            small(WIDTH, CLASSES) * 0.1,
            np.log(known.sum(axis=1) / known.sum()).astype(np.float32),
            small(CLASSES, WIDTH, IN_CLASS) * 0.1,
            np.log(known / known.sum(axis=1, keepdims=True)).astype(np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, field.name) for field in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([array.ravel() for array in self.arrays()])

    def like(self, flat: np.ndarray) -> Network:
        """A network of this shape with other values."""
        shapes = [array.shape for array in self.arrays()]
        parts = np.split(flat, np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1])
        return Network(*(p.reshape(s).astype(np.float32) for p, s in zip(parts, shapes)))

    def _hidden(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.tile(self.hidden_bias, (len(at), 1))
        for place, offset in enumerate(_OFFSETS):
            total += self.embeddings[ids[at + offset]] * self.places[place]
        return np.tanh(total, out=total)

    def log_probabilities(self, ids: np.ndarray, at: np.ndarray, learn: bool = False):
        """The log-probability of the token at each place, given those around it.

        With ``learn``, the gradient of their negative mean is returned as well. ``ids`` is
        edged, so that a place has ``SIDE`` tokens on each side.
        """
        hidden = self._hidden(ids, at)
        kinds, members = np.divmod(ids[at].astype(np.int64), IN_CLASS)
        rows = np.arange(len(at))
        scores = hidden @ self.class_weights + self.class_bias
        scores -= scores.max(axis=1, keepdims=True)
        found = scores[rows, kinds]
        np.exp(scores, out=scores)
        sums = scores.sum(axis=1)
        found = found - np.log(sums)
        slope = None
        if learn:
            scores /= sums[:, None]
            scores[rows, kinds] -= 1
            scores /= len(at)
            slope = {
                "class_weights": hidden.T @ scores,
                "class_bias": scores.sum(axis=0),
                "word_weights": np.zeros_like(self.word_weights),
                "word_bias": np.zeros_like(self.word_bias),
            }
            back = scores @ self.class_weights.T
        order = np.argsort(kinds, kind="stable")
        cuts = np.searchsorted(kinds[order], np.arange(CLASSES + 1))
        for kind, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if start == end:
                continue
            chosen = order[start:end]
            inner = hidden[chosen] @ self.word_weights[kind] + self.word_bias[kind]
            inner -= inner.max(axis=1, keepdims=True)
            here = np.arange(end - start)
            right = inner[here, members[chosen]]
            np.exp(inner, out=inner)
            sums = inner.sum(axis=1)
            found[chosen] += right - np.log(sums)
            if learn:
                inner /= sums[:, None]
                inner[here, members[chosen]] -= 1
                inner /= len(at)
                slope["word_weights"][kind] = hidden[chosen].T @ inner
                slope["word_bias"][kind] = inner.sum(axis=0)
                back[chosen] += inner @ self.word_weights[kind].T
        if not learn:
            return found
        back *= 1 - hidden**2
        slope["hidden_bias"] = back.sum(axis=0)
        slope["places"] = np.empty_like(self.places)
        slope["embeddings"] = np.zeros_like(self.embeddings)
        for place, offset in enumerate(_OFFSETS):
            near = ids[at + offset]
            slope["places"][place] = np.einsum("ij,ij->j", back, self.embeddings[near])
            moved = back * self.places[place]
            for dimension in range(WIDTH):
                slope["embeddings"][:, dimension] += np.bincount(
                    near, moved[:, dimension], VOCABULARY + 1
                )
        return found, Network(**slope)


class Trainer:
    """Takes steps of adaptive size over batches of masked places."""

    def __init__(self, network: Network) -> None:
        self.network = network.like(network.flat().copy())
        self._seen = [np.full_like(array, 1e-4) for array in network.arrays()]
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0
        self.places = 0

    def add(self, ids: np.ndarray, at: np.ndarray) -> None:
        """Edged ids and the places to predict; a step is taken when there are enough."""
        for start in range(0, len(at), BATCH):
            part = at[start : start + BATCH]
            self._held.append((ids[part[0] - SIDE : part[-1] + SIDE + 1], part - part[0] + SIDE))
            self._size += len(part)
            if self._size >= BATCH:
                self.step()

    def step(self) -> None:
        if not self._size:
            return
        sizes = np.cumsum([0, *(len(ids) for ids, _ in self._held)])
        at = np.concatenate([places + size for (_, places), size in zip(self._held, sizes)])
        ids = np.concatenate([ids for ids, _ in self._held])
        _, slope = self.network.log_probabilities(ids, at, learn=True)
        for values, seen, change in zip(self.network.arrays(), self._seen, slope.arrays()):
            seen += change**2
            values -= RATE * change / np.sqrt(seen)
        self.places += self._size
        self._held, self._size = [], 0


def edged(ids: np.ndarray) -> np.ndarray:
    edge = np.full(SIDE, EDGE, dtype=np.int64)
    return np.concatenate([edge, ids, edge])


def score_lines(network: Network, lines: list[np.ndarray]) -> np.ndarray:
    """The sum of all conditional log-probabilities of each document, in batches of places."""
    sizes = np.array([len(ids) for ids in lines], dtype=np.int64)
    if not sizes.sum():
        return np.zeros(len(lines))
    line = np.concatenate([edged(ids) for ids in lines])
    at = np.flatnonzero(line != EDGE)
    found = [
        network.log_probabilities(line, at[start : start + BATCH])
        for start in range(0, len(at), BATCH)
    ]
    totals = np.concatenate([[0.0], np.cumsum(np.concatenate(found), dtype=np.float64)])
    ends = np.cumsum(sizes)
    return totals[ends] - totals[ends - sizes]


def count_tokens(texts: DataFrame) -> DataFrame:
    """``token, count`` over all rows of a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(words: Counter) -> pa.RecordBatch:
            tokens: Counter = Counter()
            for word, count in words.items():
                for token in tokens_of(word):
                    tokens[token] += count
            names = pa.array(list(tokens), pa.string())
            return pa.RecordBatch.from_arrays(
                [names, pa.array(list(tokens.values()), pa.int64())], ["token", "count"]
            )

        words: Counter = Counter()
        for part in arrow_slices(batches, ["text"], 4 << 20):
            for text in part["text"]:
                words.update(text.as_py().lower().split())
                if len(words) >= COUNTED_WORDS:
                    yield counted(words)
                    words = Counter()
        yield counted(words)

    rows = texts.mapInArrow(run, "token string, count long")
    return rows.groupBy("token").agg(F.sum("count").alias("count"))


def ending_of(token: str) -> int:
    return zlib.crc32(token[-ENDING_CHARS:].encode()) % ENDINGS


@dataclass
class Vocabulary:
    places: dict[str, int]
    counts: np.ndarray
    #: The mean count of the tokens in each cell, and the sum of these over an ending's tokens.
    cells: np.ndarray
    ending_sums: np.ndarray

    def share(self, token: str) -> float:
        """A token's part of the probability of its ending."""
        cell = float(self.cells[zlib.crc32(token.encode()) % len(self.cells)])
        return max(cell, UNSEEN) / max(self.ending_sums[ending_of(token)], UNSEEN)

    def ids_of(self, word: str) -> tuple[bytes, float]:
        """The places of a word's tokens, and the logarithm of their shares."""
        ids, shares = [], 0.0
        for token in tokens_of(word):
            place = self.places.get(token)
            if place is None:
                place = WORDS + ending_of(token)
                shares += math.log(self.share(token))
            ids.append(place)
        return np.array(ids, dtype="<u2").tobytes(), shares


def fit_vocabulary(texts: DataFrame) -> Vocabulary:
    """The ``WORDS`` most frequent tokens, ties by name, and counts of all tokens."""
    spark = texts.sparkSession
    counted = stored(count_tokens(texts), "token_counts")
    best = counted.orderBy(F.desc("count"), "token").limit(WORDS).collect()
    counts = np.zeros(VOCABULARY)
    places = {row.token: place for place, row in enumerate(best)}
    counts[: len(best)] = [row["count"] for row in best]
    ending = F.crc32(F.right("token", F.lit(ENDING_CHARS)).cast("binary")) % ENDINGS
    # The vocabulary has a fixed size.
    rest = counted.where(~F.col("token").isin(list(places))) if places else counted
    size = min(CELLS, 1 << max(8, (16 * rest.count()).bit_length()))
    cell = F.crc32(F.col("token").cast("binary")) % size
    rest = rest.select(ending.cast("int").alias("ending"), cell.cast("int").alias("cell"), "count")
    # At most ENDINGS rows.
    for row in rest.groupBy("ending").agg(F.sum("count").alias("n")).collect():
        counts[WORDS + row.ending] = row.n
    # At most CELLS rows.
    found = rest.groupBy("cell").agg(F.avg("count").cast("float").alias("mean")).toArrow()
    cells = np.zeros(size, dtype=np.float32)
    cells[found["cell"].to_numpy()] = found["mean"].to_numpy()
    shared = spark.sparkContext.broadcast(cells)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENDINGS)
        for part in batches:
            means = shared.value[part["cell"].to_numpy()].astype(np.float64)
            total += np.bincount(part["ending"].to_numpy(), means, ENDINGS)
        yield pa.RecordBatch.from_pydict({"ending": pa.array(range(ENDINGS), pa.int32()), "n": total})

    summed = rest.select("ending", "cell").mapInArrow(sums, "ending int, n double")
    ending_sums = np.zeros(ENDINGS)
    for row in summed.groupBy("ending").agg(F.sum("n").alias("n")).collect():
        ending_sums[row.ending] = row.n
    return Vocabulary(places, counts, cells, ending_sums)


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, ids, shares`` of ``doc_id, text``: binary, 16-bit, and a sum of logarithms."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memory(shared.value.ids_of, MEMO_ENTRIES)
        for part in arrow_slices(batches, ["text"], 4 << 20):
            made, shares = [], []
            for text in part["text"]:
                found = list(map(known.__getitem__, text.as_py().lower().split()))
                made.append(b"".join([ids for ids, _ in found]))
                shares.append(math.fsum([share for _, share in found]))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(made, pa.binary()), pa.array(shares, pa.float64())],
                ["doc_id", "ids", "shares"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, shares double")


def _ids(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype="<u2").astype(np.int64)


def train_round(encoded: DataFrame, network: Network, turn: int) -> Network:
    """Train on the documents of a turn, task by task, and average what they learned."""
    shared = encoded.sparkSession.sparkContext.broadcast(network)
    turn_of = F.pmod(F.xxhash64("ids"), F.lit(ROUNDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value)
        for part in arrow_slices(batches, ["ids"], 4 << 20):
            for value in part["ids"]:
                ids = _ids(value)
                # Of a short text, its last token.
                first = min((len(ids) + turn) % MASKED, len(ids) - 1)
                if len(ids):
                    trainer.add(edged(ids), np.arange(first, len(ids), MASKED) + SIDE)
        trainer.step()
        if trainer.places:
            flat = np.append(trainer.network.flat().astype(np.float64), 1.0) * trainer.places
            parts = [x.tobytes() for x in np.array_split(flat, SLICES)]
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(SLICES), pa.int32()), "vector": parts}
            )

    chosen = encoded.where(turn_of == turn).select("ids")
    learned = chosen.mapInArrow(run, "slice int, vector binary")
    # As many numbers as the network has parameters.
    parts = add_vectors(learned, ["slice"], "float64").orderBy("slice").collect()
    if not parts:
        return network
    flat = np.concatenate([np.frombuffer(part.vector, dtype=np.float64) for part in parts])
    return network.like(flat[:-1] / flat[-1])


def score_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, log_probability, mean_log_probability`` of every row.

    The network is trained on the same rows. A null text is an empty one; a text without tokens
    has the sum 0 and no mean. Null ids and repeated rows are rows like any other, long texts
    are scored whole, an empty table gives an empty result, and other columns are not looked at.
    """
    ready_workers(df.sparkSession)
    rows = df.select(column(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    vocabulary = fit_vocabulary(rows.select("text"))
    encoded = stored(encode(rows, vocabulary), "token_ids")
    network = Network.fresh(vocabulary.counts)
    for turn in range(ROUNDS):
        network = train_round(encoded, network, turn)
    shared = df.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["ids"], 1 << 20):
            lines = [_ids(value) for value in part["ids"]]
            sizes = np.array([len(ids) for ids in lines])
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pc.add(pa.array(score_lines(shared.value, lines), pa.float64()), part["shares"]),
                ],
                ["doc_id", "n_tokens", "log_probability"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    scored = encoded.mapInArrow(run, f"doc_id {kind}, n_tokens long, log_probability double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_probability") / F.col("n_tokens"))
    return scored.withColumn("mean_log_probability", mean)
