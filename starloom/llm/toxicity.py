"""Toxicity by non-negative positive-unlabelled learning.

Only toxic examples are confirmed; all other texts are unlabelled and may hold toxic ones. The
risk of a classifier is estimated from both, corrected by the share of toxic texts (the class
prior), and its part for clean texts is kept from falling below zero.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    add_vectors,
    arrow_slices,
    held_out,
    ready_workers,
    stored,
    text_blocks,
    text_or_empty,
)

BUCKETS = 1 << 18
#: The bound of the sample of labelled texts that the classifier is fitted on.
MOST_POSITIVE = 3000
#: Words kept: those that set confirmed texts most apart, by so many standard errors at least.
FEATURES = 256
LEAST_APART = 4.0
STEMS = (4, 6)
LEAST_TEXTS = 5
STEPS = 801
#: The tasks' weights are averaged so many times.
ROUNDS = 3
#: Unlabelled rows that a step takes.
CHUNK = 1 << 14
RATE = 0.1
DECAY = 1e-5
SEEN_AT = 0.5

_MARKS = ".,;:!?\"'()[]{}<>*#$%&|-_"


def word_buckets(text: str) -> np.ndarray:
    """The buckets of the different words of a text and of how they begin.

    Words are in lower case and without marks. Beginnings have ``STEMS`` characters.
    """
    words: set[str] = set()
    for block in text_blocks(text):
        for part in block:
            words.update(part.split())
    words = {word.lower().strip(_MARKS) for word in words}
    for size in STEMS:
        words |= {f"{word[:size]}-" for word in words if len(word) > size and word[-1] != "-"}
    hashes = array("I", [xxhash.xxh32_intdigest(word) for word in words])
    return np.unique(np.frombuffer(hashes, np.uint32) & np.uint32(BUCKETS - 1)).astype(np.int32)


@dataclass
class ToxicityModel:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self._weight_of = np.zeros(BUCKETS, dtype=np.float32)
        self._weight_of[self.buckets] = self.weights

    def score(self, text: str) -> float:
        total = float(self._weight_of[word_buckets(text)].sum()) + self.bias
        return 1 / (1 + float(np.exp(-np.clip(total, -60, 60))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_non_negative(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    counts: np.ndarray | None = None,
    start: np.ndarray | None = None,
    steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier that minimises the non-negative risk.

    The loss of margin z is sigmoid(-z). The risk is ``prior * loss(positive as toxic)`` plus
    ``loss(unlabelled as clean) - prior * loss(positive as clean)``. While the latter part is
    below zero, which only happens by overfitting, a step goes up its slope instead.

    ``counts`` tells how often each unlabelled row occurs, ``start`` the weights and the bias to
    begin with. Steps take ``CHUNK`` unlabelled rows in turn, and are as many as it takes to use
    each at least once.
    """
    size = positive.shape[1]
    weights, bias = np.zeros(size), np.log(prior / (1 - prior))
    if start is not None:
        weights, bias = start[:-1].copy(), start[-1]
    counts = np.ones(len(unlabelled)) if counts is None else counts.astype(np.float64)
    moments = np.zeros((2, size + 1))

    def slope(rows: np.ndarray, sign: float, times: np.ndarray) -> tuple[float, np.ndarray]:
        """The mean of sigmoid(sign * margin) and its gradient."""
        value = _sigmoid(sign * (rows @ weights.astype(np.float32) + bias))
        each = sign * value * (1 - value) * times / times.sum()
        mean = float((value * times).sum() / times.sum())
        return mean, np.append(each.astype(np.float32) @ rows, each.sum())

    parts = -(-len(unlabelled) // CHUNK)
    once = np.ones(len(positive))
    for step in range(1, max(steps, parts) + 1):
        here = slice(step % parts * CHUNK, (step % parts + 1) * CHUNK)
        _, as_toxic = slope(positive, -1, once)
        clean_loss, as_clean = slope(positive, 1, once)
        other_loss, other = slope(_unpacked(unlabelled[here], size), 1, counts[here])
        if other_loss - prior * clean_loss >= 0:
            gradient = prior * as_toxic + other - prior * as_clean
        else:
            gradient = prior * as_clean - other
        gradient[:-1] += DECAY * weights
        moments[0] += 0.1 * (gradient - moments[0])
        moments[1] += 0.01 * (gradient**2 - moments[1])
        first, second = moments[0] / (1 - 0.9**step), moments[1] / (1 - 0.99**step)
        move = RATE * first / (np.sqrt(second) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def _unpacked(rows: np.ndarray, size: int) -> np.ndarray:
    """Rows of bits as numbers; rows of numbers as they are."""
    if rows.dtype != np.uint8:
        return rows
    return np.unpackbits(rows, axis=1, count=size, bitorder="little").astype(np.float32)


def chosen_words(
    seen: np.ndarray, positive: int, others: np.ndarray, unlabelled: int
) -> np.ndarray:
    """Buckets by how many standard errors their shares of texts differ.

    ``seen`` and ``others`` count the confirmed and the unlabelled texts that have each.
    """
    share = (seen + others) / (positive + unlabelled)
    error = np.sqrt(share * (1 - share) * (1 / positive + 1 / unlabelled))
    apart = np.abs(seen / positive - others / unlabelled) / np.maximum(error, 1e-9)
    apart[seen + others < LEAST_TEXTS] = 0
    best = np.argsort(-apart, kind="stable")[:FEATURES]
    return np.sort(best[apart[best] >= LEAST_APART])


def _count_words(docs: DataFrame, confirmed: DataFrame) -> dict[bool, np.ndarray]:
    """How many confirmed texts, and how many of all, have each bucket; the last is their number."""
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    marks = confirmed.withColumn("confirmed", F.lit(True))
    # At most MOST_POSITIVE rows of two short columns.
    rows = rows.join(F.broadcast(marks), "doc_id", "left").select("confirmed", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for part in arrow_slices(batches, ["text"], 4 << 20):
            for kind, text in zip(part["confirmed"].to_pylist(), part["text"]):
                found = word_buckets(text.as_py())
                for total in totals if kind else totals[:1]:
                    total[found] += 1
                    total[-1] += 1
        for kind, total in zip((False, True), totals):
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), kind)),
                    pa.array(found.astype(np.int32)),
                    pa.array(total[found]),
                ],
                ["confirmed", "bucket", "n"],
            )

    counted = rows.mapInArrow(run, "confirmed boolean, bucket int, n long")
    # A row per bucket and kind, however many and however long the texts are.
    added = counted.groupBy("confirmed", "bucket").agg(F.sum("n").alias("n")).toArrow()
    kinds, buckets, n = (added[name].to_numpy() for name in ("confirmed", "bucket", "n"))
    totals = {kind: np.zeros(BUCKETS + 1, dtype=np.int64) for kind in (False, True)}
    for kind, total in totals.items():
        total[buckets[kinds == kind]] = n[kinds == kind]
    return totals


def word_patterns(df: DataFrame, chosen: np.ndarray) -> DataFrame:
    """``doc_id, pattern`` of every row: which chosen buckets its text has, as bits."""
    ready_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1)
        place[shared.value] = np.arange(len(shared.value))
        for part in arrow_slices(batches, ["text"], 4 << 20):
            bits = np.zeros((part.num_rows, len(shared.value)), dtype=bool)
            for row, text in zip(bits, part["text"]):
                found = place[word_buckets(text.as_py())]
                row[found[found >= 0]] = True
            packed = [x.tobytes() for x in np.packbits(bits, axis=1, bitorder="little")]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(packed, pa.binary())], ["doc_id", "pattern"]
            )

    rows = df.select("doc_id", text_or_empty("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, pattern binary")


def _bits(patterns, size: int) -> np.ndarray:
    """Rows of packed bits."""
    width = -(-size // 8)
    return np.frombuffer(b"".join(patterns), dtype=np.uint8).reshape(-1, width)


def fit_patterns(
    patterns: DataFrame, confirmed: DataFrame, chosen: np.ndarray, prior: float
) -> ToxicityModel:
    """Weights from the patterns of all unlabelled texts and of the confirmed ones among them.

    In each of ``ROUNDS`` rounds every task minimises the risk over the confirmed texts and its
    own unlabelled ones, all of them, and the tasks' weights are averaged by their texts.
    """
    size = len(chosen)
    known = patterns.join(confirmed, "doc_id", "left_semi").limit(MOST_POSITIVE)
    held = [bytes(row.pattern) for row in known.select("pattern").collect()]
    if not held or not size:
        bias = np.log(prior / (1 - prior)) if held else -60.0
        return ToxicityModel(chosen, np.zeros(size), bias)
    now = None
    for _ in range(ROUNDS):
        shared = patterns.sparkSession.sparkContext.broadcast((held, now))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter[bytes] = Counter()
            for part in batches:
                counts.update(part["pattern"].to_pylist())
            if not counts:
                return
            positive = _unpacked(_bits(shared.value[0], size), size)
            times = np.array(list(counts.values()))
            weights, bias = fit_non_negative(
                positive, _bits(counts, size), prior, times, shared.value[1], STEPS // ROUNDS
            )
            vector = np.concatenate([weights, [bias, 1.0]]) * times.sum()
            yield pa.RecordBatch.from_pydict({"part": pa.array([0]), "vector": [vector.tobytes()]})

        learned = patterns.select("pattern").mapInArrow(run, "part long, vector binary")
        # As many numbers as there are weights.
        total = np.frombuffer(add_vectors(learned, ["part"], "float64").first().vector)
        now = total[:-1] / total[-1]
    return ToxicityModel(chosen, now[:-1], float(now[-1]))


def _choose(
    docs: DataFrame, labels: DataFrame, prior: float | None
) -> tuple[DataFrame, np.ndarray, float]:
    """The ids of confirmed texts, the buckets to look at, and the prior."""
    ready_workers(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull())
    marked = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = marked.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    prior = min(max(prior, 0.001), 0.999)
    toxic = marked.where("toxic = 1").select("doc_id")
    ids = docs.select("doc_id").join(toxic, "doc_id", "left_semi").distinct()
    confirmed = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_POSITIVE)
    confirmed = stored(confirmed, "confirmed")
    counts = _count_words(docs, confirmed)
    positive, unlabelled = int(counts[True][-1]), int(counts[False][-1])
    if not positive:
        return confirmed, np.zeros(0, dtype=np.int64), prior
    chosen = chosen_words(counts[True][:-1], positive, counts[False][:-1], unlabelled)
    return confirmed, chosen, prior


def fit_toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> ToxicityModel:
    """Fit on at most ``MOST_POSITIVE`` confirmed texts, those of the smallest hashes of ids, and
    on all texts as unlabelled ones: so these hold toxic ones in the prior's share.

    ``prior`` is the share of toxic texts; by default that among labelled rows. Without confirmed
    texts nothing is learned and every text scores 0.
    """
    confirmed, chosen, prior = _choose(docs, labels, prior)
    return fit_patterns(stored(word_patterns(docs, chosen), "patterns"), confirmed, chosen, prior)


def score_toxicity(df: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` of every row, over its whole text.

    A null text is an empty one and has the score of a text without known words. Null ids and
    repeated rows are rows like any other; other columns are not looked at.
    """
    ready_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    chosen = df.select("doc_id", text_or_empty("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["text"], 4 << 20):
            scores = [shared.value.score(text.as_py()) for text in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    scored = chosen.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= SEEN_AT).cast("int"))


def classify_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learned from rows outside the fold.

    Texts are looked at twice: outside the fold to count words, and all of them for the words
    that were chosen, from which the weights are learned and all texts are scored.
    """
    learned, known = docs.where(~held_out("doc_id")), labels.where(~held_out("doc_id"))
    confirmed, chosen, prior = _choose(learned, known.select("doc_id", "toxic"), None)
    patterns = stored(word_patterns(docs, chosen), "patterns")
    model = fit_patterns(patterns.where(~held_out("doc_id")), confirmed, chosen, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            size = len(model.weights)
            margins = np.full(part.num_rows, model.bias)
            if size and part.num_rows:
                rows = _unpacked(_bits(part["pattern"].to_pylist(), size), size)
                margins += rows @ model.weights.astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(_sigmoid(margins))], ["doc_id", "score"]
            )

    kind = patterns.schema["doc_id"].dataType.simpleString()
    scored = patterns.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= SEEN_AT).cast("int").alias("predicted"),
    )
