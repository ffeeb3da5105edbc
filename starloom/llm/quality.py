"""Quality by a sparse ensemble of rules over statistics of a text.

Shallow boosted trees propose rules: each path from a root is a conjunction of thresholds. A
lasso logistic regression keeps few of them, and these are compiled into one Spark column, so
that documents are scored without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    column,
    held_out,
    row_key,
    stored,
    text_or_empty,
    without_rows,
)

#: The bound of the labelled sample that the rules are fitted on: the smallest hashes of ids.
MOST_LABELLED = 20_000
TREES = 40
DEPTH = 3
LEAST_ROWS = 20
BINS = 32
LEARNING_RATE = 0.2
#: Weight of the lasso penalty, per labelled row.
PENALTY = 0.002
ROUNDS = 500
ACCEPTED_AT = 0.3

STATISTICS = (
    "chars", "words", "word_length", "letters", "capitals", "digits", "spaces", "marks",
    "symbols", "bangs", "bars", "distinct_words", "distinct_lines", "line_words", "short_words",
)


def with_statistics(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``STATISTICS`` (doubles) of every row, over its whole text.

    Shares are of the text's characters, words or lines. All are zero for a null or empty text.
    """
    chars = F.char_length("text")

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")

    def without(pattern: str) -> Column:
        """The share of characters that a pattern matches."""
        return share(chars - F.char_length(F.regexp_replace("text", pattern, "")), chars)

    def count(character: str) -> Column:
        return share(chars - F.char_length(F.replace("text", F.lit(character), F.lit(""))), chars)

    chosen = df.select(
        column(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).select(
        "doc_id",
        "text",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "").alias("each"),
        F.filter(F.split("text", "\n"), lambda line: line != "").alias("lines"),
    )
    words, lines = F.size("each"), F.size("lines")
    letters = without(r"\p{L}+")
    spaces = without(r"\s+")
    marks = without("[.,;:?]+")
    digits = without(r"\p{Nd}+")
    values = {
        "chars": F.log1p(chars),
        "words": F.log1p(words),
        "word_length": share(chars, words),
        "letters": letters,
        "capitals": without(r"\p{Lu}+"),
        "digits": digits,
        "spaces": spaces,
        "marks": marks,
        "symbols": F.lit(1.0) - letters - spaces - marks - digits,
        "bangs": count("!"),
        "bars": count("|"),
        "distinct_words": share(F.size(F.array_distinct("each")), words),
        "distinct_lines": share(F.size(F.array_distinct("lines")), lines),
        "line_words": F.log1p(share(words, lines)),
        "short_words": share(F.size(F.filter("each", lambda word: F.char_length(word) < 3)), words),
    }
    empty = chars == 0
    return chosen.select(
        "doc_id",
        *(F.when(empty, 0.0).otherwise(values[name]).alias(name) for name in STATISTICS),
    )


#: (statistic, whether above the threshold, threshold)
Condition = tuple[int, bool, float]


@dataclass
class QualityModel:
    rules: list[tuple[tuple[Condition, ...], float]]
    bias: float

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        total = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for place, above, threshold in conditions:
                value = F.col(STATISTICS[place])
                holds = holds & (value > threshold if above else value <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(values: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    held = np.ones(len(values), dtype=bool)
    for place, above, threshold in conditions:
        held &= (values[:, place] > threshold) == above
    return held


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class _Trees:
    """Boosted regression trees on binned statistics; paths are collected as rules."""

    def __init__(self, values: np.ndarray, labels: np.ndarray) -> None:
        self.edges = [
            np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in values.T
        ]
        self.binned = np.stack(
            [np.searchsorted(edges, column) for edges, column in zip(self.edges, values.T)], axis=1
        )
        self.rules: dict[tuple[Condition, ...], None] = {}
        share = np.clip(labels.mean(), 0.01, 0.99)
        margin = np.full(len(labels), np.log(share / (1 - share)))
        for _ in range(TREES):
            chance = _sigmoid(margin)
            self._slope, self._curve = labels - chance, chance * (1 - chance) + 1e-6
            self._step = np.zeros(len(labels))
            self._grow(np.arange(len(labels)), ())
            margin += LEARNING_RATE * self._step

    def _grow(self, rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            self.rules[tuple(sorted(path))] = None
        slope, curve = self._slope[rows], self._curve[rows]
        self._step[rows] = np.clip(slope.sum() / (curve.sum() + 1.0), -4, 4)
        if len(path) == DEPTH or len(rows) < 2 * LEAST_ROWS:
            return
        best, split = 1e-3, None
        before = slope.sum() ** 2 / (curve.sum() + 1.0)
        for place, edges in enumerate(self.edges):
            bins, size = self.binned[rows, place], len(edges) + 1
            slopes = np.cumsum(np.bincount(bins, slope, size))[:-1]
            curves = np.cumsum(np.bincount(bins, curve, size))[:-1]
            counts = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            gain = slopes**2 / (curves + 1.0) - before
            gain += (slope.sum() - slopes) ** 2 / (curve.sum() - curves + 1.0)
            gain[(counts < LEAST_ROWS) | (len(rows) - counts < LEAST_ROWS)] = 0
            if len(gain) and gain.max() > best:
                best, split = gain.max(), (place, int(gain.argmax()))
        if split:
            place, last = split
            threshold = float(self.edges[place][last])
            above = self.binned[rows, place] > last
            self._grow(rows[~above], (*path, (place, False, threshold)))
            self._grow(rows[above], (*path, (place, True, threshold)))


def _lasso(held: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for the penalised logistic loss; the bias is free."""
    rows = np.column_stack([held, np.ones(len(held))])
    share = held.mean(axis=0)
    scale = np.append(np.maximum(np.sqrt(share * (1 - share)), 0.05), 1.0)
    rows = rows / scale
    step = 4 * len(rows) / max(np.linalg.norm(rows, 2) ** 2, 1e-9)
    weights = ahead = np.zeros(rows.shape[1])
    pace = 1.0
    for _ in range(ROUNDS):
        slope = (_sigmoid(rows @ ahead) - labels) @ rows / len(rows)
        moved = ahead - step * slope
        shrunk = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        shrunk[-1] = moved[-1]
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = shrunk + (pace - 1) / faster * (shrunk - weights)
        weights, pace = shrunk, faster
    weights = weights / scale
    return weights[:-1], float(weights[-1])


def fit_rules(values: np.ndarray, labels: np.ndarray) -> QualityModel:
    """The model of labelled statistics; of one class or no rows, a constant."""
    labels = labels.astype(np.float64)
    if not len(labels):
        return QualityModel([], 0.0)
    if labels.min() == labels.max():
        return QualityModel([], 4.0 if labels[0] else -4.0)
    rules = list(_Trees(values, labels).rules)
    if not rules:
        return QualityModel([], float(np.log(labels.mean() / (1 - labels.mean()))))
    held = np.stack([_holds(values, rule) for rule in rules], axis=1)
    weights, bias = _lasso(held, labels)
    kept = [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6]
    return QualityModel(kept, bias)


def fit_quality(statistics: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on at most ``MOST_LABELLED`` rows; a document labelled twice counts as its lower one."""
    marked = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("_label")
    )
    sample = (
        statistics.join(marked, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MOST_LABELLED)
        .select(*STATISTICS, "_label")
        .toArrow()
    )
    rows = np.column_stack([sample[name].to_numpy() for name in (*STATISTICS, "_label")])
    return fit_rules(rows[:, :-1], rows[:, -1])


def _fitted(docs: DataFrame, labels: DataFrame, key: Column) -> tuple[QualityModel, DataFrame]:
    """The model, and ``key, doc_id`` and the statistics of every row."""
    keyed = docs.select(key.alias("key"), text_or_empty("text").alias("text"))
    found = with_statistics(keyed, "key").withColumnRenamed("doc_id", "key")
    statistics = stored(found.withColumn("doc_id", F.col("key.doc_id")), "statistics")
    learned = ~held_out("doc_id")
    return fit_quality(
        statistics.where(learned), labels.where(learned).select("doc_id", "quality")
    ), statistics


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Learned from labelled rows outside the fold. A null or empty text has zero statistics and
    is scored as such. Null ids belong to the fold, so nothing is learned from them; repeated
    rows are rows like any other. Without labels all scores are 0.5. Other columns of ``docs``
    are not looked at.
    """
    model, statistics = _fitted(docs, labels, F.struct("doc_id"))
    score = model.column()
    return statistics.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        score.alias("score"),
        (score >= ACCEPTED_AT).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected.

    A row is known by its id, which may be null, and its text, and decided by its own score, as
    :func:`score_quality` gives it; rows repeated with both share the decision. A null or empty
    text has zero statistics. Long texts are scored whole. An empty table stays empty, and
    without labels no row is rejected. Columns may have any names.
    """
    model, statistics = _fitted(docs, labels, row_key("doc_id", "text"))
    rejected = statistics.where(model.column() < ACCEPTED_AT).select("key")
    return without_rows(docs, rejected)
