"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    add_vectors,
    arrow_slices,
    column,
    held_out,
    ready_workers,
    text_or_empty,
)

ORDERS = 3
BUCKETS = 1 << 16
#: Counts are added up in so many slices.
SLICES = 32
SMOOTHING = 0.5
#: The matrix has a row per language; more languages than this are refused, not broadcast.
MOST_LANGUAGES = 256
BLOCK_CHARS = 1 << 18
UNKNOWN = "und"

_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def gram_buckets(text: str) -> Iterator[tuple[np.ndarray, bool]]:
    """Buckets of all n-grams of a text, a block at a time, and whether the block has a letter.

    Characters that are no letters count as spaces, letters in lower case.
    """
    for start in range(0, len(text), BLOCK_CHARS):
        # Each n-gram belongs to the block that its first character is in.
        block = text[start : start + BLOCK_CHARS + ORDERS - 1].lower()
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = _letters()[codes]
        codes = np.where(letters, codes, np.uint32(32))
        over = max(0, len(text) - start - BLOCK_CHARS)
        buckets, mixed = [], np.zeros(len(codes), dtype=np.uint32)
        for order in range(1, ORDERS + 1):
            mixed = (mixed[: len(codes) - order + 1] ^ codes[order - 1 :]) * _STEP
            first = len(mixed) - max(0, min(over, ORDERS - 1) - order + 1)
            buckets.append((mixed[:first] + np.uint32(order)) * _SPREAD >> np.uint32(16))
        yield np.concatenate(buckets), bool(letters.any())


@dataclass
class LanguageModel:
    languages: list[str]
    #: Row per bucket, column per language.
    log_probabilities: np.ndarray
    log_priors: np.ndarray

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its posterior probability."""
        total, lettered = self.log_priors.copy(), False
        for buckets, letters in gram_buckets(text):
            total += self.log_probabilities[buckets].sum(axis=0, dtype=np.float64)
            lettered |= letters
        if not lettered or not self.languages:
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit_language_model(
    df: DataFrame, text_column: str = "text", language_column: str = "lang"
) -> LanguageModel:
    """Count the n-grams of all rows whose language is not null."""
    ready_workers(df.sparkSession)
    rows = df.where(column(language_column).isNotNull()).select(
        column(language_column).cast("string").alias("lang"),
        text_or_empty(text_column).alias("text"),
    )
    counted = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1)
    documents = {row.lang: row.n for row in counted.collect()}
    if len(documents) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    width = BUCKETS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in arrow_slices(batches, ["text"], 4 << 20):
            for lang, text in zip(part["lang"].to_pylist(), part["text"]):
                if lang not in totals:
                    totals[lang] = np.zeros(BUCKETS, dtype=np.int64)
                for buckets, _ in gram_buckets(text.as_py()):
                    totals[lang] += np.bincount(buckets, minlength=BUCKETS)
        for lang, total in totals.items():
            vectors = [total[i * width : (i + 1) * width].tobytes() for i in range(SLICES)]
            places = pa.array(range(SLICES), pa.int32())
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * SLICES, "slice": places, "vector": vectors}
            )

    vectors = rows.mapInArrow(count, "lang string, slice int, vector binary")
    # At most MOST_LANGUAGES * BUCKETS counts, whatever the corpus.
    slices = add_vectors(vectors, ["lang", "slice"], "int64").collect()
    languages = sorted(documents)
    counts = np.zeros((BUCKETS, len(languages)))
    for row in slices:
        place = slice(row.slice * width, (row.slice + 1) * width)
        counts[place, languages.index(row.lang)] = np.frombuffer(row.vector, dtype=np.int64)
    smooth = counts + SMOOTHING
    seen = sum(documents.values())
    return LanguageModel(
        languages,
        np.log(smooth / smooth.sum(axis=0)).astype(np.float32),
        np.array([math.log(documents[x] / seen) for x in languages]),
    )


def _shared(spark: SparkSession, model: LanguageModel) -> Broadcast:
    """At most ``MOST_LANGUAGES * BUCKETS`` 32-bit numbers."""
    return spark.sparkContext.broadcast(model)


def predict_language(
    df: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; ``score`` is the posterior probability.

    A null text, one without a letter, and any text if nothing was learned are ``und`` with
    score 0. Ties go to the language that sorts first. Null ids and repeated rows are rows like
    any other; other columns are not looked at.
    """
    ready_workers(df.sparkSession)
    shared = _shared(df.sparkSession, model)
    chosen = df.select(column(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["text"], 4 << 20):
            found = [shared.value.predict(text.as_py()) for text in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify_language(df: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the documents outside the fold."""
    model = fit_language_model(df.where(~held_out("doc_id")))
    return predict_language(df, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )
