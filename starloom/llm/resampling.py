"""Documents drawn in proportion to how much they look like a target text collection.

Features are runs of one to three words, hashed into buckets. Words come from a byte table that
lower-cases letters and blanks separators, and a split; a run's CRC-32 continues that of the run
before its last word. Tasks count buckets in Counters, which Spark adds up. A document's weight
is the sum of its features' log ratios, and a draw of its own turns weights into a sample.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    arrow_slices,
    column,
    ready_workers,
    stored,
    text_or_empty,
    word_blocks,
)
from starloom.operators import add_row_number

BUCKETS = 10_000
SEED = 42
SHARE_PERCENT = 5
LEAST_WORDS = 20


def _as_word(byte: int) -> int:
    if 0x41 <= byte <= 0x5A:
        return byte + 0x20
    return byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else 0x20


#: Digits, letters in lower case and all bytes of other characters; anything else is a space.
WORD_BYTES = bytes(map(_as_word, range(256)))


def feature_hashes(text: bytes) -> Iterator[tuple[int, list[int]]]:
    """The number of words and the CRC-32 of the features that end in them, a block at a time."""
    last_word = last_pair = None
    for words in word_blocks(text.translate(WORD_BYTES)):
        if not words:
            continue
        behind = [b" " + word for word in words]
        ones = list(map(crc32, words))
        before = ones if last_word is None else [last_word, *ones]
        twos = list(map(crc32, behind[len(behind) - len(before) + 1 :], before))
        before = twos if last_pair is None else [last_pair, *twos]
        threes = list(map(crc32, behind[len(behind) - len(before) + 1 :], before))
        last_word, last_pair = ones[-1], twos[-1] if twos else None
        yield len(words), ones + twos + threes


def _buckets(hashes: list[int], buckets: int) -> np.ndarray:
    return np.fromiter(hashes, dtype=np.int64, count=len(hashes)) % buckets


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return part["text"].cast(pa.binary()).to_pylist()


def feature_counts(df: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: the features of all texts by bucket."""
    ready_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for part in arrow_slices(batches, ["text"]):
            for text in _texts(part):
                for _, hashes in feature_hashes(text):
                    counts.update(_buckets(hashes, buckets).tolist())
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(list(counts.keys()), pa.int32()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    texts = df.select(text_or_empty(text_column).alias("text"))
    counted = texts.mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    # A row per bucket at most.
    dense = [0] * buckets
    for bucket, n in counts.collect():
        dense[bucket] = n
    return dense


def bucket_gains(source: list[int], target: list[int]) -> np.ndarray:
    """A whole number per bucket: 1000 times the smoothed log ratio of its frequencies."""
    size, of_source, of_target = len(source), sum(source), sum(target)
    return np.array(
        [
            math.floor(
                1000.0
                * math.log(
                    (float(t + 1) * float(of_source + size))
                    / (float(s + 1) * float(of_target + size))
                )
            )
            for s, t in zip(source, target)
        ],
        dtype=np.int64,
    )


def feature_weights(
    df: DataFrame,
    gains: np.ndarray,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, text_md5, n_words, n_features, weight`` of every row."""
    # Eight bytes a bucket.
    shared = df.sparkSession.sparkContext.broadcast(gains.tobytes())
    buckets = len(gains)

    def weighed(text: bytes, by_bucket: np.ndarray) -> tuple[int, int, int]:
        n_words = n_features = weight = 0
        for words, hashes in feature_hashes(text):
            n_words += words
            n_features += len(hashes)
            weight += int(by_bucket[_buckets(hashes, buckets)].sum())
        return n_words, n_features, weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.frombuffer(shared.value, dtype=np.int64)
        for part in arrow_slices(batches, ["text"]):
            made = [weighed(text, by_bucket) for text in _texts(part)]
            columns = [pa.array(list(x), pa.int64()) for x in zip(*made)] if made else []
            columns = columns or [pa.array([], pa.int64())] * 3
            kept = ["doc_id", "text_md5"]
            yield pa.RecordBatch.from_arrays(
                [*(part[name] for name in kept), *columns],
                [*kept, "n_words", "n_features", "weight"],
            )

    text = text_or_empty(text_column)
    chosen = df.select(
        column(id_column).alias("doc_id"), F.md5(text).alias("text_md5"), text.alias("text")
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    counts = "n_words long, n_features long, weight long"
    return chosen.mapInArrow(run, f"doc_id {kind}, text_md5 string, {counts}")


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text_column: str = "text",
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, text_md5, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    Both tables are counted whole. ``weight`` sums ``floor(1000 ln(..))`` of the smoothed ratio of
    the target's and the documents' frequency of each feature's bucket, and ``score`` adds a
    Gumbel draw that a hash of seed and id makes, so the highest scores are a sample without
    replacement in proportion to the weights' exponentials. Of the N rows of at least
    ``least_words`` words, ``share_percent * N // 100`` are drawn; ``rank`` counts them from 1 by
    falling score, ties by smaller id, and is null for all others.

    A null text has no words, and its weight is 0. A null id draws as an empty text would and
    comes first among ties; rows repeated with their id are scored one by one, those that tie in
    both ranked one after the other. Long texts are read in blocks. Without documents the result
    is empty, without a target all of its counts are 0. Other columns are not looked at.
    """
    spark = docs.sparkSession
    gains = bucket_gains(
        _dense(feature_counts(docs, text_column, buckets), buckets),
        _dense(feature_counts(target, target_text_column, buckets), buckets),
    )
    ready_workers(spark)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = F.substring(F.sha2(name.cast("binary"), 256), 1, 8)
    chance = (F.conv(first, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    draw = F.floor(F.lit(-1000.0) * F.log(-F.log(chance)))
    scored = stored(
        feature_weights(docs, gains, id_column, text_column).withColumn(
            "score", F.col("weight") + draw
        ),
        "scored",
    )
    long_enough = F.col("n_words") >= least_words
    rows = scored.where(long_enough)
    drawn = share_percent * rows.count() // 100
    ranked = add_row_number(rows, "rank", [-F.col("score"), F.col("doc_id")])
    columns = [*scored.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")]
    others = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    **settings,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, as :func:`importance_ranks` decides.

    A row is known by its id, which may be null, and its text; of rows repeated with both, all
    stay if one is drawn.
    """
    ranks = importance_ranks(docs, target, id_column, text_column, **settings)
    name = "drawn"
    while name in docs.columns:
        name += "_"
    drawn = ranks.where("rank is not null").select(F.struct("doc_id", "text_md5").alias(name))
    same = column(id_column).eqNullSafe(F.col(name)["doc_id"]) & (
        F.md5(text_or_empty(text_column)) == F.col(name)["text_md5"]
    )
    return docs.join(drawn.distinct(), same, "left_semi")
