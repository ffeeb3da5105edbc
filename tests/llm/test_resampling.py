"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from starloom.llm import resampling
from starloom.llm.queries import QUERIES
from starloom.llm.resampling import feature_hashes, importance_ranks, resample
from tests.llm.brute import documents, lower_ascii

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def features(text):
    found = words(text)
    return [" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]


def buckets(texts, size):
    counts = Counter()
    for text in texts:
        counts.update(zlib.crc32(x.encode()) % size for x in features(text))
    return counts


def expected(rows, target, size=10_000, share=5, least=20):
    s, t = buckets([text for _, text in rows], size), buckets(target, size)
    all_s, all_t = s.total(), t.total()

    def gain(bucket):
        ratio = (t[bucket] + 1) * (all_s + size) / ((s[bucket] + 1) * (all_t + size))
        return math.floor(1000 * math.log(ratio))

    found, drawn = [], []
    for doc_id, text in rows:
        weight = sum(gain(zlib.crc32(x.encode()) % size) for x in features(text))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(features(text)), weight, score, None])
        if len(words(text)) >= least:
            drawn.append(found[-1])
    drawn.sort(key=lambda row: (-row[3], row[0] is not None, row[0]))
    for rank, row in enumerate(drawn[: share * len(drawn) // 100], 1):
        row[4] = rank
    return sorted(map(str, map(tuple, found)))


def check(spark, rows, target, **settings):
    items = spark.createDataFrame([(text,) for text in target], "text string")
    found = importance_ranks(documents(spark, rows), items, **settings).drop("n_words", "text_md5").collect()
    assert sorted(str(tuple(row)) for row in found) == expected(
        rows, target, settings.get("buckets", 10_000), settings.get("share_percent", 5)
    )


def test_equals_plain_version(spark):
    draw = random.Random(3)
    pool = ["Été", "naïve", "x1", "42", "A", "b", "日本", "don't", "a_b", "q\x7fz", "\x00", "ZZ"]
    rows = [
        (i, draw.choice(" \n\t,.").join(draw.choice(pool) for _ in range(draw.randrange(60))))
        for i in range(200)
    ]
    rows += [(500, None), (501, ""), (502, "..."), (503, "one"), (504, "one two"), (None, "a b " * 20)]
    check(spark, rows, ["Été naïve x1 42", None, "A b A b"])
    check(spark, rows, ["Été naïve x1 42"], buckets=7, share_percent=50)


def test_ties_and_repeated_rows(spark):
    rows = [(7, "a b c d " * 6)] * 8 + [(3, "a b c d " * 6)] * 8
    check(spark, rows, ["a"], share_percent=60)


def test_features_over_block_edges(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)).encode()
    whole = sorted(x for _, hashes in feature_hashes(text) for x in hashes)
    assert whole == sorted(zlib.crc32(x.encode()) for x in features(text.decode()))
    for size in (1, 7, 100):
        monkeypatch.setattr("starloom.llm.common.BLOCK_BYTES", size)
        blocks = list(feature_hashes(text))
        assert len(blocks) > 1
        assert sorted(x for _, hashes in blocks for x in hashes) == whole
        assert sum(n for n, _ in blocks) == 3000


def test_empty_tables(spark):
    none = documents(spark, [])
    assert importance_ranks(none, none).collect() == []
    check(spark, [(1, "a b c"), (2, "d " * 30)], [])


def test_very_long_text(spark):
    check(spark, [(1, "wort zwei " * 300_000), (2, "x" * 3_000_000), (3, "a " * 25)], ["wort zwei"])


def test_clashing_columns_and_drawn_rows(spark):
    rows = [(i, f"common words here {i} " * 9) for i in range(40)] + [(None, "a b " * 15)]
    df = documents(spark, rows)
    for name in ("rank", "score", "bucket", "n", "drawn", "weight", "n_words"):
        df = df.withColumn(name, F.lit("x"))
    target = documents(spark, [(1, "common words here 3")])
    ranks = importance_ranks(df, target)
    assert ranks.columns == [
        "doc_id", "text_md5", "n_words", "n_features", "weight", "score", "rank",
    ]
    drawn = {row.doc_id for row in ranks.where("rank is not null").collect()}
    left = resample(df, target)
    assert left.columns == df.columns and {row.doc_id for row in left.collect()} == drawn
    assert len(drawn) == 5 * 41 // 100


def test_word_bytes():
    assert len(resampling.WORD_BYTES) == 256
    every = bytes(range(128)).decode()
    assert every.encode().translate(resampling.WORD_BYTES).decode().split() == WORD.findall(
        lower_ascii(every)
    )


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = QUERIES["op11_resampling"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    assert sorted(str(tuple(row)) for row in found.collect()) == expected(rows, target)
