from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import language
from starloom.llm.language import (
    fit_language_model,
    gram_buckets,
    identify_language,
    predict_language,
)
from starloom.llm.queries import QUERIES
from tests.llm.brute import documents

ENGLISH = "the cat and the dog went with them to that house"
GERMAN = "der Hund und die Katze gingen mit ihnen zu diesem großen Haus"


def buckets(text):
    return [int(b) for block, _ in gram_buckets(text) for b in block]


def brute_buckets(text):
    """One n-gram at a time, without numpy."""
    codes = [ord(c) if c.isalpha() else 32 for c in text.lower()]
    found = []
    for order in range(1, language.ORDERS + 1):
        for start in range(len(codes) - order + 1):
            mixed = 0
            for code in codes[start : start + order]:
                mixed = (mixed ^ code) * 0x01000193 % 2**32
            found.append((mixed + order) * 0x9E3779B1 % 2**32 >> 16)
    return found


@pytest.mark.parametrize("block", [3, 7, 1 << 18])
@pytest.mark.parametrize("text", ["", "a", "ab", "Der Hund, 12 große!", "日本 x"])
def test_buckets(monkeypatch, block, text):
    monkeypatch.setattr(language, "BLOCK_CHARS", block)
    assert Counter(buckets(text)) == Counter(brute_buckets(text))


def rows():
    return [(i, (ENGLISH if i % 2 else GERMAN)[i % 7 :], "en" if i % 2 else "de") for i in range(60)]


def test_model_equals_brute_force(spark):
    learned = [*rows(), (90, "ignored text", None), (91, None, "de")]
    model = fit_language_model(documents(spark, learned).repartition(3))
    counts, seen = defaultdict(Counter), Counter()
    for _, text, lang in learned:
        if lang:
            counts[lang].update(brute_buckets(text or ""))
            seen[lang] += 1
    assert model.languages == ["de", "en"]
    for place, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
        expected = [math.log((counts[lang][b] + language.SMOOTHING) / total) for b in range(language.BUCKETS)]
        assert np.allclose(model.log_probabilities[:, place], expected, atol=1e-4)
        assert math.isclose(model.log_priors[place], math.log(seen[lang] / sum(seen.values())))


def test_predictions(spark):
    model = fit_language_model(documents(spark, rows()))
    asked = [(1, "the dog"), (2, "die Katze"), (3, None), (4, ""), (5, "12 !? 5"), (None, "the house " * 50_000),
             (1, "the dog")]
    df = documents(spark, asked).withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit("x"))
    found = predict_language(df, model).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in found) == Counter(
        [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en")]
    )
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_learned_and_empty(spark):
    model = fit_language_model(documents(spark, []))
    assert [r.lang_pred for r in predict_language(documents(spark, [(1, "a b")]), model).collect()] == ["und"]
    assert identify_language(documents(spark, [])).count() == 0


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        fit_language_model(documents(spark, rows()))


def test_query_on_held_out_documents(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    truth = dict(spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "lang").collect())
    found = QUERIES["op7_language"](spark, base).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
