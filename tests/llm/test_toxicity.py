from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import toxicity
from starloom.llm.queries import QUERIES
from starloom.llm.toxicity import (
    classify_toxicity,
    fit_non_negative,
    fit_toxicity,
    score_toxicity,
    word_buckets,
)
from tests.llm.brute import documents

LABELS = "doc_id bigint, quality int, toxic int"


def made(count=600):
    draw = random.Random(9)
    texts, labels = [], []
    for number in range(count):
        words = [f"w{draw.randrange(300)}" for _ in range(30)]
        toxic = number % 6 == 0
        if toxic:
            words[draw.randrange(30)] = draw.choice(["Nasty,", "vile", "rotten."])
        texts.append((number, " ".join(words)))
        if number % 5 < 3:
            labels.append((number, 1, int(toxic)))
    return texts, labels


def test_words_and_beginnings():
    assert set(word_buckets("Nasty, nasty NASTY!")) == set(word_buckets("nasty"))
    assert len(word_buckets("nastiness")) == 1 + len(toxicity.STEMS)
    assert set(word_buckets("nastiness")) & set(word_buckets("nastily"))
    assert len(word_buckets("")) <= 1
    long = " ".join(f"word{i}" for i in range(300_000))
    assert len(word_buckets(long)) > 100_000


def test_unlabelled_toxic_texts_are_told_apart():
    """Positives are only a part of what is toxic among the unlabelled rows."""
    draw = np.random.default_rng(1)
    toxic = np.column_stack([np.ones(300), draw.random((300, 3)) < 0.3]).astype(np.float32)
    clean = np.column_stack([np.zeros(1500), draw.random((1500, 3)) < 0.3]).astype(np.float32)
    weights, bias = fit_non_negative(toxic[:100], np.concatenate([toxic[100:], clean]), 0.12)
    assert (toxic @ weights + bias > 0).all() and (clean @ weights + bias < 0).all()


def test_risk_stays_non_negative():
    """With as few rows as columns a plain estimate would overfit without bound."""
    draw = np.random.default_rng(2)
    rows = (draw.random((60, 80)) < 0.2).astype(np.float32)
    weights, bias = fit_non_negative(rows[:20], rows[20:], 0.5)
    assert np.isfinite(weights).all() and np.isfinite(bias)


def plain_risk(weights, bias, positive, unlabelled, prior):
    def loss(rows, sign):
        return np.mean([1 / (1 + np.exp(sign * (row @ weights + bias))) for row in rows])

    rest = loss(unlabelled, -1) - prior * loss(positive, -1)
    return prior * loss(positive, 1) + max(rest, 0.0)


def test_steps_lower_the_plain_risk(monkeypatch):
    draw = np.random.default_rng(3)
    positive = (draw.random((80, 12)) < np.linspace(0.8, 0.1, 12)).astype(np.float32)
    unlabelled = (draw.random((900, 12)) < 0.2).astype(np.float32)
    found = [fit_non_negative(positive, unlabelled, 0.1, steps=n) for n in (1, 30, 800)]
    risks = [plain_risk(w, b, positive, unlabelled, 0.1) for w, b in found]
    assert risks[2] < risks[1] < risks[0] + 1e-9
    # Rows that are packed, and counted instead of repeated, have the same risk.
    rows, counts = np.unique(unlabelled, axis=0, return_counts=True)
    packed = np.packbits(rows.astype(bool), axis=1, bitorder="little")
    again = fit_non_negative(positive, packed, 0.1, counts, steps=800)
    assert np.allclose(again[0], found[2][0], atol=0.05) and abs(again[1] - found[2][1]) < 0.05
    # Chunks take turns, and every one has its turn.
    monkeypatch.setattr(toxicity, "CHUNK", 100)
    weights, bias = fit_non_negative(positive, unlabelled, 0.1, steps=800)
    assert plain_risk(weights, bias, positive, unlabelled, 0.1) < risks[1] + 0.01


def test_words_are_counted_over_all_texts(spark):
    """A toxic word that few of very many texts have is chosen, and long texts cost no more."""
    rows = [(i, f"common words of text {i % 50} " + ("slurword" if i % 500 == 0 else "")) for i in range(20_000)]
    labels = [(i, 1, int(i % 500 == 0)) for i in range(0, 20_000, 50)]
    df = documents(spark, rows).repartition(5)
    model = fit_toxicity(df, spark.createDataFrame(labels, LABELS))
    assert set(word_buckets("slurword")) <= set(model.buckets.tolist())
    assert model.score("a slurword") > 0.5 > model.score("common words")
    confirmed = spark.createDataFrame([(0,)], "doc_id bigint")
    counts = toxicity._count_words(df, confirmed)
    plain = np.zeros(toxicity.BUCKETS, dtype=int)
    for _, text in rows:
        plain[word_buckets(text)] += 1
    assert (counts[False][:-1] == plain).all() and counts[False][-1] == len(rows)
    assert counts[True][-1] == 1 and set(np.flatnonzero(counts[True][:-1])) == set(word_buckets(rows[0][1]))
    long = documents(spark, [(i, " ".join(f"w{i}x{j}" for j in range(300_000))) for i in range(2)])
    held = toxicity._count_words(long, confirmed)
    assert sum(x.nbytes for x in held.values()) <= 16 * (toxicity.BUCKETS + 1)


def test_patterns_score_as_texts_do(spark):
    texts, labels = made(300)
    df, marks = documents(spark, texts), spark.createDataFrame(labels, LABELS)
    fold = df.where(~toxicity.held_out("doc_id"))
    known = marks.where(~toxicity.held_out("doc_id"))
    by_text = score_toxicity(df, fit_toxicity(fold, known)).collect()
    by_pattern = {r.doc_id: r for r in classify_toxicity(df, marks).collect()}
    agree = [by_pattern[r.doc_id].predicted == r.predicted for r in by_text]
    assert sum(agree) >= 0.99 * len(agree)


def test_classifier_on_held_out_rows(spark):
    texts, labels = made()
    df = documents(spark, texts).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(7))
    found = classify_toxicity(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found)


def test_nulls_repeats_and_empty_tables(spark):
    texts, labels = made(200)
    labels += [labels[0], (None, 1, 1), (5, 1, None), (9999, 1, 1)]
    model = fit_toxicity(documents(spark, texts), spark.createDataFrame(labels, LABELS))
    asked = [(1, None), (2, ""), (None, "vile " * 100_000), (2, "")]
    found = score_toxicity(documents(spark, asked), model).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in found) == [(0, 1), (1, 0), (2, 0), (2, 0)]
    none = spark.createDataFrame([], LABELS)
    assert {r.predicted for r in classify_toxicity(documents(spark, texts[:5]), none).collect()} == {0}
    assert classify_toxicity(documents(spark, []), none).count() == 0


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_query_on_held_out_documents(spark, sf_dir, folder):
    base = sf_dir.replace("sf0.001", folder)
    truth = dict(spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "toxic").collect())
    found = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, base).collect()}
    assert len(found) == spark.read.parquet(f"{base}/documents.parquet").count()
    right = sum(found[i].predicted == toxic for i, toxic in truth.items())
    assert right >= 0.95 * len(truth)
