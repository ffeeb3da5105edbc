from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm.quality import (
    STATISTICS,
    QualityModel,
    drop_low_quality,
    fit_rules,
    score_quality,
    with_statistics,
)
from starloom.llm.queries import QUERIES
from tests.llm.brute import documents

LABELS = "doc_id bigint, quality int, toxic int"
TEXTS = ["Some plain text, with a few words.\nAnd a second line.", "BAD!! BAD!! BAD!!", "a | b | c\na | b | c",
         "Été 12 $$$ x", " \t ", "x", "word " * 40_000]


def statistics(text):
    """What the column expressions compute, in plain Python."""
    if not text:
        return dict.fromkeys(STATISTICS, 0.0)
    each = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if line]

    def share(part, whole):
        return part / whole if whole else 0.0

    def of(test):
        return sum(map(test, text)) / len(text)

    letters, digits = of(str.isalpha), of(str.isdecimal)
    spaces, marks = of(lambda c: c in " \t\n\x0b\f\r"), of(lambda c: c in ".,;:?")
    return {
        "chars": np.log1p(len(text)), "words": np.log1p(len(each)),
        "word_length": share(len(text), len(each)), "letters": letters, "capitals": of(str.isupper),
        "digits": digits, "spaces": spaces, "marks": marks,
        "symbols": 1 - letters - spaces - marks - digits, "bangs": of(lambda c: c == "!"),
        "bars": of(lambda c: c == "|"), "distinct_words": share(len(set(each)), len(each)),
        "distinct_lines": share(len(set(lines)), len(lines)),
        "line_words": np.log1p(share(len(each), len(lines))),
        "short_words": share(sum(len(w) < 3 for w in each), len(each)),
    }


def test_statistics_equal_plain_python(spark):
    rows = [*enumerate(TEXTS), (100, None), (101, "")]
    found = with_statistics(documents(spark, rows)).collect()
    for row in found:
        expected = statistics(dict(rows)[row.doc_id])
        assert {s: pytest.approx(row[s], abs=1e-9) for s in STATISTICS} == expected


def test_rules_are_found_and_few():
    draw = np.random.default_rng(3)
    values = draw.random((3000, len(STATISTICS)))
    labels = ~((values[:, 0] > 0.7) & (values[:, 3] <= 0.5))
    model = fit_rules(values, labels)
    assert 0 < len(model.rules) <= 60
    assert {place for rule, _ in model.rules for place, _, _ in rule} >= {0, 3}


def test_compiled_column_equals_the_rules(spark):
    draw = np.random.default_rng(4)
    values = draw.random((400, len(STATISTICS)))
    model = fit_rules(values, values[:, 2] > 0.4)
    df = spark.createDataFrame([[float(x) for x in row] for row in values], list(STATISTICS))
    found = [row[0] for row in df.select(model.column()).collect()]
    for row, score in zip(values, found):
        total = model.bias + sum(
            weight for rule, weight in model.rules if all((row[p] > t) == above for p, above, t in rule)
        )
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_one_class_and_no_rows():
    assert fit_rules(np.zeros((0, 15)), np.zeros(0)) == QualityModel([], 0.0)
    assert fit_rules(np.zeros((5, 15)), np.ones(5)).bias > 0 > fit_rules(np.zeros((5, 15)), np.zeros(5)).bias


def corpus():
    rows, labels = [], []
    for number in range(400):
        good = number % 4 != 0
        text = f"Plain text number {number} about some things. " * 3 if good else f"SPAM!! BUY{number}!! NOW!! " * 5
        rows.append((number, text))
        labels.append((number, int(good), 0))
    return rows, labels


def test_scores_of_held_out_rows_and_edge_cases(spark):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (None, rows[1][1]), (3, rows[3][1]), (1002, "word " * 50_000)]
    df = documents(spark, rows).withColumn("score", F.lit("x")).withColumn("chars", F.lit(1))
    labels += [labels[0], (None, 0, 0), (5, None, 0)]
    found = score_quality(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1
        if row.doc_id is not None:
            assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        if row.doc_id is not None and row.doc_id < 400:
            assert row.predicted == (row.doc_id % 4 != 0)


def test_rejected_documents_go(spark):
    rows, labels = corpus()
    rows.append((None, rows[0][1]))
    df = documents(spark, rows).withColumn("best", F.lit(0)).withColumn("predicted", F.lit(0))
    left = drop_low_quality(df, spark.createDataFrame(labels, LABELS))
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows if i is not None and i % 4}
    none = spark.createDataFrame([], LABELS)
    assert drop_low_quality(documents(spark, rows[:3]), none).count() == 3
    assert score_quality(documents(spark, []), none).count() == 0


def test_query_on_held_out_documents(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    truth = dict(spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality").collect())
    found = {r.doc_id: r for r in QUERIES["op1_quality"](spark, base).collect()}
    assert len(found) == spark.read.parquet(f"{base}/documents.parquet").count()
    held = [i for i in truth if found[i].held_out]
    assert sum(found[i].predicted == truth[i] for i in held) >= 0.95 * len(held)
