from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from starloom.llm.exact_dedup import exact_dedup, keep_one_copy
from tests.llm.brute import documents, lower_ascii
from tests.plans import plan_of

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
LONG = "word " * 60_000


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower_ascii(text or "")].append(doc_id)
    result = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for doc_id in ids:
            result[doc_id, keep, len(ids), doc_id == keep, digest] += 1
    return result


def found(df, **settings):
    return Counter(tuple(row) for row in exact_dedup(df, **settings).select(*COLUMNS).collect())


ROWS = [
    (1, "Same text"),
    (2, "same TEXT"),
    (9, "same text"),
    (3, "Été"),
    (4, "été"),
    (5, None),
    (6, ""),
    (7, LONG),
    (8, LONG.upper()),
    (10, LONG[:-2] + "x "),
    (11, "same test"),
    (None, "same text"),
    (None, "alone"),
    (12, "twice"),
    (12, "twice"),
    (None, "no ids"),
    (None, "no ids"),
]


def test_equals_brute_force(spark):
    assert found(documents(spark, ROWS), digest_all=True) == expected(ROWS)


def test_only_contested_texts_are_hashed(spark):
    rows = exact_dedup(documents(spark, [(1, "a"), (2, "bb"), (3, "BB"), (4, "cc")])).collect()
    assert {row.doc_id: row.text_sha256 is not None for row in rows} == {
        1: False, 2: True, 3: True, 4: False
    }


def test_empty_table(spark):
    assert found(documents(spark, []), digest_all=True) == Counter()
    assert keep_one_copy(documents(spark, [])).count() == 0


def test_hot_group_and_clashing_columns(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(1).alias("kept"), F.lit("x").alias("digest"), F.lit(2).alias("length"),
        F.lit("x").alias("row"), F.lit("x").alias("_text_digest"), F.lit("x").alias("a.b"),
        F.lit("x").alias("prefix"), F.lit("x").alias("last"), F.lit("x").alias("_dropped_id"),
    )
    rows = exact_dedup(df).where("group_size > 1").collect()
    assert len(rows) == 1000 and {row.keep_id for row in rows} == {2997}
    left = keep_one_copy(df)
    assert left.columns == df.columns and left.count() == 2001


def test_one_copy_stays(spark):
    left = keep_one_copy(documents(spark, ROWS)).select("doc_id", "text").collect()
    kept = Counter((row.doc_id, row.text) for row in left)
    assert kept == Counter(
        [(9, "same text"), (3, "Été"), (4, "été"), (6, ""), (8, LONG.upper()), (10, LONG[:-2] + "x "),
         (11, "same test"), (None, "alone"), (12, "twice"), (None, "no ids")]
    )


def test_other_texts_are_neither_hashed_nor_sorted(spark):
    df = documents(spark, [(i, f"text {i}") for i in range(50)] + [(7, "x" * 3_000_000)] * 2)
    left = keep_one_copy(df)
    plan = plan_of(left)
    # What is contested has been hashed and written before; whole rows are only grouped where
    # one id has one text several times.
    assert "sha2(" not in plan and plan.count("SortAggregate") == 2
    assert plan.count("first(row") == 2
    assert left.count() == 51 and left.where("length(text) = 3000000").count() == 1
