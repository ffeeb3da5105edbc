"""Dimensions that grow, and checks of new keys that read little."""

from __future__ import annotations

import random

import pytest

from starloom.operators import KeyViolation, check_new_keys, grow_keys
from starloom.sinks import load_table, write_by_key


def members(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, v int")


def numbers(df):
    return {r.name: (r.key, r.v) for r in df.collect()}


def test_members_keep_their_numbers(spark, database):
    table = f"{database}.dim"
    load_table(grow_keys(members(spark, ("c", 1), ("a", 1)), None, "key", "name"), table, "key")
    assert numbers(spark.table(table)) == {"a": (1, 1), "c": (2, 1)}
    # b and d are new, a has another value, c is gone and stays.
    grown = grow_keys(members(spark, ("d", 2), ("b", 2), ("a", 2)), spark.table(table), "key", "name")
    load_table(grown, table, "key")
    assert numbers(spark.table(table)) == {"a": (1, 2), "c": (2, 1), "b": (3, 2), "d": (4, 2)}
    same = grow_keys(members(spark, ("a", 2)), spark.table(table), "key", "name")
    assert numbers(same) == numbers(spark.table(table))


def test_many_loads_equal_a_plain_version(spark, database):
    dice, table, plain = random.Random(4), f"{database}.dim", {}
    for load in range(4):
        names = sorted({f"m{dice.randrange(40):02}" for _ in range(25)})
        for name in names:
            if name not in plain:
                plain[name] = [len(plain) + 1, load]
            plain[name][1] = load
        existing = spark.table(table) if load else None
        rows = members(spark, *[(name, load) for name in names])
        load_table(grow_keys(rows, existing, "key", ["name"]), table, "key", sort_by_key=True)
        assert numbers(spark.table(table)) == {k: tuple(v) for k, v in plain.items()}


@pytest.mark.parametrize("rows", [[("a", 1), ("a", 2)], [(None, 1)]])
def test_members_must_be_known_by_their_keys(spark, rows):
    with pytest.raises(KeyViolation):
        grow_keys(members(spark, *rows), None, "key", "name")


def test_growing_needs_the_same_columns(spark):
    held = grow_keys(members(spark, ("a", 1)), None, "key", "name")
    with pytest.raises(ValueError, match="columns"):
        grow_keys(members(spark, ("a", 1)).drop("v"), held, "key", "name")
    assert numbers(grow_keys(members(spark), held, "key", "name")) == {"a": (1, 1)}


def scanned_rows(df):
    """Rows that a scan has read, by its metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for place in range(leaves.size()):
        metrics = leaves.apply(place).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total, plan


def test_only_rows_in_reach_are_read(spark, tmp_path, settings):
    """Files sorted by key are skipped by their ranges, and by Bloom filters for few keys."""
    from starloom.operators.keys import _may_hold

    settings({"spark.sql.adaptive.enabled": "false"})
    place = str(tmp_path / "t")
    rows = spark.range(0, 40_000, 2).selectExpr("id", "cast(id as string) as v")
    write_by_key(rows, "id").save(place)
    held = spark.read.parquet(place)
    assert scanned_rows(held.select("id"))[0] == 20_000
    for new, most in (((50_000, 90_000, 1000), 0), ((1, 10_000, 2), 10_000), ((3, 4, 1), 0)):
        fresh = spark.range(*new)
        check_new_keys(fresh, held, "id")
        read, plan = scanned_rows(_may_hold(held, fresh, ["id"]).select("id"))
        assert read <= most and "PushedFilters: [IsNotNull(id)" in plan
    with pytest.raises(KeyViolation, match="present"):
        check_new_keys(spark.range(39_990, 50_000), held, "id")
    with pytest.raises(KeyViolation, match="present"):
        check_new_keys(spark.range(8, 9), held, "id")


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(20,2)", "double", "binary", "boolean"])
def test_keys_of_other_types(spark, kind):
    days = spark.range(5).selectExpr("date_add(date'2020-01-01', cast(id as int)) as d", "id")
    value = "d" if kind in ("date", "timestamp") else "id % 2 = 1" if kind == "boolean" else "id"
    held = days.selectExpr(f"cast(cast({value} as string) as {kind}) as k")
    with pytest.raises(KeyViolation):
        check_new_keys(held.limit(1), held, "k")
    check_new_keys(held.limit(0), held, "k")
    check_new_keys(held, held.limit(0), "k")


def test_keys_of_several_columns(spark):
    held = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    check_new_keys(spark.createDataFrame([(1, "b"), (2, "a")], "k int, s string"), held, ["k", "s"])
    with pytest.raises(KeyViolation):
        check_new_keys(spark.createDataFrame([(2, "b")], "k int, s string"), held, ["k", "s"])
    # Another type is compared as before.
    with pytest.raises(KeyViolation):
        check_new_keys(spark.createDataFrame([(2,)], "k bigint"), held, "k")


def test_sorted_loads(spark, database):
    table = f"{database}.t"
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 as k", "id as v")
    load_table(rows, table, "k", sort_by_key=True)
    load_table(spark.range(1000, 1010).selectExpr("id as k", "id as v"), table, "k", "update", sort_by_key=True)
    assert spark.table(table).count() == 1010
    files = spark.table(table).selectExpr("_metadata.file_name as f", "k").groupBy("f").agg({"k": "min"})
    assert files.count() >= 2
    with pytest.raises(KeyViolation):
        load_table(spark.range(5).selectExpr("id as k", "id as v"), table, "k", "update")
