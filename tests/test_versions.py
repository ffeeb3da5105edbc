"""Publication that never loses: every statement and write fails in turn."""

from __future__ import annotations

import pytest

from starloom.operators import KeyViolation, count_by
from starloom.sinks import append_once, load_table, recreate_table, restore, write_json_array
from starloom.sinks.versions import list_versions, live_version, versions_base
from starloom.sources import (
    append_documents,
    read_collection,
    read_table,
    replace_collections,
    stream_json_lines,
)
from starloom.streaming import drop_versions, finish, replace_table
from tests.faults import Broken, failing_at, try_each


def rows(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string")


def keys_of(spark, table):
    return sorted(r.k for r in spark.table(table).collect())


def tables_of(spark, database):
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


@pytest.mark.parametrize("operation", ["insert", "update"])
def test_loads_that_fail_anywhere(spark, database, operation):
    table, last = f"{database}.t", [1]
    load_table(rows(spark, 1), table, "k")
    tried = iter(range(2, 200))

    def load():
        key = next(tried)
        last.append(key)
        load_table(rows(spark, key), table, "k", operation)

    def check(failed):
        found = keys_of(spark, table)
        if operation == "insert":
            assert found in ([last[-1]], last[-2:-1]) and (failed or found == last[-1:])
            last[:] = found
        else:
            assert found in (last, last[:-1]) and (failed or found == last)
            last[:] = found
        assert tables_of(spark, database) == ["t"]

    assert try_each(load, check) >= 3
    load()
    assert last[-1] in keys_of(spark, table)
    assert len(list_versions(spark, versions_base(spark, table))) == 1


def test_a_first_load_that_fails_leaves_no_table_or_a_whole_one(spark, database):
    place = [0]

    def load():
        place[0] += 1
        load_table(rows(spark, 1, 2), f"{database}.t{place[0]}", "k")

    def check(failed):
        name = f"{database}.t{place[0]}"
        if spark.catalog.tableExists(name):
            assert keys_of(spark, name) == [1, 2]
        else:
            assert failed

    try_each(load, check)


def test_other_columns(spark, database):
    """Two renames; the second is undone, and a crash between them is mended by the next load."""
    table = f"{database}.t"
    load_table(rows(spark, 1), table, "k")
    shapes = [rows(spark, 2).withColumnRenamed("v", f"c{i}") for i in range(40)]
    columns = iter(range(40))

    def load():
        load_table(shapes[next(columns)], table, "k")

    def check(failed):
        restore(spark, table)
        assert len(keys_of(spark, table)) == 1 and "t" in tables_of(spark, database)

    try_each(load, check)
    load()
    assert keys_of(spark, table) == [2]
    spark.sql(f"ALTER TABLE {table} RENAME TO {database}.t__former_x")
    load_table(rows(spark, 7), table, "k", "insert")
    assert keys_of(spark, table) == [7] and not restore(spark, table)


def test_recreate_that_fails_anywhere(spark, database):
    table = f"{database}.t"
    load_table(rows(spark, 1), table, "k")

    def check(failed):
        assert keys_of(spark, table) in ([1], []) and (failed or keys_of(spark, table) == [])
        assert tables_of(spark, database) == ["t"]
        load_table(rows(spark, 1), table, "k")

    try_each(lambda: recreate_table(spark, table, rows(spark, 1).schema), check)
    with pytest.raises(Exception):
        recreate_table(spark, table, rows(spark, 1).schema, format="nothing")
    assert keys_of(spark, table) == [1]


def test_replaced_rows_are_deleted(spark, database):
    table = f"{database}.t"
    for key in range(4):
        load_table(rows(spark, key), table, "k")
    base = versions_base(spark, table)
    assert list_versions(spark, base) == [live_version(spark, table)]
    # A table that was made by other means gives up its folder too, one elsewhere is left.
    spark.sql(f"CREATE TABLE {database}.own (k int, v string) USING parquet")
    spark.sql(f"INSERT INTO {database}.own VALUES (1, 'x')")
    load_table(rows(spark, 5), f"{database}.own", "k")
    assert keys_of(spark, f"{database}.own") == [5]


def test_foreign_rows_are_left(spark, database, tmp_path):
    place = str(tmp_path / "theirs")
    rows(spark, 1).write.parquet(place)
    spark.catalog.createTable(f"{database}.t", path=place, source="parquet")
    load_table(rows(spark, 2), f"{database}.t", "k")
    assert keys_of(spark, f"{database}.t") == [2] and spark.read.parquet(place).count() == 1


def test_append_once(spark, database):
    table = f"{database}.t"
    assert append_once(rows(spark, 1, 2), table, "k", "monday's")
    assert not append_once(rows(spark, 1, 2), table, "k", "monday's")
    assert append_once(rows(spark, 3).select("v", "k"), table, "k", "b")
    with pytest.raises(KeyViolation):
        append_once(rows(spark, 3), table, "k", "c")
    with pytest.raises(KeyViolation):
        append_once(rows(spark, 4, 4), table, "k", "c")
    assert keys_of(spark, table) == [1, 2, 3]
    assert {r.load_token for r in spark.table(table).collect()} == {"monday's", "b"}
    load_table(rows(spark, 1), f"{database}.plain", "k")
    with pytest.raises(ValueError, match="no table of tokens"):
        append_once(rows(spark, 2), f"{database}.plain", "k", "x")
    with pytest.raises(ValueError, match="exists already"):
        append_once(spark.table(table), table, "k", "x")


def test_appends_that_fail_anywhere_are_in_once(spark, database):
    table = f"{database}.t"
    append_once(rows(spark, 0), table, "k", "0")
    place = [0]

    def load():
        place[0] += 1
        append_once(rows(spark, place[0]), table, "k", str(place[0]))

    def check(failed):
        append_once(rows(spark, place[0]), table, "k", str(place[0]))
        assert keys_of(spark, table) == list(range(place[0] + 1))

    assert try_each(load, check) >= 3


def array(spark, tmp_path, name, *keys):
    place = str(tmp_path / name)
    write_json_array(rows(spark, *keys), place, mode="overwrite")
    return place


def held(spark, store, name):
    return sorted(r.k for r in read_collection(spark, store, name, schema="k int, v string").collect())


def test_uploads_that_fail_anywhere(spark, tmp_path):
    """Several collections change together or not at all."""
    store = str(tmp_path / "store")
    files = [{name: array(spark, tmp_path, f"{name}{i}", i) for name in ("x", "y")} for i in (0, 1)]
    replace_collections(spark, store, files[0])
    live, turn = [0], [0]

    def upload():
        turn[0] = 1 - live[0]
        replace_collections(spark, store, files[turn[0]])

    def check(failed):
        found = held(spark, store, "x")
        assert found == held(spark, store, "y")
        assert found in ([0], [1]) and (failed or found == turn)
        live[:] = found
        if failed:
            # An upload that succeeds clears away what failed ones have left.
            upload()
            check(False)

    try_each(upload, check)
    states = list((tmp_path / "store" / "ledger.of.collections").iterdir())
    assert len([s for s in states if s.name.startswith("state-")]) == 2


def test_documents_of_a_token_are_in_once(spark, tmp_path):
    store = str(tmp_path / "store")
    assert append_documents(rows(spark, 0), store, "x", token="0") == 1
    assert append_documents(rows(spark, 0), store, "x", token="0") == 0
    assert append_documents(rows(spark, 0), store, "y", token="0") == 1
    place = [0]

    def upload():
        place[0] += 1
        append_documents(rows(spark, place[0]), store, "x", token=str(place[0]))

    def check(failed):
        append_documents(rows(spark, place[0]), store, "x", token=str(place[0]))
        assert held(spark, store, "x") == list(range(place[0] + 1))

    try_each(upload, check)
    assert held(spark, store, "y") == [0]


def test_a_plain_directory_becomes_part_of_a_collection(spark, tmp_path):
    store = str(tmp_path / "store")
    rows(spark, 1, 2).write.json(f"{store}/x")
    assert held(spark, store, "x") == [1, 2]
    append_documents(rows(spark, 3), store, "x")
    append_documents(rows(spark, 4), store, "x")
    assert held(spark, store, "x") == [1, 2, 3, 4]
    for _ in range(4):
        replace_collections(spark, store, {"x": array(spark, tmp_path, "a", 9)},
                            schemas={"x": "k int, v string"})
    assert held(spark, store, "x") == [9] and spark.read.json(f"{store}/x").count() == 2
    for name in ("ledger.of.collections",):
        with pytest.raises(ValueError, match="ledger"):
            append_documents(rows(spark, 1), store, name)


def test_streams_that_fail_anywhere(spark, database, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "counts"
    folder.mkdir()
    table, check_place = f"{database}.counts", str(tmp_path / "check")
    counts = count_by(stream_json_lines(spark, str(folder), "n string"), "n", "c")
    place = [0]

    def run():
        finish(replace_table(counts, table, str(path), check_place, available_now=True))

    def put():
        place[0] += 1
        (folder / f"{place[0]}.json").write_text('{"n": "a"}\n')

    def step():
        put()
        try:
            run()
        except Exception as error:
            raise Broken(str(error)) from error

    def check(failed):
        if spark.catalog.tableExists(table):
            live = [tuple(r) for r in read_table(spark, table).collect()]
            assert live[0][1] in (place[0], place[0] - 1) and (failed or live[0][1] == place[0])
            drop_versions(spark, table, str(path))
            assert [tuple(r) for r in read_table(spark, table).collect()] == live
        run()
        assert [tuple(r) for r in read_table(spark, table).collect()] == [("a", place[0])]

    put()
    run()
    try_each(step, check)
    properties = {r.key for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert not any("starloom" in key for key in properties)


def test_the_live_version_always_stays(spark, database, tmp_path):
    """A folder that is newer than the live one, and one that is older, by a crash before the switch."""
    path, table = f"{tmp_path}/v", f"{database}.t"
    for place, name in enumerate(["old", "live", "newer"]):
        rows(spark, place).write.parquet(f"{path}/version={name}")
    spark.catalog.createTable(table, path=f"{path}/version=live", source="parquet")
    assert drop_versions(spark, table, path, keep=1) == ["version=old"]
    assert keys_of(spark, table) == [1]
    assert list_versions(spark, path) == ["version=live", "version=newer"]
    assert drop_versions(spark, table, f"{tmp_path}/elsewhere", keep=1) == []
    with failing_at(0, False), pytest.raises(Broken):
        drop_versions(spark, table, path)
