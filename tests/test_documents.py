from __future__ import annotations

import pytest

from starloom.sinks import write_json_array
from starloom.sources import append_documents, read_collection, replace_collections

FIELDS = "k int, name string"


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), FIELDS)


def test_append_and_read(spark, tmp_path):
    store = str(tmp_path)
    assert append_documents(documents(spark, (1, "a"), (2, None)), store, "users") == 2
    assert append_documents(documents(spark, (1, "a")), store, "users") == 1
    found = read_collection(spark, store, "users", schema=FIELDS)
    assert sorted(r.k for r in found.collect()) == [1, 1, 2]
    ids = read_collection(spark, store, "users", drop_id=False)
    assert ids.columns[0] == "_id" and ids.select("_id").distinct().count() == 3
    assert "_id" not in read_collection(spark, store, "users").columns


def test_filter_document(spark, tmp_path):
    store = str(tmp_path)
    append_documents(documents(spark, (1, "a"), (2, None), (3, "b")), store, "users")

    def keys(where):
        return sorted(r.k for r in read_collection(spark, store, "users", where).collect())

    assert keys(None) == keys({}) == [1, 2, 3]
    assert keys({"name": "a"}) == [1]
    assert keys({"name": None}) == [2]
    assert keys({"name": "b", "k": 1}) == []
    assert "_id" not in read_collection(spark, store, "users", {"name": "none"}).columns


def test_replace_is_repeatable(spark, tmp_path):
    store, files = str(tmp_path / "store"), {}
    for name, size in (("users", 2), ("products", 3)):
        files[name] = str(tmp_path / name)
        write_json_array(documents(spark, *[(i, "x") for i in range(size)]), files[name])
    for _ in range(2):
        assert replace_collections(spark, store, files) == {"users": 2, "products": 3}
    assert read_collection(spark, store, "products").count() == 3


def test_connector_address(spark, monkeypatch):
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return documents(spark, (1, "a"))

    class Session:
        read = Reader()

    read_collection(
        Session(), "shop", "users", format="mongodb", options={"connection.uri": "given"}
    )
    assert asked == {
        "format": "mongodb",
        "database": "shop",
        "collection": "users",
        "connection.uri": "given",
    }


def test_a_broken_file_leaves_every_collection(spark, tmp_path):
    good, broken, store = tmp_path / "good.json", tmp_path / "broken.json", str(tmp_path / "store")
    good.write_text('[{"a": 1}, {"a": 2}]')
    assert replace_collections(spark, store, {"x": str(good), "y": str(good)}) == {"x": 2, "y": 2}
    good.write_text('[{"a": 3}]')
    broken.write_text('[{"a":1},{oops]')
    with pytest.raises(Exception, match="(?i)malformed"):
        replace_collections(spark, store, {"x": str(good), "y": str(broken)})
    for name in ("x", "y"):
        assert sorted(r.a for r in read_collection(spark, store, name).collect()) == [1, 2]
