from __future__ import annotations

import gzip
import io
import json
from glob import glob

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import ingestion_summary
from starloom.sinks import (
    convert,
    read_any,
    write_json_array,
    write_json_lines,
    write_json_split,
)
from starloom.sources import read_json_array, read_json_lines, read_json_split

FIELDS = "k bigint, price double, name string, ok boolean, day date"


def rows(spark, n=25, partitions=3):
    return spark.range(0, n, 1, partitions).select(
        F.col("id").alias("k"),
        F.when(F.col("id") != 3, F.col("id") / 4).alias("price"),
        F.when(F.col("id") != 4, F.concat(F.lit('q"\n,]\\ é'), "id")).alias("name"),
        (F.col("id") > 5).alias("ok"),
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
    )


def content(df):
    return sorted(tuple(r) for r in df.fillna({"price": -1, "name": "-"}).collect())


def part_texts(path):
    return [open(name, encoding="utf-8").read() for name in sorted(glob(f"{path}/part-*"))]


@pytest.mark.parametrize("pretty", [True, False])
def test_array_files(spark, tmp_path, pretty):
    path = str(tmp_path / "array")
    write_json_array(rows(spark), path, pretty=pretty)
    texts = part_texts(path)
    records = [record for text in texts for record in json.loads(text)]
    assert len(texts) == 3 and len(records) == 25
    assert all(set(record) == {"k", "price", "name", "ok", "day"} for record in records)
    assert content(read_json_array(spark, path, FIELDS)) == content(rows(spark))


@pytest.mark.parametrize("rows_per_file", [1, 4, 5, 25])
def test_arrays_of_bounded_size(spark, tmp_path, rows_per_file):
    path = str(tmp_path / "array")
    write_json_array(rows(spark, partitions=1), path, rows_per_file=rows_per_file)
    sizes = [len(json.loads(text)) for text in part_texts(path)]
    full, rest = divmod(25, rows_per_file)
    assert sizes == [rows_per_file] * full + [rest] * (rest > 0)
    assert content(read_json_array(spark, path, FIELDS)) == content(rows(spark))


def test_array_of_nothing(spark, tmp_path):
    path = str(tmp_path / "array")
    write_json_array(rows(spark).where("k > 100"), path)
    assert all(json.loads(text) == [] for text in part_texts(path))
    assert read_json_array(spark, path, FIELDS).count() == 0


def test_array_with_an_empty_part(spark, tmp_path):
    path = str(tmp_path / "array")
    write_json_array(rows(spark).where("k > 20"), path)
    assert sorted(len(json.loads(text)) for text in part_texts(path)) == [0, 0, 4]


def test_array_is_not_cut_by_a_session_setting(spark, tmp_path, settings):
    settings({"spark.sql.files.maxRecordsPerFile": "4"})
    path = str(tmp_path / "array")
    write_json_array(rows(spark), path)
    assert content(read_json_array(spark, path, FIELDS)) == content(rows(spark))


@pytest.mark.parametrize("schema", [None, "k bigint"])
def test_broken_array_fails(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": ]')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path / "a.json"), schema).collect()


def test_broken_split_document_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"columns":["k"],"data":[[1],[')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_split(spark, str(tmp_path / "a.json"), "k bigint").collect()


def test_split_documents(spark, tmp_path):
    path = str(tmp_path / "split")
    write_json_split(rows(spark), path, rows_per_document=4)
    lines = [line for text in part_texts(path) for line in text.splitlines()]
    documents = [json.loads(line) for line in lines]
    assert max(len(d["data"]) for d in documents) == 4
    assert sum(len(d["data"]) for d in documents) == 25
    frames = [pd.read_json(io.StringIO(line), orient="split") for line in lines]
    assert sorted(pd.concat(frames)["k"]) == list(range(25))
    assert content(read_json_split(spark, path, FIELDS)) == content(rows(spark))


def test_split_file_of_pandas(spark, tmp_path):
    path = tmp_path / "products.json"
    frame = pd.DataFrame({"k": [1, 2], "price": [1.5, None], "name": ["a", "b\n"]})
    frame.to_json(path, orient="split", compression="infer")
    found = read_json_split(spark, str(path), "name string, k bigint, price double")
    assert [tuple(r) for r in found.orderBy("k").collect()] == [("a", 1, 1.5), ("b\n", 2, None)]


def test_split_of_nothing(spark, tmp_path):
    path = str(tmp_path / "split")
    write_json_split(rows(spark).where("k > 100"), path)
    assert read_json_split(spark, path, FIELDS).count() == 0


def test_compression_follows_the_extension(spark, tmp_path):
    path = str(tmp_path / "split.json.gz")
    write_json_split(rows(spark), path)
    files = glob(f"{path}/part-*.gz")
    assert files and json.loads(gzip.open(files[0]).readline())
    write_json_lines(rows(spark), str(tmp_path / "lines.bz2"))
    assert glob(f"{tmp_path}/lines.bz2/part-*.bz2")


def test_lines_keep_null_fields(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_json_lines(rows(spark), path)
    records = [json.loads(line) for text in part_texts(path) for line in text.splitlines()]
    assert all(set(record) == {"k", "price", "name", "ok", "day"} for record in records)
    assert content(read_json_lines(spark, path, FIELDS)) == content(rows(spark))


def test_inferred_lines_show_corrupt_ones(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"a": 1}\n{"a": \n')
    found = read_json_lines(spark, str(tmp_path / "e.json"))
    assert set(found.columns) == {"a", "_corrupt_record"}


FORMATS = ["csv", "json", "json_array", "json_split", "parquet", "table"]


@pytest.mark.parametrize(
    "source, target", [(a, b) for a, b in zip(FORMATS, FORMATS[1:] + FORMATS[:1])]
)
def test_any_format_to_any_other(spark, tmp_path, database, source, target):
    def place(role, format):
        return f"{database}.{role}" if format == "table" else str(tmp_path / role)

    plain = rows(spark).withColumn("name", F.coalesce("name", F.lit("-")))
    start = str(tmp_path / "start")
    plain.write.parquet(start)
    first, second, last = place("first", source), place("second", target), str(tmp_path / "last")
    own = ("table", "parquet")
    schema = None if source in own else FIELDS
    convert(spark, start, "parquet", first, source)
    convert(spark, first, source, second, target, schema)
    convert(spark, second, target, last, "parquet", None if target in own else FIELDS)
    result = spark.read.parquet(last)
    assert content(result.select(*plain.columns)) == content(plain)
    assert tuple(ingestion_summary(result).first()) == (25, 5)


def test_unknown_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        convert(spark, "a", "xml", "b", "csv")
    with pytest.raises(ValueError):
        convert(spark, "a", "json_split", "b", "csv")
    rows(spark).write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError):
        convert(spark, str(tmp_path / "p"), "parquet", str(tmp_path / "x"), "xml")


NESTED = "id int, tags array<string>, place struct<x: int, y: string>, counts map<string, int>, note string"
NESTED_ROWS = [
    (1, ["a", 'b"'], (1, "p,q"), {"k": 1}, ""),
    (2, [], None, None, None),
    (3, None, (None, None), {}, "NA"),
]


@pytest.mark.parametrize("target", ["csv", "json", "json_array", "json_split"])
def test_nested_columns_nulls_and_empty_texts_survive(spark, tmp_path, target):
    plain = spark.createDataFrame(NESTED_ROWS, NESTED)
    start, middle, last = (str(tmp_path / name) for name in ("start", "middle", "last"))
    plain.write.parquet(start)
    convert(spark, start, "parquet", middle, target)
    convert(spark, middle, target, last, "parquet", NESTED)
    found = spark.read.parquet(last)
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_options_must_apply(spark, tmp_path):
    start = str(tmp_path / "start")
    spark.range(3).write.parquet(start)
    for options in ({"source_options": {"header": False}}, {"target_options": {"rows": 1}}):
        with pytest.raises(ValueError, match="do not apply"):
            convert(spark, start, "parquet", str(tmp_path / "x"), "csv", **options)
    with pytest.raises(ValueError, match="schema of its own"):
        convert(spark, start, "parquet", str(tmp_path / "x"), "csv", "id long")
    convert(spark, start, "parquet", str(tmp_path / "c"), "csv", target_options={"compression": "gzip"})
    assert list((tmp_path / "c").glob("*.csv.gz"))


def test_large_single_line_csv_is_split(spark, tmp_path, settings):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(5000)))
    settings({"spark.sql.files.maxPartitionBytes": "10000"})
    rows = read_any(spark, str(path), "csv", "a int, b string")
    assert rows.rdd.getNumPartitions() > 1 and rows.count() == 5000


def test_broken_lines_fail_a_conversion(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"a": 1}\n{oops\n')
    for schema in (None, "a int"):
        with pytest.raises(Exception, match="(?i)malformed"):
            convert(spark, str(path), "json", str(tmp_path / f"out{schema}"), "parquet", schema)
    assert read_json_lines(spark, str(path), "a int").count() == 2


def test_array_files_are_bounded_in_bytes(spark, tmp_path):
    wide = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('é', 500) as text")
    write_json_array(wide, str(tmp_path / "out"), bytes_per_file=5000)
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) == 10 and all(file.stat().st_size < 5200 for file in files)
    assert read_json_array(spark, str(tmp_path / "out"), "id int, text string").count() == 40


@pytest.mark.parametrize("name", ["a.zip", "a.xz", "a.tar", "a.tar.gz"])
def test_archives_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError, match="no codec"):
        write_json_lines(spark.range(1), str(tmp_path / name))


def test_positions_of_all_rows(spark, tmp_path):
    """Positions count over all documents, as a data frame's own export has them."""
    source, path = rows(spark, n=53, partitions=4), str(tmp_path / "split")
    write_json_split(source, path, rows_per_document=5, order_by=[F.desc("k")])
    documents = [json.loads(line) for text in part_texts(path) for line in text.splitlines()]
    assert sorted(i for document in documents for i in document["index"]) == list(range(53))
    assert all(document["index"] == sorted(document["index"]) for document in documents)
    assert max(len(document["data"]) for document in documents) == 5
    found = read_json_split(spark, path, FIELDS, position="place")
    assert found.columns[0] == "place"
    assert {r.place: r.k for r in found.collect()} == {i: 52 - i for i in range(53)}
    assert content(found.drop("place")) == content(source)


def test_positions_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"columns": ["k"], "index": [0], "data": [[1], [2]]}\n')
    assert read_json_split(spark, str(tmp_path), "k int").count() == 2
    with pytest.raises(Exception, match="more or fewer positions"):
        read_json_split(spark, str(tmp_path), "k int", position="i").collect()
    with pytest.raises(ValueError, match="exists already"):
        read_json_split(spark, str(tmp_path), "k int", position="k")


def test_a_column_named_position(spark, tmp_path):
    df = spark.createDataFrame([(2, "x"), (1, "y")], "position int, `b.c` string")
    write_json_split(df, str(tmp_path / "a"), order_by="position")
    found = read_json_split(spark, str(tmp_path / "a"), df.schema, position="n").collect()
    assert sorted(map(tuple, found)) == [(0, 1, "y"), (1, 2, "x")]


@pytest.mark.parametrize("bytes_per_file", [1, 50, 120, 10_000])
def test_arrays_of_bounded_bytes(spark, tmp_path, bytes_per_file):
    df = spark.range(0, 40, 1, 2).select(F.repeat(F.lit("é"), (F.col("id") % 13).cast("int")).alias("t"))
    path = str(tmp_path / "array")
    write_json_array(df, path, pretty=False, rows_per_file=7, bytes_per_file=bytes_per_file)
    texts = part_texts(path)
    arrays = [json.loads(text) for text in texts]
    assert sum(map(len, arrays)) == 40 and all(1 <= len(array) <= 7 for array in arrays)
    for text, array in zip(texts, arrays):
        assert len(array) == 1 or len(text.encode()) <= bytes_per_file + 4
