"""What tasks that run Python hold at once, by calling with large batches what Spark is given."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from starloom.sinks import write_json_array, write_json_split
from starloom.sources.records import CsvLines, JsonElements, find_splits, read_records

MEGABYTE = 1 << 20


@pytest.fixture
def given(spark, monkeypatch):
    """The functions that tasks are given by ``mapInArrow``, in order."""
    functions, frames = [], type(spark.range(1))
    plain = frames.mapInArrow

    def spy(self, function, *args, **kwargs):
        functions.append(function)
        return plain(self, function, *args, **kwargs)

    monkeypatch.setattr(frames, "mapInArrow", spy)
    return functions


def record_batches(count, rows=1000, width=1000):
    """Batches of JSON objects of about ``rows * width`` bytes."""
    for place in range(count):
        texts = [json.dumps({"k": place * rows + k, "s": "é" * (width // 2 - 10)}, ensure_ascii=False)
                 for k in range(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(texts)], ["value"])


def written(arrays, batches):
    """The lines that come of ``batches``, and the most bytes read and not yet passed on."""
    taken, passed, most, lines = 0, 0, 0, []

    def counted():
        nonlocal taken
        for batch in batches:
            taken += pc.sum(pc.binary_length(batch["value"])).as_py()
            yield batch

    for batch in arrays(counted()):
        most = max(most, taken - passed)
        for line in batch["value"].to_pylist():
            lines.append(line)
            passed += len(line.encode())
    return lines, most


@pytest.mark.parametrize("bytes_per_file", [1 << 30, 64 << 20])
def test_a_task_holds_no_whole_array(spark, tmp_path, given, bytes_per_file):
    place = str(tmp_path / "array")
    write_json_array(spark.range(1), place, bytes_per_file=bytes_per_file)
    lines, most = written(given[0], record_batches(20))
    # One batch and one line, of the 20 MB that the array has.
    assert most < 3 * MEGABYTE
    assert max(len(line.encode()) for line in lines) < 1.1 * MEGABYTE
    assert [row["k"] for row in json.loads("\n".join(lines))] == list(range(20_000))


@pytest.mark.parametrize("rows_per_file, bytes_per_file", [
    (2500, 64 << 20), (250_000, 3 * MEGABYTE), (250_000, 3 * MEGABYTE + 1), (1, 2 * MEGABYTE), (250_000, 10),
])
def test_files_begin_where_arrays_do(spark, tmp_path, rows_per_file, bytes_per_file):
    df = spark.range(0, 6000, 1, 1).selectExpr("id as k", "repeat('é', 500 + id % 7) as s")
    df = df.limit(6000 if rows_per_file > 1 and bytes_per_file > 10 else 40).coalesce(1)
    place = tmp_path / "array"
    write_json_array(
        df, str(place), pretty=False, rows_per_file=rows_per_file, bytes_per_file=bytes_per_file
    )
    files = [path.read_text() for path in sorted(place.glob("part-*"))]
    arrays = [json.loads(text) for text in files]
    assert [row["k"] for array in arrays for row in array] == [row.k for row in df.collect()]
    for text, array in zip(files, arrays):
        assert 1 <= len(array) <= rows_per_file
        assert len(array) == 1 or len(text.rstrip("\n").encode()) <= bytes_per_file + 4
    # No file is cut before it is full.
    for text, array, after in zip(files, arrays, arrays[1:]):
        size = len(text.rstrip().encode()) + len(json.dumps(after[0], ensure_ascii=False).encode())
        assert len(array) == rows_per_file or size > bytes_per_file - 4


def looked_at(monkeypatch, grammar):
    """The bytes of the chunks that ``grammar`` looks at together, call by call."""
    sizes, plain = [], grammar.steps

    def steps(self, chunks):
        sizes.append(pc.sum(pc.binary_length(chunks)).as_py())
        return plain(self, chunks)

    monkeypatch.setattr(grammar, "steps", steps)
    return sizes


def one_batch(chunks):
    names, size = ["value", "file", "start"], len(chunks)
    of = [pa.array(chunks), pa.array([7] * size, pa.int64()), pa.array([0] * size, pa.int64())]
    return iter([pa.RecordBatch.from_arrays(of, names)])


def test_elements_are_cut_a_megabyte_at_a_time(spark, tmp_path, given, monkeypatch):
    (tmp_path / "a.json").write_text("[{}]")
    grammar = JsonElements()
    splits = find_splits(spark, str(tmp_path), grammar)
    read_records(spark, str(tmp_path), grammar, splits)
    sizes = looked_at(monkeypatch, JsonElements)
    objects = [json.dumps({"k": k, "s": "x{" * 600}) for k in range(10_000)]
    chunks = ("[" + ",\n".join(objects) + "]").split("}")
    find, cut = given
    rows = [batch.to_pylist()[0] for batch in find(one_batch(chunks))]
    assert [(row["end0"], row["depth0"]) for row in rows] == [(0, -1)]
    texts = [row["text"] for batch in cut(one_batch(chunks)) for row in batch.to_pylist()]
    assert [text.lstrip("[,\n") + "}" for text in texts] == objects
    assert max(sizes) <= 1.1 * MEGABYTE and len(sizes) > 20


def test_lines_with_breaks_are_cut_a_megabyte_at_a_time(spark, tmp_path, given, monkeypatch):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    grammar = CsvLines()
    splits = find_splits(spark, str(tmp_path), grammar)
    read_records(spark, str(tmp_path), grammar, splits)
    sizes = looked_at(monkeypatch, CsvLines)
    records = ["a,b", *(f'{k},"{"x," * 300}""\n{"y" * 600}"' for k in range(5000))]
    chunks = "\n".join(records).split("\n")
    find, cut = given
    rows = [batch.to_pylist()[0] for batch in find(one_batch(chunks))]
    assert [(row["end0"], row["breaks0"]) for row in rows] == [(0, 1)]
    found = [row for batch in cut(one_batch(chunks)) for row in batch.to_pylist()]
    assert [row["text"] for row in found] == records
    assert [row["first"] for row in found] == [True] + [False] * 5000
    assert max(sizes) <= 1.1 * MEGABYTE and len(sizes) > 10


@pytest.mark.parametrize("rows_per_document", [1000, 7])
def test_split_documents_leave_a_megabyte_at_a_time(spark, tmp_path, given, rows_per_document):
    write_json_split(spark.range(1), str(tmp_path / "split"), rows_per_document=rows_per_document)
    cells = [f'[{k},"{"x" * 990}"]' for k in range(20_500)]
    columns = [pa.array(cells), pa.nulls(len(cells), pa.int64())]
    batch = pa.RecordBatch.from_arrays(columns, ["value", "position"])
    made = [lines["value"].to_pylist() for lines in given[0](iter([batch.slice(0, 0), batch]))]
    assert max(sum(map(len, lines)) for lines in made) < 2.2 * MEGABYTE
    documents = [json.loads(line) for lines in made for line in lines]
    sizes = [len(document["data"]) for document in documents]
    full, rest = divmod(20_500, rows_per_document)
    assert sizes == [rows_per_document] * full + [rest] * (rest > 0)
    assert [row[0] for document in documents for row in document["data"]] == list(range(20_500))
    assert all(document["index"] == list(range(n)) for document, n in zip(documents, sizes))
