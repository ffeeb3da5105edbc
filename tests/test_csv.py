from __future__ import annotations

import csv
import datetime as dt
import random

import pandas as pd
import pyarrow as pa
import pytest

from starloom.sinks import csv_to_json, write_csv
from starloom.sources import read_csv_text, read_csv_typed, read_json_array, read_json_lines
from starloom.sources.records import CsvLines, followed
from tests.plans import plan_of

RAGGED = (
    "id,name,v\n"
    "1,a,\n"
    "\n"
    '2,"b,c"\n'
    "3,d,7,extra\n"
    "4,,8,extra,more\n"
    '5,"say ""hi""\nthere",9\n'
    "6\n"
    "7,\n"
    '8,"",\n'
    '9,"x\n,y"\n'
    "10,back\\slash, blank \n"
)


def dict_rows(path):
    with open(path, newline="", encoding="utf-8") as file:
        rows = list(csv.DictReader(file))
    return [{"rest" if name is None else name: value for name, value in row.items()} for row in rows]


def as_dicts(df):
    """As the dict reader has them: surplus fields only where there are some."""
    rows = [row.asDict() for row in df.collect()]
    return [{n: v for n, v in row.items() if n != "rest" or v is not None} for row in rows]


def test_ragged_file_reads_as_dict_reader(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text(RAGGED, encoding="utf-8")
    assert as_dicts(read_csv_text(spark, str(path), rest="rest")) == dict_rows(path)


def test_random_files_read_as_dict_reader(spark, tmp_path):
    dice = random.Random(3)
    parts = ["", " ", "a", "é", '"', ",", "\n", "\\", "0", "null", "b c"]
    path = tmp_path / "random.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(["a", "b", "c"])
        for i in range(400):
            width = dice.choice([1, 2, 3, 3, 3, 3, 4, 5])
            cells = ["".join(dice.choices(parts, k=dice.randrange(4))) for _ in range(width)]
            writer.writerow([f"{i}" + cells[0], *cells[1:]])
    ours = as_dicts(read_csv_text(spark, str(path), rest="rest"))
    assert ours == dict_rows(path)


def test_control_characters_are_data(spark, tmp_path):
    path = tmp_path / "control.csv"
    path.write_text("a,b,c\n\x01,x\n\x01,\x01,\x01,\x01\n", encoding="utf-8")
    assert as_dicts(read_csv_text(spark, str(path), rest="rest")) == dict_rows(path)


@pytest.mark.parametrize("read", [read_csv_text, read_csv_typed])
def test_surplus_fields_and_other_headers_fail(spark, tmp_path, read):
    path = tmp_path / "surplus.csv"
    path.write_text("a,b\n1,2\n2,3,999\n", encoding="utf-8")
    with pytest.raises(Exception, match="more than 2 fields"):
        read(spark, str(path)).collect()
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, str(folder)).collect()


def test_schema_is_matched_by_name(spark, tmp_path):
    path = tmp_path / "order.csv"
    path.write_text("b,a\nx,1\n", encoding="utf-8")
    found = read_csv_typed(spark, str(path), "a int, b string")
    assert found.columns == ["a", "b"] and tuple(found.first()) == (1, "x")
    for wrong in ("a int", "a int, b string, c int", "a int, c string"):
        with pytest.raises(ValueError, match="header"):
            read_csv_typed(spark, str(path), wrong)


def test_single_lines_are_split(spark, tmp_path, settings):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(5000)), encoding="utf-8")
    settings({"spark.sql.files.maxPartitionBytes": "10000"})
    rows = read_csv_text(spark, str(path))
    assert rows.rdd.getNumPartitions() > 1
    assert rows.count() == 5000


def test_column_pruning_keeps_missing_apart_from_empty(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text("id,v\n1,\n2\n", encoding="utf-8")
    assert [r.v for r in read_csv_text(spark, str(path)).select("v").collect()] == ["", None]


def test_typed_scan_equals_pandas(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text(
        "k,price,name,day\n1,2.5,NA,2001-02-03\n2,,x,\n3,nan,,2001-02-04\n4,1e2,None,NA\n",
        encoding="utf-8",
    )
    ours = read_csv_typed(spark, str(path), "k bigint, price double, name string, day date")
    theirs = pd.read_csv(path)
    rows = ours.orderBy("k").collect()
    for column in ("k", "price", "name"):
        expected = [None if pd.isna(v) else v for v in theirs[column]]
        assert [r[column] for r in rows] == expected
    assert rows[0].day == dt.date(2001, 2, 3) and rows[3].day is None


def test_typed_scan_rejects_bad_numbers(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("k\n1\n12x\n", encoding="utf-8")
    with pytest.raises(Exception, match="not a bigint"):
        read_csv_typed(spark, str(path), "k bigint").collect()


def test_inferred_types_equal_pandas(spark, tmp_path):
    path = tmp_path / "inferred.csv"
    path.write_text(
        "k,price,name,day,flag,some,none,big\n"
        "1,2.5,x,2001-02-03,True,4,NA,99999999999999999999\n"
        "2,NA,NA,2001-02-04,False,,,1\n"
        "-3,1e3,12d,,True,+5,null,2\n",
        encoding="utf-8",
    )
    ours, theirs = read_csv_typed(spark, str(path)), pd.read_csv(path)
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
    expected = {name: kinds[str(kind)] for name, kind in theirs.dtypes.items() if name != "big"}
    assert {name: kind for name, kind in ours.dtypes if name != "big"} == expected
    for row, (_, other) in zip(ours.collect(), theirs.iterrows()):
        assert [row[n] for n in expected] == [None if pd.isna(other[n]) else other[n] for n in expected]
    kept = read_csv_typed(spark, str(path), missing=())
    assert dict(kept.dtypes)["price"] == "string"
    assert [r.price for r in kept.collect()] == ["2.5", "NA", "1e3"]


def test_csv_round_trip_of_hard_text(spark, tmp_path):
    texts = ['"', "a,b", "line\nbreak", "\r\n", " blanks ", "\\", '\\"', "tab\t", "é"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "i string, t string")
    write_csv(rows, str(tmp_path / "out"))
    assert {(r.i, r.t) for r in read_csv_text(spark, str(tmp_path / "out")).collect()} == {
        (str(i), t) for i, t in enumerate(texts)
    }


@pytest.mark.parametrize("broken", [False, True])
def test_fields_are_counted_once_per_row(spark, tmp_path, broken):
    """However many columns there are."""
    counts = []
    for width in (2, 9):
        path = tmp_path / f"{width}.csv"
        names = ",".join(f"c{i}" for i in range(width))
        path.write_text(names + "\n" + ('"a\nb",c\n' if broken else "a,b\n"), encoding="utf-8")
        plan = plan_of(read_csv_text(spark, str(path)))
        counts.append((plan.count("regexp_extract_all"), plan.count("raise_error")))
    assert counts[0] == counts[1]


def test_files_are_bounded(spark, tmp_path):
    write_csv(spark.range(0, 10, 1, 1), str(tmp_path / "out"), rows_per_file=3)
    assert len(list((tmp_path / "out").glob("part-*"))) == 4
    assert read_csv_text(spark, str(tmp_path / "out")).count() == 10


def test_empty_frame_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([], "i string, t string")
    write_csv(rows, str(tmp_path / "out"))
    found = read_csv_text(spark, str(tmp_path / "out"))
    assert found.columns == ["i", "t"] and found.collect() == []


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_csv_to_json_keeps_every_value_as_text(spark, tmp_path, layout):
    source, target = tmp_path / "ragged.csv", str(tmp_path / "json")
    source.write_text(RAGGED, encoding="utf-8")
    csv_to_json(spark, str(source), target, layout, rest="rest")
    read = read_json_array if layout == "array" else read_json_lines
    rows = read(spark, target, "id string, name string, v string, rest array<string>")
    rows = sorted(as_dicts(rows), key=lambda row: int(row["id"]))
    assert rows == dict_rows(source)


def test_unknown_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1\n")
    with pytest.raises(ValueError):
        csv_to_json(spark, str(tmp_path / "a.csv"), str(tmp_path / "b"), "other")


CELLS = ["", " ", "a", "é", '"', ",", "\n", "\\", "0", "null", "b c", "\r\n", "x" * 30, '""', '",']


def random_csv(path, seed, rows=1500, end="\n"):
    dice = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(["a", 'b "x"\ny', "c"])
        for i in range(rows):
            width = dice.choice([1, 2, 3, 3, 3, 4, 5])
            cells = ["".join(dice.choices(CELLS, k=dice.randrange(6))) for _ in range(width)]
            writer.writerow([f"{i}" + cells[0], *cells[1:]])


def in_order(rows):
    return sorted(rows, key=lambda row: (int("0" + "".join(c for c in row["a"][:4] if c.isdigit())), str(row)))


@pytest.mark.parametrize("seed, bytes_, end", [(1, 2000, "\n"), (2, 97, "\n"), (3, 700, "\r\n"), (4, 13000, "\n")])
def test_line_breaks_in_fields_of_many_splits(spark, tmp_path, settings, seed, bytes_, end):
    """One file in many tasks reads as the dict reader reads it."""
    path = tmp_path / "one.csv"
    random_csv(path, seed, rows=300 if bytes_ < 100 else 1500, end=end)
    settings({"spark.sql.files.maxPartitionBytes": str(bytes_), "spark.sql.files.openCostInBytes": "0"})
    rows = read_csv_text(spark, str(path), rest="rest")
    assert rows.rdd.getNumPartitions() > 4
    assert in_order(as_dicts(rows)) == in_order(dict_rows(path))


def test_fields_longer_than_splits(spark, tmp_path, settings):
    path = tmp_path / "long.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(["a", "b"])
        for i in range(20):
            writer.writerow([i, f'line "{i}",\n' * (400 * (i % 3))])
    settings({"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "0"})
    found = read_csv_typed(spark, str(path), "a int, b string", missing=())
    expected = {(int(row["a"]), row["b"] or None) for row in dict_rows(path)}
    assert {tuple(row) for row in found.collect()} == expected


def test_quotes_inside_plain_fields(spark, tmp_path, settings):
    """They are no more than characters, in a line of an odd number too."""
    path = tmp_path / "inch.csv"
    path.write_text('a,b\n1,5" disk\n2,x\n3,"y\nz"\n4,7" or 8" disk\n5,"q"rest\n' * 1 + "6,t\n", encoding="utf-8")
    settings({"spark.sql.files.maxPartitionBytes": "10", "spark.sql.files.openCostInBytes": "0"})
    rows = {row["a"]: row["b"] for row in as_dicts(read_csv_text(spark, str(path)))}
    theirs = {row["a"]: row["b"] for row in dict_rows(path)}
    assert {k: v for k, v in rows.items() if k != "5"} == {k: v for k, v in theirs.items() if k != "5"}
    assert len(rows) == len(theirs) == 6


@pytest.mark.parametrize("read", [read_csv_text, read_csv_typed])
@pytest.mark.parametrize("text", ['a,b\n1,"x\n3,p\n4,q\n', 'a,b\n1,"y"\n2,"', 'a,b\n"z""\n'])
def test_unterminated_quotes_fail(spark, tmp_path, read, text):
    path = tmp_path / "open.csv"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(Exception):
        pd.read_csv(path)
    with pytest.raises(ValueError, match="inside a record: .*open.csv"):
        read(spark, str(path))


def test_headers_of_several_files_with_line_breaks(spark, tmp_path):
    for name, text in (("1", '\ufeffa,"b\nc"\n1,"x\ny"\n'), ("2", '\na,"b\nc"\r\n2,z\r\n')):
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    rows = read_csv_text(spark, str(tmp_path))
    assert rows.columns == ["a", "b\nc"]
    assert {tuple(row) for row in rows.collect()} == {("1", "x\ny"), ("2", "z")}
    (tmp_path / "3.csv").write_text('a,"b\nd"\n', encoding="utf-8")
    with pytest.raises(Exception, match="another header"):
        read_csv_text(spark, str(tmp_path)).collect()


def test_names_that_are_missing_or_repeated(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("a,,a,b\n1,2,3,4\n")
    (tmp_path / "broken.csv").write_text('a,,a,b\n1,2,3,"4\n"\n')
    names = [read_csv_text(spark, str(tmp_path / f"{name}.csv")).columns for name in ("plain", "broken")]
    assert names[0] == names[1]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,"b\nc"\n', encoding="utf-8")
    assert read_csv_text(spark, str(tmp_path)).collect() == []
    (tmp_path / "2.csv").write_text('a,"b\nc"\n5,6', encoding="utf-8")
    assert [tuple(row) for row in read_csv_text(spark, str(tmp_path)).collect()] == [("5", "6")]


def test_steps_of_lines():
    """Against a plain walk over the characters."""
    def walk(line, inside):
        state = "in" if inside else "start"
        for char in line:
            if state == "start":
                state = "in" if char == '"' else "start" if char == "," else "plain"
            elif state == "plain":
                state = "start" if char == "," else "plain"
            elif state == "in":
                state = "closing" if char == '"' else "in"
            elif state == "closing":
                state = "in" if char == '"' else "start" if char == "," else "plain"
        return int(state == "in")

    dice = random.Random(6)
    lines = ["".join(dice.choices('",ax', k=dice.randrange(12))) for _ in range(3000)]
    ends0, ends1, _, _ = CsvLines().steps(pa.array(lines))
    assert ends0.tolist() == [walk(line, False) for line in lines]
    assert ends1.tolist() == [walk(line, True) for line in lines]
    state, states = 1, []
    for end0, end1 in zip(ends0, ends1):
        state = int((end0, end1)[state])
        states.append(state)
    assert followed(ends0, ends1, 1).tolist() == states
