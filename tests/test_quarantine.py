"""Broken lines of an event stream."""

from __future__ import annotations

import json

from starloom.plans.queries import _event_files, _layout, _silver
from starloom.streaming import (
    clean_up,
    finish,
    read_accepted,
    read_quarantined,
    start_with_quarantine,
    stream_checked_lines,
)

FIELDS = "k bigint, s string, deep string"


def run(spark, source, place):
    lines = stream_checked_lines(spark, str(source), FIELDS, max_files_per_trigger=1)
    finish(start_with_quarantine(lines, f"{place}/rows", f"{place}/check", available_now=True))


def kept(spark, place):
    good = [tuple(r) for r in read_accepted(spark, f"{place}/rows", FIELDS).collect()]
    broken = [(r.text, r.source_file.rsplit("/", 1)[1]) for r in read_quarantined(spark, f"{place}/rows", FIELDS).collect()]
    return sorted(good, key=str), sorted(broken)


def test_lines_are_kept_once_and_apart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"k": 1, "s": "a", "deep": {"x": [1]}}\n{"k": 2, "s\n\n  \n{"k": "no"}\n')
    run(spark, source, tmp_path)
    first = ([(1, "a", '{"x":[1]}')], [('{"k": "no"}', "1.json"), ('{"k": 2, "s', "1.json")])
    assert kept(spark, tmp_path) == first
    run(spark, source, tmp_path)
    assert kept(spark, tmp_path) == first
    (source / "2.json").write_text('[1, 2]\nnull\n{}\n{"k": 3, "other": true}\n')
    run(spark, source, tmp_path)
    good, broken = kept(spark, tmp_path)
    assert good == sorted([(1, "a", '{"x":[1]}'), (None, None, None), (3, None, None)], key=str)
    assert [text for text, name in broken if name == "2.json"] == ["[1, 2]", "null"]


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    """The commit of a batch is lost after its files are in."""
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(json.dumps({"k": i}) + "\n{oops\n")
    run(spark, source, tmp_path)
    before = kept(spark, tmp_path)
    assert len(before[0]) == len(before[1]) == 3
    for file in (tmp_path / "check" / "commits").glob("*2*"):
        file.unlink()
    run(spark, source, tmp_path)
    assert kept(spark, tmp_path) == before


def test_one_side_is_read_alone(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"k": 1}\n{oops\n')
    run(spark, source, tmp_path)
    assert len(read_accepted(spark, f"{tmp_path}/rows", FIELDS).inputFiles()) <= 2
    plan = read_quarantined(spark, f"{tmp_path}/rows", FIELDS)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(quarantined" in plan


def test_clean_up_leaves_nothing(spark, sf_dir):
    layout = _layout(spark)
    _silver(spark, _event_files(spark, sf_dir), layout)
    assert spark.catalog.tableExists(layout.silver_table)
    clean_up(spark, layout)
    assert not spark.catalog.databaseExists(layout.database)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(layout.prefix)]
