from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starloom.operators import count_by, with_audit_columns
from starloom.sources import read_table, stream_json_lines
from starloom.streaming import (
    append_to_files,
    append_to_table,
    bronze_view,
    clean_up,
    create_layout,
    drop_versions,
    finish,
    gold_view,
    join_reference_data,
    replace_table,
    silver_view,
    start_bronze,
    start_gold,
    start_silver,
    stop_all,
    wait_until_ready,
)
from tests.conftest import SMALL_SKEW
from tests.plans import plan_of


def event(i, name, previous):
    return {
        "device": "mobile",
        "ecommerce": {"total": i, "tags": ["a"]},
        "event_name": name,
        "event_previous_timestamp": previous,
        "event_timestamp": 1000 + i,
        "geo": {"city": "é"},
        "items": [{"item": i}],
        "traffic_source": "x",
        "user_first_touch_timestamp": 1,
        "user_id": f"u{i}",
    }


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    text = "".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    put(folder, "a.json", [event(1, "click", None), event(2, "click", 0), event(3, "click", 5)])
    put(folder, "b.json", [event(4, "view", 6), '{"broken": ', event(5, None, 7)])
    put(folder, "c.json", [event(6, "view", -1), event(7, "view", 8), event(8, "click", 9)])
    return folder


@pytest.fixture
def layout(spark, tmp_path):
    name = f"shop{abs(hash(str(tmp_path)))}"
    layout = create_layout(spark, name, str(tmp_path / "medallion"), prefix=f"{name}_")
    yield layout
    clean_up(spark, layout)


def run_all(spark, source, layout):
    bronze = bronze_view(spark, str(source), layout)
    queries = [start_bronze(bronze, layout, available_now=True)]
    finish(queries[-1])
    queries.append(start_silver(silver_view(spark, layout), layout, available_now=True))
    finish(queries[-1])
    queries.append(start_gold(gold_view(spark, layout), layout, available_now=True))
    finish(queries[-1])
    return queries


def gold_rows(spark, layout):
    return {tuple(r) for r in read_table(spark, layout.gold_table).collect()}


def test_three_stages(spark, source, layout):
    bronze_query = run_all(spark, source, layout)[0]
    assert len(bronze_query.recentProgress) >= 3  # one file per batch

    bronze = spark.read.parquet(layout.bronze_path)
    assert bronze.count() == 9
    assert bronze.where("user_id is null").count() == 1  # the broken line
    first = bronze.where("user_id = 'u1'").first()
    assert json.loads(first.ecommerce) == {"total": 1, "tags": ["a"]}
    assert (json.loads(first.geo), first["items"]) == ({"city": "é"}, '[{"item": 1}]')

    silver = spark.table(layout.silver_table)
    assert sorted(r.user_id for r in silver.collect()) == ["u3", "u4", "u5", "u7", "u8"]
    assert {r.source_file.rsplit("/", 1)[1] for r in silver.collect()} == {
        "a.json",
        "b.json",
        "c.json",
    }
    assert silver.where("receipt_time is null").count() == 0
    assert silver.select("receipt_time").distinct().count() == 3  # one time per batch

    expected = {("click", 2), ("view", 2), (None, 0)}
    assert gold_rows(spark, layout) == expected
    assert {tuple(r) for r in count_by(silver, "event_name", "n").collect()} == expected


def test_restart_adds_only_new_files(spark, source, layout):
    run_all(spark, source, layout)
    before = gold_rows(spark, layout)
    run_all(spark, source, layout)
    assert spark.read.parquet(layout.bronze_path).count() == 9
    assert gold_rows(spark, layout) == before
    put(source, "d.json", [event(9, "click", 3), event(10, "new", 4)])
    run_all(spark, source, layout)
    assert spark.read.parquet(layout.bronze_path).count() == 11
    assert read_table(spark, layout.silver_table).count() == 7
    assert gold_rows(spark, layout) == {("click", 3), ("view", 2), ("new", 1), (None, 0)}


def test_sql_sees_the_views(spark, source, layout):
    bronze_view(spark, str(source), layout)
    silver_view(spark, layout)
    names = spark.sql(f"select event_name from {layout.view('bronze_enhanced_temp')}")
    assert names.isStreaming
    rewritten = spark.sql(
        f"select user_id from {layout.view('bronze_temp')} where event_previous_timestamp > 0"
    )
    checkpoint = layout.checkpoint("sql")
    finish(append_to_table(rewritten, layout.silver_table, checkpoint, available_now=True))
    assert spark.table(layout.silver_table).count() == 5


def test_continuous_queries_become_ready_and_stop(spark, source, layout):
    query = start_bronze(bronze_view(spark, str(source), layout), layout, name="arrivals")
    assert query.name == "arrivals"
    wait_until_ready(query)
    assert query.lastProgress is not None
    assert [q.name for q in spark.streams.active] == ["arrivals"]
    stop_all(spark)
    assert spark.streams.active == []


def test_clean_up_removes_everything(spark, source, tmp_path):
    layout = create_layout(spark, "shop", str(tmp_path / "shop"))
    run_all(spark, source, layout)
    assert (tmp_path / "shop" / "bronze").exists()
    clean_up(spark, layout)
    assert not (tmp_path / "shop").exists()
    assert not spark.catalog.databaseExists("shop")
    assert source.exists()


def test_failing_query_raises_while_waiting(spark, source, tmp_path):
    broken = stream_json_lines(spark, str(source)).select(
        F.raise_error(F.concat(F.lit("bad "), F.coalesce("user_id", F.lit("-")))).alias("x")
    )
    query = append_to_files(
        broken.select(F.col("x").cast("string").alias("x")),
        str(tmp_path / "out"),
        str(tmp_path / "check"),
        interval=None,
    )
    with pytest.raises(Exception, match="bad "):
        wait_until_ready(query)
    stop_all(spark)


def test_waiting_has_an_end(spark, source, tmp_path):
    class Idle:
        lastProgress = None
        isActive = True

        def exception(self):
            return None

    with pytest.raises(TimeoutError):
        wait_until_ready(Idle(), timeout=0.2)


def test_whole_file_set_in_one_batch(spark, source, tmp_path):
    stream = stream_json_lines(spark, str(source), max_files_per_trigger=None)
    query = append_to_files(
        stream, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True
    )
    finish(query)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [9]


def test_stream_joined_with_reference(spark, source, tmp_path, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    stream = stream_json_lines(spark, str(source)).select("user_id", "event_name")
    reference = spark.createDataFrame(
        [("u1", "Ann"), ("u8", "Bo"), ("u8", "Bo2"), (None, "-")], "user_id string, name string"
    )
    joined = join_reference_data(stream, reference, "user_id")
    out = str(tmp_path / "out")
    finish(append_to_files(joined, out, str(tmp_path / "check"), available_now=True))
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == {
        ("u1", "click", "Ann"),
        ("u8", "click", "Bo"),
        ("u8", "click", "Bo2"),
    }


def test_hot_user_is_split_in_the_stream(spark, tmp_path, settings):
    settings(SMALL_SKEW)
    n, folder, out = 30000, str(tmp_path / "in"), str(tmp_path / "out")
    hot = F.when(F.col("id") < n // 3, F.lit(1)).otherwise(F.col("id")).cast("string")
    events = spark.range(0, n, 1, 6).select(
        hot.alias("user_id"), F.col("id").alias("event_timestamp")
    )
    events.write.json(folder)
    reference = spark.range(0, n, 1, 4).select(F.col("id").cast("string").alias("user_id"), "id")
    stream = stream_json_lines(spark, folder, max_files_per_trigger=None).select(*events.columns)
    joined = join_reference_data(stream, reference, "user_id")
    query = append_to_files(joined, out, str(tmp_path / "check"), available_now=True)
    finish(query)
    assert "skew=true" in plan_of(query)
    assert spark.read.parquet(out).where("user_id = id").count() == n


def test_unfinished_query_times_out(spark, source, layout):
    query = start_bronze(bronze_view(spark, str(source), layout), layout)
    with pytest.raises(TimeoutError):
        finish(query, timeout=0.5)


def test_complete_table_holds_the_last_state(spark, tmp_path, database):
    """The table holds the aggregate only, not one copy per batch."""
    folder = tmp_path / "in"
    put(folder, "a.json", [event(1, "click", 1)])
    put(folder, "b.json", [event(2, "click", 1)])
    counts = count_by(stream_json_lines(spark, str(folder)), "event_name", "n")
    table, path = f"{database}.counts", str(tmp_path / "counts")
    finish(replace_table(counts, table, path, str(tmp_path / "check"), available_now=True))
    assert [tuple(r) for r in spark.table(table).collect()] == [("click", 2)]


def test_readers_always_meet_a_whole_table(spark, tmp_path, database):
    folder, batches = tmp_path / "in", 7
    for i in range(batches):
        put(folder, f"{i}.json", [event(i, name, 1) for name in ("click", "view")])
    counts = count_by(stream_json_lines(spark, str(folder)), "event_name", "n")
    table, path = f"{database}.counts", str(tmp_path / "counts")
    query = replace_table(counts, table, path, str(tmp_path / "check"), available_now=True)
    seen = []
    while query.isActive:
        if spark.catalog.tableExists(table):
            seen.append(sorted(r.n for r in read_table(spark, table).collect()))
    finish(query)
    assert all(low == high and low > 0 for low, high in seen)
    assert seen == sorted(seen)
    assert {tuple(r) for r in read_table(spark, table).collect()} == {
        ("click", batches),
        ("view", batches),
    }


def test_every_batch_has_a_folder_of_its_own(spark, tmp_path, database):
    """A reader of any former version, and a repeated batch, meet files that nobody changes."""
    folder = tmp_path / "in"
    for i in range(12):
        put(folder, f"{i}.json", [event(i, "click", 1)])
    counts = count_by(stream_json_lines(spark, str(folder)), "event_name", "n")
    table, path, check = f"{database}.counts", tmp_path / "counts", tmp_path / "check"
    finish(replace_table(counts, table, str(path), str(check), available_now=True))
    folders = {p.name for p in path.iterdir()}
    assert len(folders) == 12
    first = next(p for p in path.iterdir() if p.name.startswith("version=0-"))
    early = spark.read.parquet(str(first))
    assert [tuple(r) for r in early.collect()] == [("click", 1)]

    # The last batch is published, but its commit is lost: it is repeated beside the live one.
    live = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    for file in (check / "commits").glob("*11*"):
        file.unlink()
    finish(replace_table(counts, table, str(path), str(check), available_now=True))
    assert {f: f.stat().st_mtime_ns for f in live} == live
    assert sum(p.name.startswith("version=11-") for p in path.iterdir()) == 2
    assert [tuple(r) for r in read_table(spark, table).collect()] == [("click", 12)]
    assert [tuple(r) for r in early.collect()] == [("click", 1)]

    drop_versions(spark, table, str(path), keep=2)
    assert len(list(path.iterdir())) == 2
    assert [tuple(r) for r in read_table(spark, table).collect()] == [("click", 12)]
    with pytest.raises(ValueError):
        drop_versions(spark, table, str(path), keep=0)


def test_clean_up_leaves_other_pipelines_running(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "0.json", [event(1, "click", 1)])
    layouts = [create_layout(spark, f"pipeline_{i}", str(tmp_path / f"p{i}"), f"p{i}_") for i in (1, 2)]
    queries = [start_bronze(bronze_view(spark, str(folder), layout), layout) for layout in layouts]
    try:
        clean_up(spark, layouts[0])
        assert [query.isActive for query in queries] == [False, True]
    finally:
        clean_up(spark, layouts[1])
    assert not queries[1].isActive


def test_audit_needs_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(4).write.parquet(path)
    rows = spark.read.parquet(path)
    found = with_audit_columns(rows.where("id > 1")).collect()
    assert len(found) == 2 and all(r.source_file.endswith(".parquet") for r in found)
    with pytest.raises(AnalysisException):
        with_audit_columns(rows.groupBy("id").count())
