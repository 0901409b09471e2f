import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from promptloom.operators.records import lineage_record, observed, param_rows, profile, route_params, sample_row
from promptloom.schemas import LINEAGE
from promptloom.sinks.completions import save_completions, save_task_completions
from promptloom.sinks.task_table import (
    compact_task_table,
    export_tasks,
    read_task_table,
    task_completions,
    task_files,
    write_task_batch,
)
from promptloom.sinks.records import append_lineage, append_params


def lines(path):
    return [json.loads(line) for file in sorted(path.glob("part-*")) for line in file.read_text().splitlines()]


def test_completions_keep_null_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "c")], "input string, inference string")
    path = save_completions(df.coalesce(1), "run", str(tmp_path))
    assert path == f"{tmp_path}/run.json"
    assert lines(tmp_path / "run.json") == [{"input": "a", "inference": None}, {"input": "b", "inference": "c"}]
    assert save_completions(df, "run.json", str(tmp_path)) == path
    assert re.search(r"/completions_\d{8}-\d{6}\.json$", save_completions(df, folder=str(tmp_path)))


def test_task_completions(spark, tmp_path):
    schema = "task_id string, status string, completions array<string>, error string"
    rows = [("a", "done", ["x", None], None), ("b", "error", None, "no"), ("c", "done", [], None)]
    tasks = spark.createDataFrame(rows, schema)
    assert not save_task_completions(tasks, str(tmp_path / "absent"))
    assert not (tmp_path / "absent").exists()
    assert save_task_completions(tasks, str(tmp_path))
    # A batch that runs again replaces its own tasks and leaves the others.
    assert save_task_completions(tasks.filter("task_id = 'a'"), str(tmp_path))
    assert {p.name for p in tmp_path.iterdir() if p.is_dir()} == {"task_id=a", "task_id=c"}
    assert lines(tmp_path / "task_id=a") == [{"completions": ["x", None]}]
    assert lines(tmp_path / "task_id=c") == [{"completions": []}]


TASKS = "task_id string, status string, completions array<string>, error string"


def task_rows(numbers, word):
    return [(f"t{i:04}", "done", [f"{word}{i}", None], None) for i in numbers]


def test_task_table(spark, tmp_path):
    table = str(tmp_path / "a table")
    first = spark.createDataFrame([*task_rows(range(1000), "a"), ("failed", "error", None, "no")], TASKS).repartition(5)
    second = spark.createDataFrame(task_rows(range(900, 1500), "b"), TASKS).repartition(3)
    write_task_batch(first, table, 0, tasks_per_file=300)
    for _ in range(2):  # a batch that runs again leaves one copy
        write_task_batch(second, table, 1, tasks_per_file=300)
    assert spark.read.parquet(f"{table}/completions").count() == 1600
    got = {r.task_id: r.completions for r in read_task_table(spark, table).collect()}
    assert got == {f"t{i:04}": [f"{'a' if i < 900 else 'b'}{i}", None] for i in range(1500)}
    # Ranges of a batch do not overlap, so that a lookup opens one file of it.
    assert [len(task_files(spark, table, t)) for t in ("t0100", "t0950", "t1400", "x", "failed")] == [1, 2, 1, 0, 0]
    assert task_completions(spark, table, "t0950") == ["b950", None] and task_completions(spark, table, "t0003")[0] == "a3"
    for absent in ("failed", "t0003x", "zz"):
        with pytest.raises(KeyError, match=absent):
            task_completions(spark, table, absent)

    compact = str(tmp_path / "compact")
    compact_task_table(spark, table, compact, tasks_per_file=400)
    assert [len(task_files(spark, compact, t)) for t in ("t0100", "t0950", "t1400")] == [1, 1, 1]
    assert task_completions(spark, compact, "t0950") == ["b950", None]
    assert {r.task_id: r.completions for r in read_task_table(spark, compact).collect()} == got


def test_task_table_lookup_leaves_row_groups_out(spark, tmp_path):
    table = str(tmp_path / "table")
    write_task_batch(spark.createDataFrame(task_rows(range(2000), "a"), TASKS), table, 0)
    file = task_files(spark, table, "t0005")[0]
    plan = spark.read.parquet(file).filter(F.col("task_id") == "t0005")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(task_id,t0005)" in plan
    # An id within the range, but in no row group's Bloom filter: no row reaches Spark.
    metadata = pq.ParquetFile(file.removeprefix("file:")).metadata
    assert metadata.row_group(0).num_rows == 2000
    with pytest.raises(KeyError):
        task_completions(spark, table, "t0005x")


def test_empty_task_table(spark, tmp_path):
    table = str(tmp_path / "table")
    write_task_batch(spark.createDataFrame([("failed", "error", None, "no")], TASKS), table, 0)
    assert read_task_table(spark, table).collect() == [] and task_files(spark, table, "failed") == []
    compact_task_table(spark, table, str(tmp_path / "compact"))
    assert read_task_table(spark, str(tmp_path / "compact")).collect() == []


def test_exported_tasks(spark, tmp_path):
    table, folder = str(tmp_path / "table"), tmp_path / "folder"
    write_task_batch(spark.createDataFrame(task_rows(range(50), "a"), TASKS), table, 0)
    chosen = spark.createDataFrame([("t0003",), ("t0003",), ("t0049",), ("absent",)], "task_id string")
    assert not export_tasks(chosen, table, str(folder))
    folder.mkdir()
    assert export_tasks(chosen, table, str(folder))
    assert {p.name for p in folder.iterdir() if p.is_dir()} == {"task_id=t0003", "task_id=t0049"}
    assert lines(folder / "task_id=t0003") == [{"completions": ["a3", None]}]


def test_lineage(spark, tmp_path):
    stored = lineage_record(spark, "org/My Data:1.json", 3, "struct<a:int>", "train")
    assert stored.dtypes == spark.createDataFrame([], LINEAGE).dtypes
    assert stored.first().asDict() == {
        "name": "my-data-1.json",
        "split": "train",
        "source_type": "storage",
        "source": "datasets/org/My Data:1.json",
        "commit_hash": None,
        "num_rows": 3,
        "schema": "struct<a:int>",
    }
    hub = lineage_record(spark, "org/d", 1, "", checksum_urls=["hf://datasets/org/d@abc/f.json", "hf://x@def/g"])
    assert hub.first()["source_type"] == "hub" and hub.first()["commit_hash"] == "abc" and hub.first()["source"] == "org/d"
    for record in (stored, hub):
        append_lineage(record, str(tmp_path / "lineage"))
    assert spark.read.parquet(str(tmp_path / "lineage")).count() == 2


def test_param_routes(spark, tmp_path):
    params = {"short": "x" * 249, "limit": "x" * 250, "long": "é" * 251, "number": 5, "none": None}
    routed = route_params(param_rows(spark, params))
    assert {r.key: r.route for r in routed.collect()} == {
        "short": "param", "limit": "text", "long": "text", "number": "param", "none": "param",
    }
    append_params(routed, str(tmp_path / "params"))
    assert {p.name for p in (tmp_path / "params").iterdir() if p.is_dir()} == {"route=param", "route=text"}
    assert route_params(param_rows(spark, {})).count() == route_params(param_rows(spark, None)).count() == 0


def test_profile_and_observation(spark):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    assert profile(df).first()["num_rows"] == 10
    assert {r.part: r.num_rows for r in profile(df, "part").collect()} == {0: 5, 1: 5}
    assert sample_row(df) == {"id": 0, "part": 0} and sample_row(df.filter("id < 0")) is None
    watched, counts = observed(df.filter("id < 7"))
    watched.write.format("noop").mode("overwrite").save()
    assert counts.get["num_rows"] == 7
