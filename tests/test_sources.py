import json
import random

import pytest

from promptloom.sources.configs import read_config, read_configs
from promptloom.sources.datasets import read_dataset, read_json
from promptloom.sources.requests import read_requests, rejected_requests, valid_requests, with_rejection

RECORDS = [{"input": "a", "n": 1}, {"input": "b [", "n": 2}, {"input": "c }", "n": None}]
LAYOUTS = {
    "lines": "\n".join(json.dumps(r) for r in RECORDS) + "\n",
    "lines_after_blank": "\n\n" + "\n".join("  " + json.dumps(r) for r in RECORDS),
    "array_on_one_line": json.dumps(RECORDS),
    "pretty_array": json.dumps(RECORDS, indent=2),
    "array_of_lines": "[\n" + ",\n".join(json.dumps(r) for r in RECORDS) + "\n]",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_json_layouts(spark, tmp_path, layout):
    (tmp_path / "data.json").write_text(LAYOUTS[layout])
    df = read_json(spark, str(tmp_path / "data.json"))
    assert sorted((r.input, r.n) for r in df.collect()) == [(r["input"], r["n"]) for r in RECORDS]


def test_single_pretty_object(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(RECORDS[0], indent=1))
    assert [r.input for r in read_json(spark, str(tmp_path / "one.json")).collect()] == ["a"]


def test_a_broken_first_line_raises(spark, tmp_path):
    lines = [json.dumps({"input": str(i), "n": i}) for i in range(100)]
    (tmp_path / "cut.json").write_text("\n".join([lines[0][4:], *lines[1:]]))
    with pytest.raises(ValueError, match="neither JSON Lines nor one JSON document"):
        read_json(spark, str(tmp_path / "cut.json"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_json(spark, str(tmp_path / "cut.json"), "input string, n int", "lines").collect()


@pytest.mark.parametrize("text", ['{"n": 1}{"n": 2}', '{"n": 1}\n{"n": 2},\n{"n": 3}', '[{"n": 1}]\n[{"n": 2}\n]', '{"n": 1}\n7'])
def test_records_that_would_be_lost_raise(spark, tmp_path, text):
    (tmp_path / "odd.json").write_text(text)
    with pytest.raises(ValueError, match="neither"):
        read_json(spark, str(tmp_path / "odd.json"))


def test_one_array_on_each_line(spark, tmp_path):
    (tmp_path / "arrays.json").write_text("\n".join(json.dumps([{"n": i}, {"n": -i}]) for i in range(1, 51)))
    assert sorted(r.n for r in read_json(spark, str(tmp_path / "arrays.json")).collect()) == sorted([*range(1, 51), *range(-50, 0)])


def test_layouts_in_one_folder(spark, tmp_path):
    (tmp_path / "a b.json").write_text(json.dumps([{"n": i, "kind": "pretty"} for i in range(2000)], indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"n": i}) for i in range(2000, 2100)))
    (tmp_path / "empty.json").write_text("")
    df = read_json(spark, str(tmp_path))
    assert sorted(r.n for r in df.collect()) == list(range(2100))
    assert df.filter("kind = 'pretty'").count() == 2000


def test_layouts_in_partitions(spark, tmp_path):
    for split, text in (("train", '[\n{"n": 1},\n{"n": 2}\n]'), ("test", '{"n": 3}\n{"n": 4}')):
        (tmp_path / f"split={split}").mkdir()
        (tmp_path / f"split={split}" / "part.json").write_text(text)
    rows = read_json(spark, str(tmp_path)).collect()
    assert sorted((r.split, r.n) for r in rows) == [("test", 3), ("test", 4), ("train", 1), ("train", 2)]


@pytest.fixture
def small_partitions(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def odd_records(count, seed=1):
    rnd = random.Random(seed)
    parts = ['"', "\\", "},", "{", "}", "[", "]", ",", "x", " ", "\n", "é", "\\\"", "日本", "end},"]
    text = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
    return [
        {"n": i, "text": text(), "list": [text() for _ in range(rnd.randint(0, 3))], "in": {"a": text(), "b": {"c": text()}}}
        for i in range(count)
    ]


def as_dicts(df):
    return sorted((row.asDict(recursive=True) for row in df.collect()), key=lambda r: r["n"])


@pytest.mark.parametrize("form", [{"indent": 2}, {}, {"separators": (",", ":")}, {"indent": 1, "ensure_ascii": False}])
@pytest.mark.parametrize("layout", [None, "document"])
def test_large_array_is_cut_into_elements(spark, tmp_path, small_partitions, form, layout):
    records = odd_records(200)
    text = json.dumps(records, **form)
    # White space before a comma keeps two elements in one line; around the array it is left out.
    (tmp_path / "large.json").write_text("\ufeff"[:0] + "\n " + text.replace('}, {"n": 50', '} , {"n": 50') + " \n\n", encoding="utf-8")
    df = read_json(spark, str(tmp_path / "large.json"), layout=layout, cut=True)
    assert as_dicts(df) == records
    if "indent" in form:
        assert df.rdd.getNumPartitions() > 1
    typed = read_json(spark, str(tmp_path / "large.json"), "n int, text string", layout, cut=True)
    assert [(r["n"], r["text"]) for r in as_dicts(typed)] == [(r["n"], r["text"]) for r in records]


def test_large_arrays_among_other_files(spark, tmp_path, small_partitions):
    records = odd_records(300, 2)
    for split, part in (("train", records[:150]), ("test", records[150:299])):
        (tmp_path / f"split={split}").mkdir()
        (tmp_path / f"split={split}" / "a b.json").write_text(json.dumps(part, indent=1))
    (tmp_path / "split=test" / "one.json").write_text(json.dumps(records[299:], indent=1)[:-1] + "]")
    (tmp_path / "split=test" / "lines.json").write_text('{"n": 1000}\n{"n": 1001}')
    rows = {r.n: r.split for r in read_json(spark, str(tmp_path), cut=True).collect()}
    assert rows == {r["n"]: "train" if r["n"] < 150 else "test" for r in records} | {1000: "test", 1001: "test"}


def test_large_object_is_one_row(spark, tmp_path, small_partitions):
    (tmp_path / "one.json").write_text(json.dumps({"n": 1, "rows": odd_records(20)}, indent=1))
    assert len(read_json(spark, str(tmp_path / "one.json"), cut=True).first()["rows"]) == 20


@pytest.mark.parametrize(
    "spoil",
    [
        lambda t: t[: t.rindex("]")],
        lambda t: t + "]",
        lambda t: t[: t.rindex("}")] + "]",
        lambda t: t.rstrip()[:-1].rstrip() + ",\n]",
        lambda t: t.replace('"n": 100,', '"n" 100,'),
        lambda t: t.replace('"n": 100,', '"n": 100 "m": 1,'),
        lambda t: t.replace('"n": 100,', '"n": "100,'),
        lambda t: t + "\n" + t,
        lambda t: t + " 7",
        lambda t: t + ", " + t,
        lambda t: t.replace("},", "}] 7, [", 1),
        lambda t: t.replace("},", "},,", 1),
    ],
)
@pytest.mark.parametrize("layout", [None, "document"])
def test_broken_large_arrays_raise(spark, tmp_path, small_partitions, spoil, layout):
    records = [{"n": i, "text": "some text of the record"} for i in range(200)]
    (tmp_path / "broken.json").write_text(spoil(json.dumps(records, indent=1)))
    with pytest.raises(Exception, match="neither|MALFORMED|Malformed|comma|more than one"):
        read_json(spark, str(tmp_path / "broken.json"), "n int, text string", layout, cut=True).collect()


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown layout"):
        read_json(spark, str(tmp_path), layout="csv")


def test_dataset_from_folder(spark, tmp_path):
    (tmp_path / "org").mkdir()
    (tmp_path / "org" / "d.json").write_text(LAYOUTS["lines"])
    assert read_dataset(spark, "org/d.json", folder=str(tmp_path)).count() == 3
    # A single file is whatever split is asked for.
    assert read_dataset(spark, "org/d.json", "test", str(tmp_path)).count() == 3
    assert read_dataset(spark, "org/d.json", folder=str(tmp_path), schema="input string").columns == ["input"]


def test_missing_and_empty_datasets(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, "none.json", folder=str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, "none.json", folder=str(tmp_path / "no-folder"))
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError, match="empty"):
        read_dataset(spark, "empty.json", folder=str(tmp_path), schema="input string")


def test_splits_prune_directories(spark, tmp_path):
    rows = spark.createDataFrame([("a", "train"), ("b", "eval"), ("c", "eval")], "input string, split string")
    rows.write.partitionBy("split").json(str(tmp_path / "parts"))
    df = read_dataset(spark, "parts", "eval", str(tmp_path))
    assert sorted(r.input for r in df.collect()) == ["b", "c"]
    assert len(df.inputFiles()) >= 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert [r.input for r in read_dataset(spark, "parts", None, str(tmp_path)).collect()] == ["a"]
    with pytest.raises(ValueError, match="empty"):
        read_dataset(spark, "parts", "other", str(tmp_path))


def test_catalog_table_comes_first(spark, tmp_path):
    spark.createDataFrame([("from table", "train")], "input string, split string").write.mode("overwrite").saveAsTable(
        "named_dataset"
    )
    (tmp_path / "named_dataset").write_text('{"input": "from file"}')
    assert read_dataset(spark, "named_dataset", folder=str(tmp_path)).first()["input"] == "from table"
    spark.sql("DROP TABLE named_dataset")
    assert read_dataset(spark, "named_dataset", folder=str(tmp_path)).first()["input"] == "from file"


def test_other_table_failures_are_not_hidden(spark, tmp_path):
    spark.sql("CREATE OR REPLACE VIEW broken_view AS SELECT raise_error('cannot read') AS input")
    (tmp_path / "broken_view").write_text('{"input": "from file"}')
    with pytest.raises(Exception, match="cannot read"):
        read_dataset(spark, "broken_view", folder=str(tmp_path)).collect()
    spark.sql("DROP VIEW broken_view")


@pytest.fixture
def configs(tmp_path):
    def write(path, content):
        file = tmp_path / "extras" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
        return str(tmp_path / "extras")

    return write


def test_configs(spark, configs):
    configs("d.json/short.json", {"name": "short", "instruction": "Be brief.", "extra": 5, "chat_template": None})
    folder = configs("org/my data/a+b.json", {"name": "ab", "text_format": "{input}", "dataset_format": "text"})
    rows = {r.dataset_name: r.asDict() for r in read_configs(spark, folder).collect()}
    assert set(rows) == {"d.json", "org/my data"}
    assert rows["d.json"]["dataset_config"] == "short" and rows["d.json"]["instruction"] == "Be brief."
    assert rows["org/my data"]["text_format"] == "{input}" and rows["org/my data"]["instruction"] is None
    one = read_config(spark, "d.json", "short", folder)
    assert one == {"dataset_config": "short", "instruction": "Be brief.", "extra": "5", "chat_template": None}
    assert read_config(spark, "d.json", "short.json", folder) == one
    assert read_config(spark, "d.json", None, folder) is None and read_config(spark, "d.json", "", folder) is None
    with pytest.raises(FileNotFoundError):
        read_config(spark, "d.json", "other", folder)


@pytest.mark.parametrize("content, problem", [("{not json", "JSON object"), ('{"instruction": "x"}', "name")])
def test_broken_config(spark, configs, content, problem):
    folder = configs("d/bad.json", content)
    with pytest.raises(ValueError, match=problem):
        read_config(spark, "d", "bad", folder)
    with pytest.raises(ValueError, match=problem):
        read_configs(spark, folder)


def test_empty_config_has_nothing(spark, configs):
    assert read_config(spark, "d", "nothing", configs("d/nothing.json", {})) == {}


def test_requests(spark, tmp_path):
    bodies = [
        '{"task_id": "a", "prompts": ["x", "y"], "sampling_params": {"max_tokens": 5, "stop": ["."], "b": true}}',
        '{"task_id": "b", "prompts": []}',
        '{"task_id": "c"}',
        '{"task_id": "d", "prompts": ["x", null]}',
        '{"prompts": ["x"]}',
        "not json",
        '{"task_id": "e", "prompts": ["x"], "prompts_params": {"instruction": "I", "other": 1}}',
        '{"task_id": "f", "prompts": ["x"], "sampling_params": {"seed": 1, "seed": 2}}',
    ]
    (tmp_path / "requests.json").write_text("\n".join(bodies))
    checked = with_rejection(read_requests(spark, str(tmp_path)))
    valid = {r.task_id: r for r in valid_requests(checked).collect()}
    assert set(valid) == {"a", "b", "e", "f"}
    assert valid["a"].sampling_params == {"max_tokens": "5", "stop": '["."]', "b": "true"}
    assert valid["b"].sampling_params == {} and valid["b"].prompts_params is None
    assert valid["e"].prompts_params.instruction == "I"
    assert valid["a"].queued_at == pytest.approx((tmp_path / "requests.json").stat().st_mtime, abs=0.01)
    rejected = {r.task_id or r._corrupt_record or "": r.reason for r in rejected_requests(checked).collect()}
    assert rejected == {
        "c": "Field required: prompts",
        "d": "Prompts must be strings",
        "": "Field required: task_id",
        "not json": "Malformed request",
    }


def test_one_request_per_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps({"task_id": name, "prompts": ["x"]}, indent=2))
    got = read_requests(spark, str(tmp_path), one_per_file=True).select("task_id").orderBy("task_id").collect()
    assert [r.task_id for r in got] == ["a", "b"]
