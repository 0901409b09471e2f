import os
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from promptloom.constants import BATCH_SAMPLING, SERVICE_SAMPLING
from stand_ins import DIGEST, SAMPLED
from promptloom.operators.generation import (
    Engine,
    batch_sampling,
    complete,
    completion,
    first_candidate,
    request_sampling,
)
from promptloom.plans.inference import complete_dataset


def engine_of(name, function):
    return Engine(name, lambda: function)


def test_completions_stay_with_their_prompts(spark):
    df = spark.range(5000, numPartitions=7).withColumn("input", F.col("id").cast("string"))
    got = df.select("id", completion(F.col("input"), DIGEST).alias("c")).collect()
    assert {r.id: r.c for r in got} == {i: "gen:" + md5(str(i).encode()).hexdigest() for i in range(5000)}


def test_dataset_keeps_its_columns(spark):
    df = spark.createDataFrame([("kept", "q", "old")], "prompt string, question string, answer string")
    config = {"dataset_format": "text", "text_format": "{input}"}
    result = complete_dataset(df, DIGEST, config, input_column="question", output_column="answer")
    assert result.columns == df.columns
    assert tuple(result.first()) == ("kept", "q", "gen:" + md5(b"q").hexdigest())


def test_sampling_defaults(spark):
    assert batch_sampling() == {"seed": "0", "temperature": "0", "max_tokens": "2048", "skip_special_tokens": "true"}
    assert batch_sampling(max_tokens=7, stop=["."])["max_tokens"] == "7"
    assert BATCH_SAMPLING["max_tokens"] == "2048" and SERVICE_SAMPLING["max_tokens"] == "1024"
    echo = engine_of("echo sampling", lambda prompts, sampling: [repr(sorted(sampling.items())) for _ in prompts])
    df = spark.createDataFrame([("x",)], "p string")
    got = df.select(completion(F.col("p"), echo, batch_sampling(top_p=0.5, stop=["."], note="plain"))).first()[0]
    assert eval(got) == [
        ("max_tokens", 2048), ("note", "plain"), ("seed", 0), ("skip_special_tokens", True), ("stop", ["."]),
        ("temperature", 0), ("top_p", 0.5),
    ]


def test_request_sampling_user_wins(spark):
    users = [None, {}, {"a": "9"}, {"a": None, "z": "1"}]
    df = spark.createDataFrame([(u,) for u in users], "user map<string, string>")
    got = [r[0] for r in df.select(request_sampling(F.col("user"), {"a": "1", "b": F.lit(2)})).collect()]
    assert got == [{"a": "1", "b": "2"} | (u or {}) for u in users]


def test_sampling_by_row(spark):
    rows = [("x", f'{{"max_tokens": "{i % 3}"}}') for i in range(30)]
    df = spark.createDataFrame(rows, "p string, s string")
    got = [r[0] for r in df.select(completion(F.col("p"), SAMPLED, F.col("s"))).collect()]
    assert got == [f"{i % 3}:{md5(b'x').hexdigest()}" for i in range(30)]


def fails_on_bad(prompts, sampling):
    if any("bad" in p for p in prompts):
        raise RuntimeError("cannot: " + next(p for p in prompts if "bad" in p))
    return [p.upper() for p in prompts]


def test_failures_fail_the_job_unless_captured(spark):
    engine = engine_of("fails on bad", fails_on_bad)
    rows = [(i, f"p{i}" if i % 7 else f"bad{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, p string").coalesce(1)
    with pytest.raises(Exception, match="cannot: bad0"):
        df.select(completion(F.col("p"), engine)).collect()
    got = df.select("p", complete(F.col("p"), engine, capture_errors=True).alias("a")).collect()
    for p, answer in got:
        if "bad" in p:
            assert answer.error == f"cannot: {p}" and answer.outputs is None
        else:
            assert answer.error is None and answer.outputs[0].text == p.upper()


def test_engine_may_fail_single_prompts(spark):
    calls = []

    def generate(prompts, sampling):
        calls.append(len(prompts))
        if len(calls) > 1:
            raise RuntimeError("called again")
        return [ValueError(f"no {p}") if p == "b" else p for p in prompts]

    engine = engine_of("single failures", generate)
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "p string").coalesce(1)
    got = [r[0] for r in df.select(complete(F.col("p"), engine, capture_errors=True)).collect()]
    assert [a.error for a in got] == [None, "no b", None]
    with pytest.raises(Exception, match="no b"):
        df.select(completion(F.col("p"), engine_of("single failure", generate))).collect()


def test_null_prompts_and_wrong_counts(spark):
    df = spark.createDataFrame([(None,), ("x",)], "p string").coalesce(1)
    with pytest.raises(Exception, match="No prompt to complete"):
        df.select(completion(F.col("p"), DIGEST)).collect()
    got = [r[0] for r in df.select(complete(F.col("p"), DIGEST, capture_errors=True)).collect()]
    assert got[0].error == "No prompt to complete" and got[1].error is None
    short = engine_of("too few", lambda prompts, sampling: ["only one"])
    three = spark.createDataFrame([("x",)] * 3, "p string").coalesce(1)
    with pytest.raises(Exception, match="The engine gave 1 outputs for 3 prompts"):
        three.select(completion(F.col("p"), short)).collect()


def test_first_candidate(spark):
    many = engine_of("candidates", lambda prompts, sampling: [[p + "1", p + "2"] if p else [] for p in prompts])
    df = spark.createDataFrame([("x",), ("",)], "p string")
    outputs = df.select(complete(F.col("p"), many)["outputs"].alias("o"))
    assert [[o.text for o in r.o] for r in outputs.collect()] == [["x1", "x2"], []]
    assert [r[0] for r in outputs.select(first_candidate(F.col("o"))).collect()] == ["x1", None]


def test_engine_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(f"{folder}/{os.getpid()}", "a") as file:
            file.write("loaded\n")
        return lambda prompts, sampling: list(prompts)

    engine = Engine("loads once", load)
    df = spark.range(64, numPartitions=64).select(completion(F.col("id").cast("string"), engine).alias("c"))
    assert df.agg(F.count_distinct("c")).first()[0] == 64
    loads = [file.read_text().count("loaded") for file in tmp_path.iterdir()]
    assert loads and set(loads) == {1}
