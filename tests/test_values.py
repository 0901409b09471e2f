import datetime
import math

import pytest
from pyspark.sql import functions as F

from promptloom.functions.values import commit_hash, sanitized_name, stripped
from promptloom.operators.inference import input_prompts, with_completions


def printed(spark, values, data_type):
    df = spark.createDataFrame([(v,) for v in values], f"input {data_type}")
    return [r.prompt for r in input_prompts(df).collect()]


def test_text_of_scalars(spark):
    assert printed(spark, ["x", "", None], "string") == ["x", "", "None"]
    assert printed(spark, [1, -5, None], "bigint") == ["1", "-5", "nan"]
    assert printed(spark, [True, False, None], "boolean") == ["True", "False", "None"]
    assert printed(spark, [datetime.date(2024, 1, 31)], "date") == ["2024-01-31"]


def test_text_of_doubles(spark):
    doubles = [0.0, -0.0, 1.0, -1.5, 0.1, 1e-4, 1.5e-5, 123456.789, 9999999.0, 1e7, 12345678.5, 1e15, 1e16, 1.5e20]
    doubles += [-2.5e-7, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    assert printed(spark, [*doubles, None], "double") == [repr(d) for d in doubles] + ["nan"]


@pytest.mark.parametrize("data_type", ["array<string>", "map<string, string>", "struct<a: int>", "binary"])
def test_nested_values_are_rejected(spark, data_type):
    with pytest.raises(ValueError, match="cannot be used as prompt text"):
        input_prompts(spark.createDataFrame([], f"input {data_type}"))


def test_missing_input_column(spark):
    with pytest.raises(ValueError, match="question"):
        input_prompts(spark.createDataFrame([("x",)], "input string"), "question")


def test_output_column_is_replaced_in_place(spark, caplog):
    df = spark.createDataFrame([("a", "old", "z")], "input string, inference string, other string")
    result = with_completions(df, F.lit("new"))
    assert result.columns == df.columns and result.first()["inference"] == "new"
    assert "Replacing the values of column 'inference'" in caplog.text


def test_stripped_is_python_strip(evaluate):
    texts = ["  x \x1c", "\x85x　y ", "", "​x"]
    assert evaluate([(t,) for t in texts], "t string", stripped(F.col("t"))) == [t.strip() for t in texts]


def test_names(evaluate):
    names = ["org/My Model:1.2", "plain", "a/b/", "UP.Case"]
    rows = [(n,) for n in names]
    assert evaluate(rows, "n string", sanitized_name(F.col("n"))) == ["my-model-1.2", "plain", "", "up.case"]
    assert evaluate(rows, "n string", sanitized_name(F.col("n"), True)) == ["my-model-1-2", "plain", "", "up-case"]


def test_commit_hash(evaluate):
    urls = ["hf://d/x@abc123/f.json", "hf://d/x@abc", "no-revision/f", None, "a@b@c/d"]
    assert evaluate([(u,) for u in urls], "u string", commit_hash(F.col("u"))) == ["abc123", "abc", None, None, "b"]
