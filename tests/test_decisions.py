import pytest
from pyspark.sql import functions as F

from promptloom.constants import CONFIG_KEYS
from promptloom.functions.decisions import is_conversational, resolved_format, resolved_instruction
from promptloom.operators.configs import attach_config, merge_config
from promptloom.operators.inference import format_prompts, format_prompts_by_row, input_prompts
from promptloom.operators.training import construct_prompts, construct_prompts_by_row
from promptloom.schemas import CONFIG


def test_format_decision(evaluate):
    templates = (None, "", "chatml")
    rows = [(f, t) for f in (None, "auto", "text", "conversational", "other") for t in templates]
    got = evaluate(rows, "f string, t string", is_conversational(F.col("f"), F.col("t")))
    assert got == [f == "conversational" or (f != "text" and t is not None) for f, t in rows]


def test_config_format_beats_the_argument(evaluate):
    rows = [(None,), ("",), ("auto",)]
    assert evaluate(rows, "f string", resolved_format(F.col("f"), "text")) == ["text", "text", "auto"]
    assert evaluate(rows, "f string", resolved_format(F.col("f"), None)) == [None, None, "auto"]
    assert merge_config(None) == {}
    assert merge_config(None, "text") == {"dataset_format": "text"}
    assert merge_config({"dataset_format": "auto"}, "text") == {"dataset_format": "auto"}
    assert merge_config({"dataset_format": "", "instruction": "x"}, "text") == {
        "dataset_format": "text",
        "instruction": "x",
    }


def test_instruction_precedence(evaluate):
    rows = [(c, r) for c in (None, "", "C") for r in (None, "R")]
    got = evaluate(rows, "c string, r string", resolved_instruction(F.col("c"), F.col("r"), "D"))
    assert got == [c or r or "D" for c, r in rows]


@pytest.fixture
def example(spark):
    return spark.createDataFrame([("R", "I", "C")], "instruction string, input string, completion string")


def test_training_chat_uses_config_then_row_then_none(spark, example):
    def system(df, instruction):
        messages = construct_prompts(df, instruction, conversational=True).first()["messages"]
        return [m.content for m in messages if m.role == "system"]

    assert system(example, "X") == ["X"]
    assert system(example, None) == system(example, "") == ["R"]
    assert system(example.drop("instruction"), None) == []
    assert system(example.withColumn("instruction", F.lit("")), None) == []


def test_training_text_ignores_the_row(example):
    assert construct_prompts(example).columns == ["text"]
    assert construct_prompts(example).first()["text"].startswith("### Instruction:\nYou are an helpful assistant.\n\n")
    assert construct_prompts(example, "X", "{instruction}|{input}|{response}").first()["text"] == "X|I|C"
    assert construct_prompts(example, "", "").first()["text"] == construct_prompts(example).first()["text"]


def test_training_text_of_numbers(spark):
    df = spark.createDataFrame([(1, 0.5), (None, None)], "input bigint, completion double")
    assert [r.text for r in construct_prompts(df, None, "{input}/{response}").collect()] == ["1/0.5", "None/None"]


def test_training_needs_its_columns(example):
    for column in ("input", "completion"):
        with pytest.raises(ValueError, match=column):
            construct_prompts(example.drop(column))


def prompt_of(example, config=None, model_template=None):
    return format_prompts(input_prompts(example), config, model_template).first()["prompt"]


def test_batch_inference_text(example):
    assert prompt_of(example) == "### Instruction:\n\n\n### Input:\nI\n\n### Response:\n"
    assert prompt_of(example, {"instruction": None, "text_format": ""}) == prompt_of(example)
    assert prompt_of(example, {"instruction": "X", "text_format": "{instruction}/{input}/{response}"}) == "X/I/"
    assert prompt_of(example, {"dataset_format": "text"}, "chatml") == prompt_of(example)


def test_batch_inference_chat(example):
    plain = "<|im_start|>user\nI<|im_end|>\n<|im_start|>assistant\n"
    assert prompt_of(example, None, "chatml") == plain
    assert prompt_of(example, {"dataset_format": "conversational"}) == plain
    assert prompt_of(example, {"instruction": "X"}, "chatml") == "<|im_start|>system\nX<|im_end|>\n" + plain
    # The configured template replaces the model's and alone makes the format chat.
    assert prompt_of(example, {"chat_template": "extraction"}, "chatml").endswith("I\n<|im_end|>\n<|im_start|>assistant")
    assert prompt_of(example, {"chat_template": "extraction"}) == prompt_of(example, {"chat_template": "extraction"}, "chatml")
    with pytest.raises(ValueError, match="Unknown chat layout"):
        prompt_of(example, {"chat_template": "{% jinja %}"})
    with pytest.raises(ValueError, match="Unknown chat layout"):
        attach_config(example, example, model_template="")


CONFIGS = [
    ("d", "a", "conversational", "X", None, None, None, None),
    ("d", "b", "text", "X", "{{}}{instruction}/{input}/{response}", None, None, None),
    ("d", "c", "", "", "", "extraction", None, None),
    ("d", "e", None, None, None, None, None, None),
]


@pytest.mark.parametrize("model_template", [None, "chatml"])
@pytest.mark.parametrize("argument", [None, "text", "conversational"])
def test_mixed_configs_equal_one_job_each(spark, model_template, argument):
    rows = [("d", name, f"{name}: {{input}}") for name in ("a", "b", "c", "e", "none")] + [("other", "a", "x")]
    df = spark.createDataFrame(rows, "dataset_name string, dataset_config string, input string")
    configs = spark.createDataFrame(CONFIGS, CONFIG)
    mixed = format_prompts_by_row(
        attach_config(input_prompts(df), configs, dataset_format=argument, model_template=model_template)
    )
    got = {(r.dataset_name, r.dataset_config): r.prompt for r in mixed.collect()}
    fields = configs.columns[2:]
    known = {(c[0], c[1]): dict(zip(fields, c[2:])) for c in CONFIGS}
    for key in [(r[0], r[1]) for r in rows]:
        one = df.filter((F.col("dataset_name") == key[0]) & (F.col("dataset_config") == key[1]))
        assert got[key] == prompt_of(one, merge_config(known.get(key), argument), model_template), key


@pytest.mark.parametrize(
    "bad, message",
    [
        (("d", "a", None, None, "{other}", None, None, None), "'other'"),
        (("d", "a", None, None, None, "jinja", None, None), "Unknown chat layout"),
    ],
)
def test_broken_configs_raise(spark, bad, message):
    df = spark.createDataFrame([("d", "a", "x")], "dataset_name string, dataset_config string, input string")
    with pytest.raises(ValueError, match=message):
        attach_config(df, spark.createDataFrame([bad], CONFIG))
    with pytest.raises(ValueError, match="more than once"):
        attach_config(df, spark.createDataFrame([CONFIGS[0], CONFIGS[0]], CONFIG))


@pytest.mark.parametrize("model_template", [None, "chatml"])
def test_mixed_training_equals_one_job_each(spark, model_template):
    keys = [("d", name) for name in ("a", "b", "c", "e", "none")]
    rows = [(*key, "own", f"{key[1]}: {{input}}", "out") for key in keys]
    schema = "dataset_name string, dataset_config string, instruction string, input string, completion string"
    df = spark.createDataFrame(rows, schema)
    mixed = construct_prompts_by_row(
        attach_config(df, spark.createDataFrame(CONFIGS, CONFIG)), model_template, keep=("dataset_config",)
    )
    got = {r.dataset_config: r for r in mixed.collect()}
    known = {c[1]: merge_config(dict(zip(CONFIG_KEYS, c[2:]))) for c in CONFIGS}
    for _, name in keys:
        config = known.get(name, {})
        form = config.get("dataset_format")
        chat = form == "conversational" or (form != "text" and model_template is not None)
        one = df.filter(F.col("dataset_config") == name)
        alone = construct_prompts(one, config.get("instruction"), config.get("text_format"), chat).first()
        assert (got[name].messages, got[name].text) == ((alone[0], None) if chat else (None, alone[0])), name


def test_configs_of_many_bytes_are_joined_without_a_broadcast_hint(spark, monkeypatch):
    from promptloom.operators import positions

    df = spark.createDataFrame([("d", "a", "x")], "dataset_name string, dataset_config string, input string")
    table = spark.createDataFrame(CONFIGS, CONFIG)
    monkeypatch.setattr(positions, "MAX_BROADCAST_BYTES", 100_000)
    hinted = lambda joined: "broadcast" in joined._jdf.queryExecution().logical().toString()
    small = attach_config(df, table)
    large = attach_config(df, table.withColumn("chat_template", F.lit(None).cast("string")).withColumn("instruction", F.expr("repeat('long ', 20000)")))
    few_rows = table.count()
    assert hinted(small) and not hinted(large) and few_rows < 20
    monkeypatch.setattr(positions, "MAX_BROADCAST_BYTES", 1)
    without = attach_config(df, table)
    assert not hinted(without)
    assert small.collect() == without.collect()
