
from __future__ import annotations

import logging
import os
import sys
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from promptloom.constants import (  # noqa: E402
    CONFIG_KEYS,
    DEFAULT_TEXT_FORMAT,
    EXTRACTION_SCHEMA,
    EXTRACTION_SYSTEM,
    TASK_TTL_SECONDS,
)
from stand_ins import DIGEST, FAILING, SAMPLED, STRICT  # noqa: E402
from promptloom.functions.chat import CHATML, EXTRACTION, conversation  # noqa: E402
from promptloom.functions.decisions import is_conversational  # noqa: E402
from promptloom.functions.spans import message_targets, response_spans  # noqa: E402
from promptloom.functions.tokens import resolved_limit  # noqa: E402
from promptloom.functions.values import commit_hash, sanitized_name  # noqa: E402
from promptloom.operators.configs import attach_config  # noqa: E402
from promptloom.operators.generation import completion  # noqa: E402
from promptloom.operators.guards import require_columns, require_rows  # noqa: E402
from promptloom.operators.inference import format_prompts, format_prompts_by_row, input_prompts  # noqa: E402
from promptloom.operators.length import bound_examples, bound_messages, bound_prompts, validate_prompts  # noqa: E402
from promptloom.operators.merge import merge_completions  # noqa: E402
from promptloom.operators.positions import number_by_key, number_by_scan  # noqa: E402
from promptloom.operators.records import lineage_record, profile, route_params  # noqa: E402
from promptloom.operators.training import construct_prompts, construct_prompts_by_row  # noqa: E402
from promptloom.plans.inference import complete_dataset, complete_in_batches, run_inference  # noqa: E402
from promptloom.plans.training import training_table  # noqa: E402
from promptloom.session import shared_folder, ship_package  # noqa: E402
from promptloom.sinks.completions import save_completions  # noqa: E402
from promptloom.sinks.task_table import compact_task_table, read_task_table, write_task_batch  # noqa: E402
from promptloom.sources.conversations import conversation_inputs, conversation_pairs  # noqa: E402
from promptloom.sources.datasets import read_dataset  # noqa: E402
from promptloom.sources.requests import read_requests  # noqa: E402
from promptloom.streaming.service import (  # noqa: E402
    answer_prompts,
    fan_in,
    fan_out,
    format_requests,
    prepare_requests,
    serve_requests,
    served_tasks,
    service_sampling,
)
from promptloom.streaming.tasks import (  # noqa: E402
    create_tasks,
    fold_task_events,
    known_tasks,
    latest_task_state,
    lookup_tasks,
    stream_task_state,
    unexpired_tasks,
    unknown_tasks,
)

# The subpackage for training data can be left out of an installation.
try:
    from promptloom.llm import queries as llm
except ImportError as missing:
    # So can a library that only it needs; the other queries work without.
    logging.getLogger(__name__).warning("Queries of training data operators are left out: %s", missing)
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Settings of the queries below, used on both sides.
INSTRUCTION = "Answer the question in its own language."
CUSTOM_FORMAT = "{{task}} {instruction}\n<in>{input}</in>\n<out>{response}</out>"
POSITIONAL_FORMAT = "{}\n\nQ: {}\nA: {}"
MAX_TOKENS = 256
CHAT_TOKENS = 40
CUT_TOKENS = 60
LANG_CONFIGS = [
    ("en", "en-chat", "conversational", INSTRUCTION, None, None),
    ("fr", "fr-text", "text", None, CUSTOM_FORMAT, None),
    ("de", "de-auto", "auto", "Antworte kurz.", None, "extraction"),
]

# Chat templates in the style of public models.
CHAT_TEMPLATES = [
    "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}"
    "{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}",
    "{% set rest = messages[1:] if messages[0].role == 'system' else messages %}{% for m in rest %}{% if loop.first and "
    "messages[0].role == 'system' %}{% set text = '<<SYS>>\\n' + messages[0].content + '\\n<</SYS>>\\n\\n' + m.content %}"
    "{% else %}{% set text = m.content %}{% endif %}{{ bos_token + '[INST] ' + text.strip() + ' [/INST]' }}{% endfor %}",
    "{{ bos_token }}{% for m in messages %}{{ '<|start_header_id|>' ~ m.role ~ '<|end_header_id|>\\n\\n' ~ m.content | trim "
    "~ '<|eot_id|>' }}{% endfor %}{% if add_generation_prompt %}<|start_header_id|>assistant<|end_header_id|>\n\n{% endif %}",
]

KIND_CONFIGS = [
    ("guided", "conversational", None, None, None, None, None),
    ("long", "text", INSTRUCTION, CUSTOM_FORMAT, None, "<in>", "<out>"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_pairs(_table(spark, sf_dir, "conversations"))


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_inputs(_table(spark, sf_dir, "conversations"))


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


def _lang_configs(spark: SparkSession) -> DataFrame:
    columns = ["lang", "dataset_config", *CONFIG_KEYS[:4]]
    return spark.createDataFrame(LANG_CONFIGS, ", ".join(f"{c} string" for c in columns))


def _requests(documents: DataFrame) -> DataFrame:
    """Each document as a request: its lines are the prompts, its language picks the parameters.

    One in twenty comes with a second request, of its own id, without any prompts.
    """
    lang = F.col("lang")

    def by_lang(**values: str) -> Column:
        column = F.lit(None).cast("string")
        for name, value in values.items():
            column = F.when(lang == name, value).otherwise(column)
        return column

    suffixes = F.when(F.col("doc_id") % 20 == 3, F.array(F.lit(""), F.lit("-none"))).otherwise(F.array(F.lit("")))
    nothing = F.array().cast("array<string>")
    return documents.withColumn("suffix", F.explode(suffixes)).select(
        F.concat(F.col("doc_id").cast("string"), F.col("suffix")).alias("task_id"),
        F.when(F.col("suffix") == "", F.split("text", "\n")).otherwise(nothing).alias("prompts"),
        F.struct(
            by_lang(en=INSTRUCTION).alias("instruction"),
            by_lang(en=POSITIONAL_FORMAT, fr=POSITIONAL_FORMAT).alias("text_format"),
            by_lang(de="chatml").alias("chat_template"),
        ).alias("prompts_params"),
        F.when(lang == "en", F.create_map(F.lit("max_tokens"), F.col("n_chars").cast("string")))
        .when(lang == "fr", F.create_map(F.lit("temperature"), F.lit("0.7"), F.lit("top_p"), F.lit("0.9")))
        .alias("sampling_params"),
    )


def _repeated(requests: DataFrame) -> DataFrame:
    """Requests of which some are sent a second time with other prompts, and one a hundred times."""
    key = F.xxhash64("task_id") % 7
    times = F.when(F.col("task_id") == "4", 100).when(key == 0, 2).otherwise(1)
    sent = requests.withColumn("queued_at", F.explode(F.sequence(F.lit(1), times)))
    again = F.concat(F.col("prompts"), F.array(F.concat(F.lit("again "), F.col("queued_at").cast("string"))))
    return sent.withColumn("prompts", F.when(F.col("queued_at") > 1, again).otherwise(F.col("prompts")))


def _task_events(conversations: DataFrame) -> DataFrame:
    """Each turn as a task event at its turn's time; a few tasks start without being queued."""
    first = F.col("turn") == 0
    created = first & ((F.col("role") == "system") | (F.length("text") >= 60))
    failed = (F.col("role") == "assistant") & (F.length("text") < 300)
    return conversations.select(
        F.col("conv_id").cast("string").alias("task_id"),
        F.when(created, "queued")
        .when(failed, "error")
        .when(F.col("role") == "assistant", "done")
        .otherwise("running")
        .alias("status"),
        F.col("turn").cast("double").alias("event_at"),
        F.when(failed, F.concat(F.lit("stopped at "), F.col("turn").cast("string"))).alias("error"),
    )


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_task_events(_task_events(_table(spark, sf_dir, "conversations")))


# Training prompts


def train_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return construct_prompts(_pairs(spark, sf_dir), keep=("conv_id", "turn"))


def train_text_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return construct_prompts(_pairs(spark, sf_dir), INSTRUCTION, CUSTOM_FORMAT, keep=("conv_id", "turn"))


def train_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = construct_prompts(_pairs(spark, sf_dir), conversational=True, keep=("conv_id", "turn"))
    return examples.select(
        "conv_id", "turn", F.posexplode_outer("messages").alias("pos", "message")
    ).select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "message.role", "message.content")


def mixed_config_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("instruction").isNotNull(), "guided").when(F.length("input") > 200, "long")
    configs = spark.createDataFrame(KIND_CONFIGS, ", ".join(f"{c} string" for c in ["kind", *CONFIG_KEYS]))
    configured = attach_config(_pairs(spark, sf_dir).withColumn("kind", kind), configs, on=["kind"])
    prompts = construct_prompts_by_row(configured, "chatml", keep=("conv_id", "turn", "config"))
    spans = response_spans(F.col("text"), F.col("config.instruction_part"), F.col("config.response_part"))
    chat = CHATML.render(F.col("messages"), generate=False).alias("chat")
    return prompts.select("conv_id", "turn", chat, "text", F.posexplode_outer(spans).alias("pos", "span")).select(
        "conv_id", "turn", "chat", "text", F.col("pos").cast("bigint").alias("pos"), F.col("span.target").alias("target")
    )


def response_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = construct_prompts(_pairs(spark, sf_dir), INSTRUCTION, conversational=True, keep=("conv_id", "turn"))
    return examples.select("conv_id", "turn", F.explode_outer(message_targets(F.col("messages"))).alias("m")).select(
        "conv_id", "turn", "m.role", "m.content", "m.is_target"
    )


def response_span_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = response_spans(F.col("text"), "### Input:\n", "\n\n### Response:\n")
    return (
        train_text(spark, sf_dir)
        .select("conv_id", "turn", F.posexplode_outer(spans).alias("pos", "span"))
        .select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "span.context", "span.target")
    )


def train_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bound_examples(documents, max_tokens=MAX_TOKENS)


def train_chat_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = construct_prompts(_pairs(spark, sf_dir), INSTRUCTION, conversational=True, keep=("conv_id", "turn"))
    bounded = bound_messages(examples, max_tokens=CHAT_TOKENS)
    messages = bounded.select("conv_id", "turn", "was_truncated", F.posexplode_outer("messages").alias("pos", "m"))
    return messages.select("conv_id", "turn", "was_truncated", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


def truncated_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded = bound_examples(train_text(spark, sf_dir), max_tokens=CUT_TOKENS)
    spans = response_spans(F.col("text"), "### Input:\n", "\n\n### Response:\n")
    return bounded.select("conv_id", "turn", "was_truncated", F.explode_outer(spans).alias("span")).select(
        "conv_id", "turn", "was_truncated", "span.context", "span.target"
    )


# Inference prompts


def infer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"dataset_format": "text", "instruction": INSTRUCTION}
    return format_prompts(input_prompts(_inputs(spark, sf_dir)), config).select("conv_id", "turn", "prompt")


def infer_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"instruction": INSTRUCTION}
    prompts = format_prompts(input_prompts(_inputs(spark, sf_dir)), config, model_template="chatml")
    return prompts.select("conv_id", "turn", "prompt")


def chat_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = conversation(F.col("input"), F.col("instruction"), F.col("completion"))
    return _pairs(spark, sf_dir).select("conv_id", "turn", CHATML.render(messages, generate=False).alias("prompt"))


def extraction_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", EXTRACTION.prompt(F.col("text")).alias("prompt"))


def extraction_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = conversation(F.col("input"), F.col("instruction"), F.col("completion"))
    return _pairs(spark, sf_dir).select("conv_id", "turn", EXTRACTION.render(messages, generate=False).alias("prompt"))


def input_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", (F.col("n_chars") > 1000).alias("is_long"), (F.col("n_chars") / 8).alias("share")
    )
    for column in ("n_chars", "is_long", "share"):
        documents = input_prompts(documents, column, f"{column}_text")
    return documents.select("doc_id", "n_chars_text", "is_long_text", "share_text")


def format_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    decided = attach_config(documents, _lang_configs(spark), on=["lang"], dataset_format="text")
    is_chat = is_conversational(F.col("config.dataset_format"), F.col("config.chat_template")).alias("is_chat")
    return decided.select("doc_id", "config.dataset_format", is_chat)


def mixed_config_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("input"))
    configured = attach_config(input_prompts(documents), _lang_configs(spark), on=["lang"])
    return format_prompts_by_row(configured).select("doc_id", "prompt")


def prompt_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return validate_prompts(documents, "text", MAX_TOKENS).select("doc_id", "n_tokens", "ok")


def prompt_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Limits as models report them: a real one, a placeholder too large to be one, and none.
    model_limit = F.when(F.col("lang") == "en", MAX_TOKENS).when(F.col("lang") == "fr", 10**9)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("prompt"))
    return bound_prompts(documents, max_tokens=resolved_limit(model_limit)).select("doc_id", "prompt")


# Completions


def generate_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", completion(F.col("text"), DIGEST).alias("inference"))


def batch_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return complete_dataset(_inputs(spark, sf_dir), DIGEST, {"dataset_format": "text"}, keep_prompt=True)


def resumed_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions made by two starts of a job, of which the second finds files that the first had not."""
    ship_package(spark)
    folder = _scratch(spark)
    inputs = _inputs(spark, sf_dir)
    part = F.col("conv_id") % 2 == 0
    for own in (part, ~part):
        inputs.filter(own).repartition(3).write.mode("append").parquet(f"{folder}/inputs")
        files = spark.readStream.schema(inputs.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/inputs")
        done = complete_in_batches(files, DIGEST, f"{folder}/job", {"dataset_format": "text"})
    return done


def training_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pairs(spark, sf_dir).createOrReplaceTempView("training_pairs")
    return training_table(spark, "training_pairs", max_tokens=MAX_TOKENS, keep=("conv_id", "turn"))


def configured_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training job of each language with its configuration file, and what it records of itself."""
    folder = _scratch(spark)
    documents = _table(spark, sf_dir, "documents")
    rows = documents.select("lang", F.col("doc_id").cast("string").alias("input"), F.md5("text").alias("completion"))
    rows.write.partitionBy("lang").json(f"{folder}/datasets")
    langs = [row[0] for row in rows.select("lang").distinct().collect()]
    # One file for each language, made from the table: its text format names the language.
    text_format = F.concat(F.lit("<"), F.col("lang"), F.lit("> {input} = {response}"))
    file = F.struct(F.concat(F.lit("cfg-"), F.col("lang")).alias("name"), text_format.alias("text_format"),
                    F.lit("<").alias("instruction_part"), F.lit(" = ").alias("response_part"))
    configs = documents.select("lang").distinct().select(F.concat(F.lit("lang="), F.col("lang")).alias("dataset"), file.alias("file"))
    for lang in langs:
        one = configs.filter(F.col("dataset") == f"lang={lang}").select("file.*")
        one.coalesce(1).write.json(f"{folder}/configs/lang={lang}/cfg.json")
    jobs = [
        training_table(
            spark, f"lang={lang}", dataset_config="cfg", datasets_folder=f"{folder}/datasets", configs_folder=f"{folder}/configs",
            schema="input string, completion string", records_folder=f"{folder}/records/job={lang}", keep=("input",),
            checksum_urls=[f"hf://datasets/web@{lang}{lang}/data.json"] if lang == "en" else [],
        ).withColumn("lang", F.lit(lang))
        for lang in langs
    ]
    examples = reduce(DataFrame.unionByName, jobs)

    def records(table: str) -> DataFrame:
        parts = [spark.read.parquet(f"{folder}/records/job={lang}/{table}").withColumn("job", F.lit(lang)) for lang in langs]
        return reduce(DataFrame.unionByName, parts)

    lineage, params = records("lineage"), records("params")
    named = params.groupBy(F.col("job").alias("lang")).agg(
        F.max(F.when(F.col("key") == "dataset_config", F.concat("value", F.lit("/"), "route"))).alias("config"),
        F.max(F.when(F.col("key") == "schema", F.col("value"))).alias("schema"),
        F.max(F.when(F.col("key") == "first_row", F.get_json_object("value", "$.input"))).alias("first_input"),
    )
    recorded = lineage.select(F.col("job").alias("lang"), "source_type", "commit_hash", "num_rows").join(named, "lang")
    first = F.col("first_input").isNotNull().alias("has_first_row")
    return examples.join(recorded, "lang").select(
        "lang", F.col("input").alias("doc_id"), "text", F.col("targets")[0]["target"].alias("target"),
        "source_type", "commit_hash", "num_rows", "config", "schema", first,
    )


def inference_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    folder = _scratch(spark)
    _pairs(spark, sf_dir).createOrReplaceTempView("inference_pairs")
    run = run_inference(
        spark,
        SAMPLED,
        "inference_pairs",
        sampling={"max_tokens": 77},
        model_template="chatml",
        completions_folder=f"{folder}/completions",
        records_folder=f"{folder}/records",
    )
    return spark.read.json(run.path).withColumn("num_rows", F.lit(run.num_rows).cast("bigint"))


def merge_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    made = number_by_scan(documents).select("row_id", F.concat(F.lit("gen:"), F.md5("text")).alias("completion"))
    return merge_completions(documents.select("doc_id", "lang"), made, key="doc_id")


def merge_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    completed = F.concat(F.lit("gen:"), F.md5("text")).alias("completion")
    made = number_by_scan(documents).filter(F.col("lang") == "en").select("row_id", completed)
    return merge_completions(documents.select("doc_id", "lang"), made, key="doc_id")


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_by_key(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def scan_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_by_scan(_table(spark, sf_dir, "conversations").select("conv_id", "turn"))


# Records


def param_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    params = documents.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value"))
    return route_params(params).select("key", "route")


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(_table(spark, sf_dir, "documents").withColumnRenamed("source", "split"), "split")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    record = lineage_record(spark, "web/Raw Pages:v1", pages.count(), pages.schema.simpleString(), "train")
    return record.drop("schema")


def name_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        sanitized_name(F.col("url")).alias("name"),
        sanitized_name(F.col("url"), replace_dots=True).alias("name_without_dots"),
    )


def revision_of_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    with_revision = F.concat(F.lit("hf://datasets/web@"), F.md5("url"), F.lit("/"), F.col("url"))
    return pages.select(
        "page_id",
        commit_hash(with_revision).alias("hash"),
        commit_hash(F.col("url")).alias("hash_of_page"),
    )


def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").withColumnRenamed("source", "split")
    documents.createOrReplaceTempView("documents_by_split")
    return read_dataset(spark, "documents_by_split", "src3").select("doc_id", "split")


def json_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs in three layouts in one folder: a record on each line, an array on each line, and documents."""
    folder = _scratch(spark)
    fields = ["conv_id", "turn", "instruction", "input", "completion"]
    pairs = _pairs(spark, sf_dir).select(F.to_json(F.struct(*fields)).alias("record"), "conv_id")
    layout = F.element_at(F.array(F.lit("lines"), F.lit("arrays"), F.lit("documents")), (F.col("conv_id") % 3 + 1).cast("int"))
    pairs = pairs.select("record", layout.alias("layout"), (F.col("conv_id") % 8).alias("file"))
    documents = pairs.filter("layout = 'documents'").groupBy("layout", "file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")).alias("value")
    )
    line = F.when(F.col("layout") == "arrays", F.concat(F.lit("["), F.col("record"), F.lit("]"))).otherwise(F.col("record"))
    lines = pairs.filter("layout <> 'documents'").select("layout", "file", line.alias("value"))
    files = lines.unionByName(documents).repartition("layout", "file")
    files.write.partitionBy("layout", "file").text(f"{folder}/mixed")
    return read_dataset(spark, "mixed", folder=folder).select(*fields)


def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as arrays of indented records, each cut into its elements by many tasks."""
    ship_package(spark)
    folder = _scratch(spark)
    fields = ["conv_id", "turn", "instruction", "input", "completion"]
    record = F.to_json(F.struct(*fields), {"pretty": "true", "ignoreNullFields": "false"})
    pairs = _pairs(spark, sf_dir).select(record.alias("record"), (F.col("conv_id") % 8).alias("file"))
    array = F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]\n")).alias("value")
    pairs.groupBy("file").agg(array).repartition("file").write.partitionBy("file").text(f"{folder}/arrays")
    small, before = "65536", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    try:
        schema = "conv_id bigint, turn bigint, instruction string, input string, completion string"
        return read_dataset(spark, "arrays", folder=folder, schema=schema, layout="document", cut=True).select(*fields)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def json_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark)
    save_completions(_pairs(spark, sf_dir), "pairs", folder)
    return read_dataset(spark, "pairs.json", folder=folder).select(
        "conv_id", "turn", "instruction", "input", "completion"
    )


# Requests and tasks


def sampling_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = service_sampling(_requests(_table(spark, sf_dir, "documents")))
    return requests.select("task_id", F.explode_outer("sampling").alias("key", "value"))


def service_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_requests(fan_out(prepare_requests(_requests(_table(spark, sf_dir, "documents")))))
    return formatted.select("task_id", F.col("pos").cast("bigint").alias("pos"), "prompt", "error")


def request_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    answers = answer_prompts(_repeated(_requests(_table(spark, sf_dir, "documents"))), SAMPLED)
    return answers.select("task_id", F.col("pos").cast("bigint").alias("pos"), "completion")


def request_fanin(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    gathered = fan_in(answer_prompts(_repeated(_requests(_table(spark, sf_dir, "documents"))), STRICT))
    return gathered.select(
        "task_id",
        "status",
        F.size("completions").cast("bigint").alias("n_completions"),
        F.array_join("completions", "\n").alias("completions"),
    ).withColumn("n_completions", F.when(F.col("status") == "done", F.col("n_completions")))


def task_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    gathered = fan_in(answer_prompts(_repeated(_requests(_table(spark, sf_dir, "documents"))), STRICT))
    return gathered.select("task_id", "status", "error")


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    folder = _scratch(spark)
    requests = _requests(_table(spark, sf_dir, "documents"))
    quarter = F.pmod(F.xxhash64("task_id"), F.lit(4))
    # Requests of one id share a file, and so its time; those without an id, which are rejected, are spread.
    apart = F.when(F.col("task_id").isNull(), F.xxhash64("prompts"))
    completions = f"{folder}/completions"
    options = {"completions_table": completions}
    # Four batches of as many files as they need; some requests are sent again in a later one.
    for quarters in ((0,), (0, 1), (2,), (3,)):
        sent = requests.filter(quarter.isin(*quarters)).repartition("task_id", apart)
        sent.write.mode("append").option("ignoreNullFields", False).json(f"{folder}/requests")
        arriving = read_requests(spark, f"{folder}/requests", stream=True)
        serve_requests(arriving, STRICT, f"{folder}/served", f"{folder}/checkpoint", **options).awaitTermination()
    tasks = served_tasks(spark, f"{folder}/served")
    in_order = (F.col("queued_at") <= F.col("running_at")) & (
        F.coalesce(F.col("done_at"), F.col("running_at")) >= F.col("running_at")
    )
    # What was saved for each task, next to what the task's record holds.
    saved = read_task_table(spark, completions).withColumnRenamed("completions", "saved")
    both = tasks.join(saved, "task_id", "left")
    return both.select(
        "task_id", "status", "error", F.array_join("completions", "\n").alias("completions"),
        F.array_join("saved", "\n").alias("saved"), in_order.alias("in_order"),
    )


def task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished tasks saved by two batches, some by both, then each once in a table of its own."""
    ship_package(spark)
    folder = _scratch(spark)
    gathered = fan_in(answer_prompts(_requests(_table(spark, sf_dir, "documents")), STRICT))
    gathered.write.parquet(f"{folder}/gathered")
    tasks = spark.read.parquet(f"{folder}/gathered")
    third = F.ascii(F.right("task_id", F.lit(1))) % 3
    unfinished = F.transform("completions", lambda c: F.concat(F.lit("first "), c)).alias("completions")
    write_task_batch(tasks.filter(third < 2).select("task_id", "status", unfinished), f"{folder}/saved", 0)
    write_task_batch(tasks.filter(third > 0), f"{folder}/saved", 1)
    # A batch that runs again replaces what it wrote.
    write_task_batch(tasks.filter(third > 0), f"{folder}/saved", 1, tasks_per_file=2000)
    compact_task_table(spark, f"{folder}/saved", f"{folder}/compact", tasks_per_file=2000)
    kept = spark.read.parquet(f"{folder}/compact/completions")
    again = F.element_at("completions", 1).startswith("first ")
    return kept.select("task_id", F.array_join("completions", "\n").alias("completions"), again.alias("first_batch"))


def task_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id")
    is_uuid = F.col("task_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    alone = F.count(F.lit(1)).over(Window.partitionBy("task_id")) == 1
    started = time.time()
    recent = F.col("queued_at").between(started - 1, started + 3600)
    return create_tasks(documents).select(
        "doc_id", "status", is_uuid.alias("is_uuid"), alone.alias("is_unique"), recent.alias("is_recent")
    )


def task_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_tasks(_states(spark, sf_dir))


def task_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_tasks(_states(spark, sf_dir)).select("task_id", "status")


def task_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every conversation and every document asks for its task; a document may have none.
    asked = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("task_id"))
    others = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("task_id"))
    return lookup_tasks(asked.unionByName(others), known_tasks(_states(spark, sf_dir)))


def task_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unexpired_tasks(known_tasks(_states(spark, sf_dir)), F.lit(605.0)).select("task_id")


def task_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark)
    # Events of a task arrive in several batches, in no order of time.
    turns = _table(spark, sf_dir, "conversations")
    quarter = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    for batch in range(4):
        turns.filter(quarter == batch).write.mode("append").parquet(f"{folder}/turns")
        arriving = spark.readStream.schema(turns.schema).parquet(f"{folder}/turns")
        stream_task_state(_task_events(arriving), f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return known_tasks(latest_task_state(spark, f"{folder}/state"))


def task_expiry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that start a minute apart, in four batches; those done for more than the time to live go."""
    folder = _scratch(spark)
    turns = _table(spark, sf_dir, "conversations")
    last = turns.agg(F.max("conv_id")).first()[0] or 0
    quarter = F.floor(F.col("conv_id") * 4 / (last + 1))
    for batch in range(4):  # one after the other, so that they arrive in this order
        turns.filter(quarter == batch).write.mode("append").parquet(f"{folder}/turns")
        arriving = spark.readStream.schema(turns.schema).parquet(f"{folder}/turns")
        events = _task_events(arriving).withColumn("event_at", F.col("event_at") + 60 * (F.col("task_id").cast("double") + 1))
        stream_task_state(events, f"{folder}/state", f"{folder}/checkpoint", ttl_seconds=TASK_TTL_SECONDS).awaitTermination()
    return known_tasks(latest_task_state(spark, f"{folder}/state"))


def chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn rendered by one of three chat templates given as text, by its conversation."""
    prompts = input_prompts(_inputs(spark, sf_dir))
    parts = [
        format_prompts(prompts.filter(F.col("conv_id") % 3 == n), {"instruction": INSTRUCTION, "chat_template": source})
        for n, source in enumerate(CHAT_TEMPLATES)
    ]
    return reduce(DataFrame.unionByName, parts).select("conv_id", "turn", "prompt")


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards raise for each language's documents, with and without a column asked for."""
    documents = _table(spark, sf_dir, "documents")
    languages = sorted(row.lang for row in documents.filter("lang IS NOT NULL").select("lang").distinct().collect())

    def raised(check: Callable, *arguments) -> str | None:
        try:
            check(*arguments)
        except ValueError as error:
            return str(error)
        return None

    rows = []
    for lang in [*languages, "none"]:
        own = documents.filter(F.col("lang") == lang)
        rows.append((lang, raised(require_rows, own, lang), raised(require_columns, own, "text", "absent")))
    return spark.createDataFrame(rows, "lang string, no_rows string, no_columns string")


QUERIES: dict[str, Query] = {
    "train_text": train_text,
    "train_text_configured": train_text_configured,
    "train_messages": train_messages,
    "mixed_config_training": mixed_config_training,
    "response_targets": response_targets,
    "response_spans": response_span_targets,
    "train_truncate": train_truncate,
    "train_chat_bounded": train_chat_bounded,
    "truncated_targets": truncated_targets,
    "infer_text": infer_text,
    "infer_chat": infer_chat,
    "chat_rendering": chat_rendering,
    "extraction_chat": extraction_chat,
    "extraction_examples": extraction_examples,
    "input_text": input_text,
    "format_decision": format_decision,
    "mixed_config_prompts": mixed_config_prompts,
    "prompt_validate": prompt_validate,
    "prompt_truncate": prompt_truncate,
    "generate_stub": generate_stub,
    "batch_inference": batch_inference,
    "resumed_inference": resumed_inference,
    "training_job": training_job,
    "inference_job": inference_job,
    "configured_job": configured_job,
    "merge_positional": merge_positional,
    "merge_mismatch": merge_mismatch,
    "row_numbers": row_numbers,
    "scan_numbers": scan_numbers,
    "param_routing": param_routing,
    "dataset_profile": dataset_profile,
    "lineage": lineage,
    "name_sanitize": name_sanitize,
    "commit_hash": revision_of_url,
    "split_scan": split_scan,
    "json_dataset": json_dataset,
    "json_layouts": json_layouts,
    "json_arrays": json_arrays,
    "sampling_merge": sampling_merge,
    "service_text": service_text,
    "request_fanout": request_fanout,
    "request_fanin": request_fanin,
    "task_errors": task_errors,
    "request_stream": request_stream,
    "task_table": task_table,
    "task_create": task_create,
    "task_state": task_state,
    "task_rejects": task_rejects,
    "task_lookup": task_lookup,
    "task_expiry": task_expiry,
    "task_state_stream": task_state_stream,
    "task_expiry_stream": task_expiry_stream,
    "chat_templates": chat_templates,
    "guards": guards,
}


def entry(spark: SparkSession) -> DataFrame:
    """Completions of every user turn: prompt, template, engine, output column."""
    return batch_inference(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return QUERIES | (llm.QUERIES if llm else {})


# SQL


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, **fields: str) -> str:
    """A template as a SQL concatenation; fields are SQL expressions."""
    parts = []
    for literal, field in _split_template(template):
        if literal:
            parts.append(_quoted(literal))
        if field is not None:
            parts.append(f"coalesce({fields[field]}, 'None')")
    return " || ".join(parts)


def _split_template(template: str) -> list[tuple[str, str | None]]:
    from string import Formatter

    return [(literal, field) for literal, field, _, _ in Formatter().parse(template)]


PAIRS = """
p AS (
  SELECT conv_id, turn, role, text AS input,
         max(CASE WHEN role = 'system' THEN text END) OVER (PARTITION BY conv_id) AS instruction,
         CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS completion
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (SELECT conv_id, turn, instruction, input, completion FROM p WHERE role = 'user')
"""

EVENTS = """
flags AS (
  SELECT *, turn = 0 AND (role = 'system' OR length(text) >= 60) AS created,
         role = 'assistant' AND length(text) < 300 AS failed
  FROM conversations),
events AS (
  SELECT CAST(conv_id AS VARCHAR) AS task_id, CAST(turn AS DOUBLE) AS event_at,
         CASE WHEN created THEN 'queued' WHEN failed THEN 'error' WHEN role = 'assistant' THEN 'done' ELSE 'running' END
           AS status,
         CASE WHEN failed THEN 'stopped at ' || turn END AS error
  FROM flags),
states AS (
  SELECT task_id, arg_max(status, event_at) AS status,
         arg_max(error, event_at) FILTER (status = 'error') AS error,
         max(event_at) FILTER (status = 'queued') AS queued_at,
         max(event_at) FILTER (status = 'running') AS running_at,
         max(event_at) FILTER (status = 'done') AS done_at
  FROM events GROUP BY task_id)
"""

REQUESTS = """
requests AS (
  SELECT CAST(doc_id AS VARCHAR) AS task_id, lang, n_chars, string_split(text, chr(10)) AS prompts FROM documents
  UNION ALL SELECT doc_id || '-none', lang, n_chars, [] FROM documents WHERE doc_id % 20 = 3),
prompts AS (
  SELECT task_id, lang, n_chars, CAST(generate_subscripts(prompts, 1) - 1 AS BIGINT) AS pos, unnest(prompts) AS prompt
  FROM requests)
"""

CHATML_PROMPT = "'<|im_start|>user' || chr(10) || {user} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"

# What the service makes of a prompt: a chat layout, a positional template, or nothing.
SERVICE_PROMPT = f"""
CASE lang
  WHEN 'de' THEN {CHATML_PROMPT.format(user="prompt")}
  WHEN 'en' THEN {_quoted(INSTRUCTION)} || chr(10) || chr(10) || 'Q: ' || prompt || chr(10) || 'A: '
  WHEN 'fr' THEN 'You are an helpful assistant' || chr(10) || chr(10) || 'Q: ' || prompt || chr(10) || 'A: '
  ELSE prompt END
"""

# No line of a document is near the 8192 tokens at which a prompt would be cut.
ANSWERS = f"""
formatted AS (SELECT task_id, lang, n_chars, pos, {SERVICE_PROMPT} AS prompt FROM prompts),
answers AS (
  SELECT task_id,
         arg_min(length(prompt), pos) FILTER (contains(prompt, '{FAILING}')) AS failing,
         string_agg('gen:' || md5(prompt), chr(10) ORDER BY pos) AS completions,
         count(*) AS n_completions
  FROM formatted GROUP BY task_id),
gathered AS (
  SELECT r.task_id,
         CASE WHEN a.task_id IS NULL THEN 'list index out of range'
              WHEN failing IS NOT NULL THEN 'Prompt of ' || failing || ' characters holds {FAILING}' END AS error,
         CASE WHEN error IS NULL THEN 'done' ELSE 'error' END AS status,
         CASE WHEN error IS NULL THEN completions END AS completions,
         CASE WHEN error IS NULL THEN n_completions END AS n_completions
  FROM requests r LEFT JOIN answers a USING (task_id))
"""

TRIMMED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _extraction_user(content: str) -> str:
    head = f"<|im_start|>user\n# Template:\n{EXTRACTION_SCHEMA}\n# Input:\n"
    return f"{_quoted(head)} || {TRIMMED.format(content)} || {_quoted(chr(10) + '<|im_end|>' + chr(10))}"


EXTRACTION_OPENING = _quoted(f"<|im_start|>system\n{EXTRACTION_SYSTEM}\n<|im_end|>\n")

LANG_CASES = f"""
CASE lang
  WHEN 'en' THEN '<|im_start|>system' || chr(10) || {_quoted(INSTRUCTION)} || '<|im_end|>' || chr(10)
    || {CHATML_PROMPT.format(user="text")}
  WHEN 'fr' THEN {_filled(CUSTOM_FORMAT, instruction="''", input="text", response="''")}
  WHEN 'de' THEN '<|im_start|>system' || chr(10) || 'Antworte kurz.' || chr(10) || '<|im_end|>' || chr(10)
    || {_extraction_user("text")} || '<|im_start|>assistant'
  ELSE {_filled(DEFAULT_TEXT_FORMAT, instruction="''", input="text", response="''")} END
"""

TRAIN_TEXT = _filled(
    DEFAULT_TEXT_FORMAT, instruction="'You are an helpful assistant.'", input="input", response="completion"
)
INFER_TEXT = _filled(DEFAULT_TEXT_FORMAT, instruction="''", input="input", response="''")

ORACLES: dict[str, str] = {
    "train_text": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, {TRAIN_TEXT} AS text FROM pairs""",
    "train_text_configured": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          {_filled(CUSTOM_FORMAT, instruction=_quoted(INSTRUCTION), input="input", response="completion")} AS text
        FROM pairs""",
    "train_messages": f"""
        WITH {PAIRS},
        parts AS (
          SELECT conv_id, turn, 0 AS part, 'system' AS role, instruction AS content FROM pairs WHERE instruction <> ''
          UNION ALL SELECT conv_id, turn, 1, 'user', input FROM pairs
          UNION ALL SELECT conv_id, turn, 2, 'assistant', completion FROM pairs WHERE completion <> '')
        SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY part) - 1 AS pos, role, content
        FROM parts""",
    "mixed_config_training": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          CASE WHEN instruction IS NOT NULL OR length(input) <= 200 THEN
            coalesce('<|im_start|>system' || chr(10) || instruction || '<|im_end|>' || chr(10), '')
            || '<|im_start|>user' || chr(10) || input || '<|im_end|>' || chr(10)
            || coalesce('<|im_start|>assistant' || chr(10) || completion || '<|im_end|>' || chr(10), '') END AS chat,
          CASE WHEN instruction IS NULL AND length(input) > 200 THEN
            {_filled(CUSTOM_FORMAT, instruction=_quoted(INSTRUCTION), input="input", response="completion")} END AS text,
          CASE WHEN instruction IS NULL AND length(input) > 200 THEN CAST(0 AS BIGINT) END AS pos,
          CASE WHEN instruction IS NULL AND length(input) > 200 THEN coalesce(completion, 'None') || '</out>' END AS target
        FROM pairs""",
    "response_targets": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, 'system' AS role, {_quoted(INSTRUCTION)} AS content, false AS is_target FROM pairs
        UNION ALL SELECT conv_id, turn, 'user', input, false FROM pairs
        UNION ALL SELECT conv_id, turn, 'assistant', completion, true FROM pairs WHERE completion <> ''""",
    "response_spans": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, CAST(0 AS BIGINT) AS pos, input AS context, coalesce(completion, 'None') AS target
        FROM pairs""",
    "train_truncate": rf"""
        WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '\s*\S+') AS tokens FROM documents)
        SELECT doc_id, CASE WHEN len(tokens) > {MAX_TOKENS} THEN array_to_string(tokens[1:{MAX_TOKENS}], '') ELSE text END
          AS text, len(tokens) > {MAX_TOKENS} AS was_truncated
        FROM t""",
    "train_chat_bounded": rf"""
        WITH {PAIRS},
        parts AS (
          SELECT conv_id, turn, 0 AS part, 'system' AS role, {_quoted(INSTRUCTION)} AS content FROM pairs
          UNION ALL SELECT conv_id, turn, 1, 'user', input FROM pairs
          UNION ALL SELECT conv_id, turn, 2, 'assistant', completion FROM pairs WHERE completion <> ''),
        sized AS (SELECT *, regexp_extract_all(content, '\s*\S+') AS tokens FROM parts),
        placed AS (
          SELECT *, {CHAT_TOKENS} - coalesce(CAST(sum(len(tokens)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INT), 0) AS left_over,
            sum(len(tokens)) OVER (PARTITION BY conv_id, turn) > {CHAT_TOKENS} AS was_truncated
          FROM sized WINDOW w AS (PARTITION BY conv_id, turn ORDER BY part))
        SELECT conv_id, turn, was_truncated, row_number() OVER (PARTITION BY conv_id, turn ORDER BY part) - 1 AS pos, role,
          CASE WHEN len(tokens) > left_over THEN array_to_string(tokens[1:left_over], '') ELSE content END AS content
        FROM placed WHERE left_over > 0""",
    "truncated_targets": rf"""
        WITH {PAIRS},
        t AS (
          SELECT conv_id, turn, text, regexp_extract_all(text, '\s*\S+') AS tokens
          FROM (SELECT conv_id, turn, {TRAIN_TEXT} AS text FROM pairs)),
        cut AS (
          SELECT conv_id, turn, len(tokens) > {CUT_TOKENS} AS was_truncated,
            CASE WHEN len(tokens) > {CUT_TOKENS} THEN array_to_string(tokens[1:{CUT_TOKENS}], '') ELSE text END AS text
          FROM t),
        after AS (SELECT *, split_part(text, '### Input:' || chr(10), 2) AS piece FROM cut),
        placed AS (SELECT *, instr(piece, chr(10) || chr(10) || '### Response:' || chr(10)) AS place FROM after)
        SELECT conv_id, turn, was_truncated, CASE WHEN place > 0 THEN substr(piece, 1, place - 1) ELSE piece END AS context,
          CASE WHEN place > 0 THEN substr(piece, place + 16) END AS target
        FROM placed""",
    "infer_text": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          {_filled(DEFAULT_TEXT_FORMAT, instruction=_quoted(INSTRUCTION), input="input", response="''")} AS prompt
        FROM pairs""",
    "infer_chat": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          '<|im_start|>system' || chr(10) || {_quoted(INSTRUCTION)} || '<|im_end|>' || chr(10)
            || {CHATML_PROMPT.format(user="input")} AS prompt
        FROM pairs""",
    "chat_rendering": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          coalesce('<|im_start|>system' || chr(10) || instruction || '<|im_end|>' || chr(10), '')
          || '<|im_start|>user' || chr(10) || input || '<|im_end|>' || chr(10)
          || coalesce('<|im_start|>assistant' || chr(10) || completion || '<|im_end|>' || chr(10), '') AS prompt
        FROM pairs""",
    "extraction_chat": f"""
        SELECT doc_id, {EXTRACTION_OPENING} || {_extraction_user("text")} || '<|im_start|>assistant' AS prompt
        FROM documents""",
    "extraction_examples": f"""
        WITH {PAIRS}
        SELECT conv_id, turn,
          coalesce('<|im_start|>system' || chr(10) || {TRIMMED.format("instruction")} || chr(10) || '<|im_end|>' || chr(10),
                   {EXTRACTION_OPENING})
          || {_extraction_user("input")}
          || coalesce('<|im_start|>assistant' || chr(10) || {TRIMMED.format("completion")} || chr(10) || '<|endoftext|>', '')
            AS prompt
        FROM pairs""",
    "input_text": """
        SELECT doc_id, CAST(n_chars AS VARCHAR) AS n_chars_text,
          CASE WHEN n_chars > 1000 THEN 'True' ELSE 'False' END AS is_long_text,
          CAST(CAST(n_chars AS DOUBLE) / 8 AS VARCHAR) AS share_text
        FROM documents""",
    "format_decision": """
        SELECT doc_id,
          CASE lang WHEN 'en' THEN 'conversational' WHEN 'de' THEN 'auto' ELSE 'text' END AS dataset_format,
          lang IN ('en', 'de') AS is_chat
        FROM documents""",
    "mixed_config_prompts": f"SELECT doc_id, {LANG_CASES} AS prompt FROM documents",
    "prompt_validate": rf"""
        SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_tokens,
          len(regexp_extract_all(text, '\S+')) <= {MAX_TOKENS} AS ok
        FROM documents""",
    "prompt_truncate": rf"""
        WITH t AS (
          SELECT doc_id, text, regexp_extract_all(text, '\s*\S+') AS tokens,
                 CASE WHEN lang = 'en' THEN {MAX_TOKENS} ELSE 8192 END AS n
          FROM documents)
        SELECT doc_id, CASE WHEN len(tokens) > n
          THEN regexp_replace(array_to_string(tokens[-n:], ''), '^\s+', '') || regexp_extract(text, '\s*$') ELSE text END AS prompt
        FROM t""",
    "generate_stub": "SELECT doc_id, 'gen:' || md5(text) AS inference FROM documents",
    "batch_inference": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, input, {INFER_TEXT} AS prompt, 'gen:' || md5({INFER_TEXT}) AS inference FROM pairs""",
    "resumed_inference": f"""
        WITH {PAIRS} SELECT conv_id, turn, input, 'gen:' || md5({INFER_TEXT}) AS inference FROM pairs""",
    "training_job": rf"""
        WITH {PAIRS},
        t AS (
          SELECT conv_id, turn, text, regexp_extract_all(text, '\s*\S+') AS tokens
          FROM (SELECT conv_id, turn, {TRAIN_TEXT} AS text FROM pairs))
        SELECT conv_id, turn, len(tokens) > {MAX_TOKENS} AS was_truncated,
          CASE WHEN len(tokens) > {MAX_TOKENS} THEN array_to_string(tokens[1:{MAX_TOKENS}], '') ELSE text END AS text
        FROM t""",
    "configured_job": """
        WITH sized AS (SELECT *, count(*) OVER (PARTITION BY lang) AS num_rows FROM documents)
        SELECT lang, CAST(doc_id AS VARCHAR) AS doc_id, '<' || lang || '> ' || doc_id || ' = ' || md5(text) AS text,
          md5(text) AS target, CASE WHEN lang = 'en' THEN 'hub' ELSE 'storage' END AS source_type,
          CASE WHEN lang = 'en' THEN 'enen' END AS commit_hash, num_rows, 'cfg-' || lang || '/param' AS config,
          'struct<input:string,completion:string>' AS schema, true AS has_first_row
        FROM sized""",
    "inference_job": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, instruction, input, completion, (SELECT count(*) FROM pairs) AS num_rows,
          '77:' || md5({CHATML_PROMPT.format(user="input")}) AS inference
        FROM pairs""",
    "merge_positional": """
        WITH made AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, 'gen:' || md5(text) AS completion FROM documents),
        numbered AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents)
        SELECT doc_id, lang, completion AS inference FROM numbered JOIN made USING (row_id)""",
    "merge_mismatch": "SELECT 'gen:' || md5(text) AS inference FROM documents WHERE lang = 'en'",
    "row_numbers": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents",
    "scan_numbers": "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id FROM conversations",
    "param_routing": """
        SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN length(text) < 250 THEN 'param' ELSE 'text' END AS route
        FROM documents""",
    "dataset_profile": "SELECT source AS split, count(*) AS num_rows FROM documents GROUP BY source",
    "lineage": """
        SELECT 'raw-pages-v1' AS name, 'train' AS split, 'storage' AS source_type,
          'datasets/web/Raw Pages:v1' AS source, CAST(NULL AS VARCHAR) AS commit_hash, count(*) AS num_rows
        FROM pages""",
    "name_sanitize": """
        SELECT page_id, lower(translate(string_split(url, '/')[-1], ' :', '--')) AS name,
          lower(translate(string_split(url, '/')[-1], ' :.', '---')) AS name_without_dots
        FROM pages""",
    "commit_hash": """
        SELECT page_id, md5(url) AS hash, nullif(split_part(split_part(url, '@', 2), '/', 1), '') AS hash_of_page
        FROM pages""",
    "split_scan": "SELECT doc_id, source AS split FROM documents WHERE source = 'src3'",
    "json_arrays": f"WITH {PAIRS} SELECT conv_id, turn, instruction, input, completion FROM pairs",
    "json_layouts": f"WITH {PAIRS} SELECT conv_id, turn, instruction, input, completion FROM pairs",
    "json_dataset": f"WITH {PAIRS} SELECT conv_id, turn, instruction, input, completion FROM pairs",
    "sampling_merge": f"""
        WITH {REQUESTS}, defaults(key, value) AS (
          VALUES ('seed', '0'), ('temperature', '0'), ('max_tokens', '1024'), ('skip_special_tokens', 'true'),
                 ('truncate_prompt_tokens', '8192'))
        SELECT task_id, key,
          CASE WHEN lang = 'en' AND key = 'max_tokens' THEN CAST(n_chars AS VARCHAR)
               WHEN lang = 'fr' AND key = 'temperature' THEN '0.7' ELSE value END AS value
        FROM requests, defaults
        UNION ALL SELECT task_id, 'top_p', '0.9' FROM requests WHERE lang = 'fr'""",
    "service_text": f"""
        WITH {REQUESTS}
        SELECT task_id, pos, {SERVICE_PROMPT} AS prompt, CAST(NULL AS VARCHAR) AS error FROM prompts
        UNION ALL SELECT task_id, NULL, NULL, 'list index out of range' FROM requests WHERE len(prompts) = 0""",
    "request_fanout": f"""
        WITH {REQUESTS}
        SELECT task_id, pos,
          CASE WHEN lang = 'en' THEN CAST(n_chars AS VARCHAR) ELSE '1024' END || ':' || md5({SERVICE_PROMPT}) AS completion
        FROM prompts
        UNION ALL SELECT task_id, NULL, NULL FROM requests WHERE len(prompts) = 0""",
    "request_fanin": f"WITH {REQUESTS}, {ANSWERS} SELECT task_id, status, n_completions, completions FROM gathered",
    "task_errors": f"WITH {REQUESTS}, {ANSWERS} SELECT task_id, status, error FROM gathered",
    "request_stream": f"""
        WITH {REQUESTS}, {ANSWERS}
        SELECT task_id, status, error, completions, completions AS saved, true AS in_order FROM gathered""",
    "task_table": f"""
        WITH {REQUESTS}, {ANSWERS}
        SELECT task_id, ascii(right(task_id, 1)) % 3 = 0 AS first_batch,
          CASE WHEN first_batch THEN 'first ' || replace(completions, chr(10), chr(10) || 'first ') ELSE completions END
            AS completions
        FROM gathered WHERE status = 'done'""",
    "task_create": "SELECT doc_id, 'queued' AS status, true AS is_uuid, true AS is_unique, true AS is_recent FROM documents",
    "task_state": f"WITH {EVENTS} SELECT * FROM states WHERE queued_at IS NOT NULL",
    "task_rejects": f"WITH {EVENTS} SELECT task_id, status FROM states WHERE queued_at IS NULL",
    "task_lookup": f"""
        WITH {EVENTS}, asked AS (
          SELECT DISTINCT CAST(conv_id AS VARCHAR) AS task_id FROM conversations
          UNION SELECT CAST(doc_id AS VARCHAR) FROM documents)
        SELECT a.task_id, status, error, queued_at, running_at, done_at, s.task_id IS NOT NULL AS found
        FROM asked a LEFT JOIN (SELECT * FROM states WHERE queued_at IS NOT NULL) s USING (task_id)""",
    "task_expiry": f"""
        WITH {EVENTS}
        SELECT task_id FROM states WHERE queued_at IS NOT NULL AND (done_at IS NULL OR 605 - done_at <= 600)""",
    "task_state_stream": f"WITH {EVENTS} SELECT * FROM states WHERE queued_at IS NOT NULL",
    "chat_templates": f"""
        WITH {PAIRS}
        SELECT conv_id, turn, CASE conv_id % 3
          WHEN 0 THEN '<|im_start|>system' || chr(10) || {_quoted(INSTRUCTION)} || '<|im_end|>' || chr(10)
            || {CHATML_PROMPT.format(user="input")}
          WHEN 1 THEN '<s>[INST] ' || regexp_replace('<<SYS>>' || chr(10) || {_quoted(INSTRUCTION)} || chr(10) || '<</SYS>>'
            || chr(10) || chr(10) || input, '\\s+$', '') || ' [/INST]'
          ELSE '<s><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || {_quoted(INSTRUCTION)}
            || '<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || {TRIMMED.format("input")}
            || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) END AS prompt
        FROM pairs""",
    "guards": """
        SELECT lang, CASE WHEN n = 0 THEN 'Dataset ' || lang || ' is empty' END AS no_rows,
          'Column(s) absent not found, the dataset has doc_id, text, lang, source, n_chars' AS no_columns
        FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang UNION ALL SELECT 'none', 0)""",
    "task_expiry_stream": f"""
        WITH {EVENTS}, started AS (SELECT *, 60 * (CAST(task_id AS DOUBLE) + 1) AS start FROM states),
        last AS (SELECT max(event_at + 60 * (CAST(task_id AS DOUBLE) + 1)) AS now FROM events)
        SELECT task_id, CASE WHEN now - done_at - start > {TASK_TTL_SECONDS} THEN 'expired' ELSE status END AS status, error,
          queued_at + start AS queued_at, running_at + start AS running_at, done_at + start AS done_at
        FROM started, last WHERE queued_at IS NOT NULL""",
}


def oracle_sql() -> dict[str, str]:
    return ORACLES | (llm.ORACLES if llm else {})
