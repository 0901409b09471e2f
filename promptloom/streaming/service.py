"""The request service: prompts fanned out, completed, and gathered per request."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from promptloom.constants import SERVICE_INSTRUCTION, SERVICE_SAMPLING, TASK_TTL_SECONDS
from promptloom.functions.chat import LAYOUTS, ChatLayout
from promptloom.functions.chat_templates import template_layouts
from promptloom.functions.decisions import joined_prompt, layout_pieces, trims_content
from promptloom.functions.templates import parse_templates, pieces_around
from promptloom.functions.tokens import resolved_limit
from promptloom.functions.values import present
from promptloom.operators.generation import Engine, complete, first_candidate, request_sampling
from promptloom.operators.length import bound_prompts
from promptloom.sinks.completions import save_task_completions
from promptloom.sinks.task_table import write_task_batch
from promptloom.sources.files import path_exists
from promptloom.sources.requests import valid_requests, with_rejection, without_repeats
from promptloom.streaming.tasks import fold_task_events


def service_sampling(requests: DataFrame, model_limit: int | None = None) -> DataFrame:
    """Requests with `sampling`: the user's parameters over the service defaults and prompt limit."""
    limit = resolved_limit(F.lit(model_limit).cast("int"))
    defaults = SERVICE_SAMPLING | {"truncate_prompt_tokens": limit}
    return requests.withColumn("sampling", request_sampling(F.col("sampling_params"), defaults))


def prepare_requests(
    requests: DataFrame,
    model_template: str | None = None,
    model_limit: int | None = None,
    layouts: Mapping[str, ChatLayout] = LAYOUTS,
) -> DataFrame:
    """Requests with what their parameters make of their prompts, worked out once for each.

    That is the `pieces` around each prompt, the sampling parameters as one JSON text, and
    what is wrong with them. The pieces are those of the first of chat layout (the request's,
    else the model's), the request's positional text format, and nothing. The model's layout may be a
    chat template as text; those that requests bring are names of `layouts`, to which
    `template_layouts` adds texts known when the job is written.
    """
    layouts = {**layouts, **template_layouts(model_template)}
    params, sampling = F.col("prompts_params"), F.col("sampling")
    limit = sampling["truncate_prompt_tokens"].try_cast("int")
    prepared = service_sampling(requests, model_limit).select(
        "task_id",
        "prompts",
        present(params["instruction"]).alias("instruction"),
        F.coalesce(present(params["chat_template"]), F.lit(model_template).cast("string")).alias("layout"),
        present(params["text_format"]).alias("text_format"),
        F.to_json(sampling, {"ignoreNullFields": "false"}).alias("sampling"),
        F.when(limit >= 1, limit).alias("max_prompt_tokens"),
    )
    instruction, layout, segments = F.col("instruction"), F.col("layout"), F.col("text_segments")
    spoken = F.coalesce(instruction, F.lit(SERVICE_INSTRUCTION))
    pieces = (
        F.when(layout.isNotNull(), layout_pieces(layout, instruction, layouts))
        .when(segments.isNotNull(), pieces_around(segments, "1", {"0": spoken, "2": F.lit("")}))
        .otherwise(F.array(F.lit(""), F.lit("")))
    )
    unknown = F.concat(F.lit("Unknown chat layout '"), layout, F.lit("'"))
    return parse_templates(prepared, "text_format", positions=3, prefix="text").select(
        "task_id",
        "prompts",
        pieces.alias("pieces"),
        trims_content(layout, layouts).alias("trims_prompt"),
        F.when(layout.isNull(), F.col("text_error")).when(~layout.isin(*layouts), unknown).alias("error"),
        "sampling",
        "max_prompt_tokens",
    )


def fan_out(prepared: DataFrame) -> DataFrame:
    """One row per prompt, `pos` its place in the request. A request without prompts keeps one row."""
    exploded = prepared.select("*", F.posexplode_outer("prompts").alias("pos", "prompt"))
    return exploded.drop("prompts")


def format_requests(prompts: DataFrame) -> DataFrame:
    """Fanned-out prompts rendered, with `error` where that fails."""
    prompt = F.col("prompt")
    rendered = joined_prompt(F.col("pieces"), prompt, F.col("trims_prompt"))
    return prompts.withColumn(
        "error",
        F.when(F.col("pos").isNull(), "list index out of range")
        .when(prompt.isNull(), "Prompt is null")
        .otherwise(F.col("error")),
    ).withColumn("prompt", F.when(F.col("error").isNull(), rendered))


def first_requests(requests: DataFrame) -> DataFrame:
    """One request for each task id: the first by `queued_at` where the requests have it.

    Those of an id are reduced before the shuffle, so one sent very often is no hot key.
    """
    queued = [F.col("queued_at")] if "queued_at" in requests.columns else []
    order = F.struct(*queued, F.xxhash64("prompts", F.to_json("prompts_params")))
    first = F.min_by(F.struct(*requests.columns), order).alias("request")
    return requests.groupBy("task_id").agg(first).select("request.*")


def answer_prompts(
    requests: DataFrame,
    engine: Engine,
    model_template: str | None = None,
    model_limit: int | None = None,
    layouts: Mapping[str, ChatLayout] = LAYOUTS,
    partitions: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """`task_id, pos, prompt, completion, error` for every prompt of every request.

    Of requests with the same id the first is answered, unless the ids are known to be `unique`.
    Prompts are spread over `partitions`, by default as many as shuffles have, by their request
    and their place in it: one with very many is spread like all others, and a task that runs
    again gets the same ones.
    """
    partitions = partitions or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prepared = prepare_requests(requests if unique else first_requests(requests), model_template, model_limit, layouts)
    formatted = format_requests(fan_out(prepared).repartition(partitions, "task_id", "pos"))
    bounded = bound_prompts(formatted, max_tokens=F.col("max_prompt_tokens"))
    answers = complete(F.col("prompt"), engine, F.col("sampling"), capture_errors=True)
    return bounded.withColumn("answer", answers).select(
        "task_id", "pos", "prompt",
        first_candidate(F.col("answer.outputs")).alias("completion"),
        F.coalesce(F.col("error"), F.col("answer.error")).alias("error"),
    )


def fan_in(answers: DataFrame) -> DataFrame:
    """`task_id, status, completions, error` per request, completions in the order of the prompts.

    One failed prompt fails its request, with the first prompt's message and no completions. A
    group is one request: it has as many rows as the request, itself one row, has prompts.
    """
    in_order = F.array_sort(F.collect_list(F.struct("pos", "completion")))
    failed_at = F.when(F.col("error").isNotNull(), F.coalesce(F.col("pos"), F.lit(0)))
    gathered = answers.groupBy("task_id").agg(
        F.transform(in_order, lambda a: a["completion"]).alias("completions"),
        F.min_by("error", failed_at).alias("error"),
    )
    failed = F.col("error").isNotNull()
    return gathered.select(
        "task_id",
        F.when(failed, "error").otherwise("done").alias("status"),
        F.when(~failed, F.col("completions")).alias("completions"),
        "error",
    )


def taken_before(spark: SparkSession, folder: str, batch_id: int, since: float) -> DataFrame | None:
    """Ids of requests that earlier batches took since then; None if there are no earlier ones.

    All rows of a batch have one time, so files of older batches are left out by their statistics.
    """
    if not batch_id or not path_exists(spark, f"{folder}/requests"):
        return None
    schema = "task_id string, taken_at double, batch_id bigint"
    ids = spark.read.schema(schema).parquet(f"{folder}/requests")
    return ids.filter((F.col("batch_id") < batch_id) & (F.col("taken_at") >= since)).select("task_id")


def serve_requests(
    requests: DataFrame,
    engine: Engine,
    folder: str,
    checkpoint: str,
    completions_folder: str | None = None,
    completions_table: str | None = None,
    remember_seconds: float = TASK_TTL_SECONDS,
    trigger: Mapping[str, object] | None = None,
    **options,
) -> StreamingQuery:
    """Answers a stream of requests into `folder`: `arrived`, `requests`, `tasks` and `events`.

    Each batch owns one directory in each table and replaces it if it runs again. Requests are
    parsed once and kept with the reason where one is rejected, as one is that repeats an id of its
    batch, or one that an earlier batch took within `remember_seconds`, the time to live of a task:
    of the requests before it a batch reads the ids of that time only. Answers are written before
    anything else uses them, so the engine runs once per batch, and once per id.
    Completions are also saved as a table sorted by task, or as one directory per task, if asked for.
    """

    def written(df: DataFrame, table: str, batch_id: int) -> DataFrame:
        path = f"{folder}/{table}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def serve(batch: DataFrame, batch_id: int) -> None:
        arrived = written(with_rejection(batch), "arrived", batch_id)
        running_at = time.time()
        earlier = taken_before(batch.sparkSession, folder, batch_id, running_at - remember_seconds)
        checked = without_repeats(arrived, earlier).withColumn("taken_at", F.when(F.col("reason").isNull(), running_at))
        requests = valid_requests(written(checked, "requests", batch_id)).drop("taken_at")
        tasks = written(fan_in(answer_prompts(requests, engine, unique=True, **options)), "tasks", batch_id)
        started = requests.select(
            "task_id",
            F.inline(
                F.array(
                    F.struct(F.lit("queued").alias("status"), F.col("queued_at").alias("event_at")),
                    F.struct(F.lit("running").alias("status"), F.lit(running_at).alias("event_at")),
                )
            ),
        ).withColumn("error", F.lit(None).cast("string"))
        ended = tasks.select("task_id", "status", F.lit(time.time()).alias("event_at"), "error")
        written(started.unionByName(ended), "events", batch_id)
        if completions_table:
            write_task_batch(tasks, completions_table, batch_id)
        if completions_folder:
            save_task_completions(tasks, completions_folder)

    return (
        requests.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def served_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """The full record of every task served: state, times, completions and error."""
    tasks = spark.read.parquet(f"{folder}/tasks").groupBy("task_id").agg(
        F.max_by("completions", "batch_id").alias("completions")
    )
    return fold_task_events(spark.read.parquet(f"{folder}/events")).join(tasks, "task_id", "left")
