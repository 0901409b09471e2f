"""Training projections: each example becomes a text or a list of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.constants import (
    COMPLETION,
    DEFAULT_TEXT_FORMAT,
    INPUT,
    INSTRUCTION,
    MESSAGES,
    TEXT,
    TRAINING_INSTRUCTION,
)
from promptloom.functions.chat import conversation
from promptloom.functions.decisions import is_conversational, resolved_instruction
from promptloom.functions.templates import filled_segments, format_text
from promptloom.functions.values import as_text, optional_text
from promptloom.operators.guards import require_columns


def construct_prompts(
    df: DataFrame,
    instruction: str | None = None,
    text_format: str | None = None,
    conversational: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The dataset as its single prompt column (`messages` or `text`), after any `keep` columns.

    Chat: the given instruction, else the row's own, else no system message. Text: the given
    instruction, else the helpful-assistant sentence; the row's own is not used.
    """
    require_columns(df, INPUT, COMPLETION, *keep)
    if conversational:
        row = F.col(INSTRUCTION).cast("string") if INSTRUCTION in df.columns else None
        system = resolved_instruction(optional_text(instruction), row)
        prompt = conversation(F.col(INPUT), system, F.col(COMPLETION)).alias(MESSAGES)
    else:
        types = {f.name: f.dataType for f in df.schema.fields}
        prompt = format_text(
            text_format or DEFAULT_TEXT_FORMAT,
            instruction=F.lit(instruction or TRAINING_INSTRUCTION),
            input=as_text(F.col(INPUT), types[INPUT], numeric_null="None"),
            response=as_text(F.col(COMPLETION), types[COMPLETION], numeric_null="None"),
        ).alias(TEXT)
    return df.select(*keep, prompt)


def construct_prompts_by_row(
    df: DataFrame, model_template: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Training prompts by the `config` that `attach_config` adds, so one job can mix them.

    Chat rows have `messages` and a null `text`, text rows the reverse. Only the model's own
    layout decides between them, never the configured one.
    """
    require_columns(df, INPUT, COMPLETION, "config", *keep)
    config, types = F.col("config"), {f.name: f.dataType for f in df.schema.fields}
    row = F.col(INSTRUCTION).cast("string") if INSTRUCTION in df.columns else None
    system = resolved_instruction(config["instruction"], row)
    values = {
        "instruction": F.coalesce(config["instruction"], F.lit(TRAINING_INSTRUCTION)),
        "input": as_text(F.col(INPUT), types[INPUT], numeric_null="None"),
        "response": as_text(F.col(COMPLETION), types[COMPLETION], numeric_null="None"),
    }
    chat = is_conversational(config["dataset_format"], F.lit(model_template).cast("string"))
    return df.select(
        *keep,
        F.when(chat, conversation(F.col(INPUT), system, F.col(COMPLETION))).alias(MESSAGES),
        F.when(~chat, filled_segments(config["text_segments"], values)).alias(TEXT),
    )
