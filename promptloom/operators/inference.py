"""Inference prompts: input text, and its rendering by the configuration."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.constants import DEFAULT_TEXT_FORMAT, INFERENCE, INPUT
from promptloom.functions.chat import CHATML, LAYOUTS, ChatLayout
from promptloom.functions.chat_templates import template_layouts
from promptloom.functions.decisions import joined_prompt
from promptloom.functions.templates import format_text
from promptloom.functions.values import as_text
from promptloom.operators.configs import require_layout
from promptloom.operators.guards import require_columns

logger = logging.getLogger(__name__)

PROMPT = "prompt"


def input_prompts(df: DataFrame, input_column: str = INPUT, prompt_column: str = PROMPT) -> DataFrame:
    """The rows with their input as prompt text."""
    require_columns(df, input_column)
    return df.withColumn(prompt_column, as_text(F.col(input_column), df.schema[input_column].dataType))


def format_prompts(
    df: DataFrame,
    config: Mapping[str, str | None] | None = None,
    model_template: str | None = None,
    layouts: Mapping[str, ChatLayout] = LAYOUTS,
    prompt_column: str = PROMPT,
) -> DataFrame:
    """Prompts rendered by one configuration for the whole job.

    `model_template` names the layout the model itself comes with, if it is a chat model, or is a chat
    template as text. A configured `chat_template`, either of these too, replaces it. Chat without any layout uses ChatML. The row's own
    instruction is not used on this path.
    """
    config = {k: v for k, v in (config or {}).items() if v}
    instruction = config.get("instruction")
    template = config.get("chat_template", model_template)
    dataset_format = config.get("dataset_format")
    chat = template is not None if dataset_format not in ("conversational", "text") else dataset_format == "conversational"
    prompt = F.col(prompt_column)
    if chat:
        layouts = {**layouts, **template_layouts(template)}
        require_layout(template, layouts)
        layout = layouts[template] if template is not None else CHATML
        rendered = layout.prompt(prompt, F.lit(instruction) if instruction else None)
    else:
        rendered = format_text(
            config.get("text_format", DEFAULT_TEXT_FORMAT),
            instruction=F.lit(instruction or ""),
            input=prompt,
            response=F.lit(""),
        )
    return df.withColumn(prompt_column, rendered)


def format_prompts_by_row(df: DataFrame, prompt_column: str = PROMPT) -> DataFrame:
    """Prompts rendered by the `config` that `attach_config` adds, so one job can mix them."""
    config, prompt = F.col("config"), F.col(prompt_column)
    return df.withColumn(prompt_column, joined_prompt(config["prompt_pieces"], prompt, config["trims_input"]))


def with_completions(df: DataFrame, completions: Column, output_column: str = INFERENCE) -> DataFrame:
    """The rows with the completion column; one of that name is replaced where it stands."""
    if output_column in df.columns:
        logger.warning("Replacing the values of column %r", output_column)
    return df.withColumn(output_column, completions)
