"""Prompt configurations joined to datasets."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.constants import CONFIG_KEYS, DEFAULT_TEXT_FORMAT
from promptloom.functions.chat import CHATML, LAYOUTS, ChatLayout
from promptloom.functions.chat_templates import template_layouts
from promptloom.functions.decisions import is_conversational, layout_pieces, resolved_format, trims_content
from promptloom.functions.templates import parse_templates, pieces_around, template_pieces, template_segments
from promptloom.functions.values import present
from promptloom.operators.positions import bounded_broadcast

logger = logging.getLogger(__name__)

TEMPLATE_FIELDS = ("instruction", "input", "response")


def merge_config(config: Mapping[str, str | None] | None, dataset_format: str | None = None) -> dict[str, str]:
    """One configuration merged with the format argument; the configuration's own format wins."""
    merged = {k: v for k, v in (config or {}).items() if v is not None}
    if dataset_format:
        if merged.get("dataset_format"):
            logger.warning("The configuration sets format %r, ignoring %r", merged["dataset_format"], dataset_format)
        else:
            merged["dataset_format"] = dataset_format
    return merged


def attach_config(
    df: DataFrame,
    configs: DataFrame,
    on: Sequence[str] = ("dataset_name", "dataset_config"),
    dataset_format: str | None = None,
    model_template: str | None = None,
    layouts: Mapping[str, ChatLayout] = LAYOUTS,
) -> DataFrame:
    """Rows with their configuration as a struct `config`; without one, what an empty one gives.

    `model_template` names the layout the model itself comes with, if it is a chat model. What
    a configuration makes of its rows is worked out once for each: `text_segments` is its
    text format cut up, `prompt_pieces` what an inference prompt has around the input, in the
    format decided on. A template that cannot be formatted, a layout that is not known and a
    configuration that appears twice raise here. The configurations are broadcast if their bytes
    are few; above the bound it is an ordinary join, where adaptive execution splits a key that
    holds too many rows.
    """
    layouts = {**layouts, **template_layouts(model_template)}
    require_layout(model_template, layouts)
    on = list(on)
    template = F.coalesce(present(F.col("text_format")), F.lit(DEFAULT_TEXT_FORMAT))
    parsed = parse_templates(
        configs.withColumn("text_format", template), "text_format", names=TEMPLATE_FIELDS, prefix="text"
    )
    unknown_layout = present(F.col("chat_template")).isNotNull() & ~F.col("chat_template").isin(*layouts)
    summary = (
        parsed.groupBy(*on)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("text_error").alias("text_error"),
            F.min(F.when(unknown_layout, F.col("chat_template"))).alias("unknown_layout"),
            F.sum(_text_bytes(parsed, [*on, *CONFIG_KEYS])).alias("bytes"),
        )
        .agg(F.sum("bytes"), F.max("rows"), F.min("text_error"), F.min("unknown_layout"))
    )
    size, most, text_error, layout = summary.first()
    if text_error is not None:
        raise ValueError(f"Text format of a configuration: {text_error}")
    if layout is not None:
        raise ValueError(f"Unknown chat layout {layout!r}, known are {', '.join(layouts)}")
    if (most or 0) > 1:
        raise ValueError(f"A configuration appears more than once for {', '.join(on)}")
    fields = {
        "dataset_format": resolved_format(F.col("dataset_format"), dataset_format),
        "text_segments": F.col("text_segments"),
        **{c: present(F.col(c)) for c in CONFIG_KEYS if c not in ("dataset_format", "text_format")},
    }
    fields = {name: value for name, value in fields.items() if name in parsed.columns}
    given = {"instruction": F.coalesce(fields["instruction"], F.lit("")), "response": F.lit("")}
    text_pieces = pieces_around(F.col("text_segments"), "input", given)
    side = parsed.select(*on, _config_struct(fields, text_pieces, model_template, layouts).alias("config"))
    # A row holds its texts, its template cut up, and the prompt's pieces, which repeat both.
    side = bounded_broadcast(side, 3 * (size or 0))
    nothing = {name: F.lit(None).cast("string") for name in fields} | {
        "dataset_format": F.lit(dataset_format).cast("string"),
        "text_segments": template_segments(DEFAULT_TEXT_FORMAT),
    }
    plain_pieces = template_pieces(DEFAULT_TEXT_FORMAT, "input", {"instruction": "", "response": ""})
    without = _config_struct(nothing, plain_pieces, model_template, layouts)
    return df.join(side, on, "left").withColumn("config", F.coalesce(F.col("config"), without))


def _config_struct(
    fields: Mapping[str, Column],
    text_pieces: Column,
    model_template: str | None,
    layouts: Mapping[str, ChatLayout],
) -> Column:
    """A configuration's fields with the pieces of its inference prompts.

    Chat without any layout uses ChatML. The row's own instruction is not used on this path.
    """
    instruction = fields["instruction"]
    template = F.coalesce(fields["chat_template"], F.lit(model_template).cast("string"))
    is_chat = is_conversational(fields["dataset_format"], template)
    chat = F.when(template.isNull(), CHATML.pieces(instruction)).otherwise(
        layout_pieces(template, instruction, layouts)
    )
    return F.struct(
        *[value.alias(name) for name, value in fields.items()],
        F.when(is_chat, chat).otherwise(text_pieces).alias("prompt_pieces"),
        (is_chat & trims_content(template, layouts)).alias("trims_input"),
    )


def _text_bytes(df: DataFrame, columns: Sequence[str]) -> Column:
    """Bytes of a row's texts, with some for each column."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns if c in df.columns]
    return sum(sizes, F.lit(32 * len(sizes))).cast("bigint")


def require_layout(name: str | None, layouts: Mapping[str, ChatLayout]) -> None:
    if name is not None and name not in layouts:
        raise ValueError(f"Unknown chat layout {name!r}, known are {', '.join(layouts)}")
