"""Which format, layout and instruction a row gets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.functions.chat import LAYOUTS, ChatLayout
from promptloom.functions.values import present, printed, stripped


def is_conversational(dataset_format: Column, chat_template: Column) -> Column:
    """Chat if the format says so; for any other format than chat or text, if there is a template.

    An empty template counts as one.
    """
    return (
        F.when(dataset_format == "conversational", F.lit(True))
        .when(dataset_format == "text", F.lit(False))
        .otherwise(chat_template.isNotNull())
    )


def resolved_format(config_format: Column, argument: str | None) -> Column:
    """The configuration's format wins over the argument, which fills a missing one."""
    return F.coalesce(present(config_format), F.lit(argument).cast("string"))


def resolved_instruction(
    config: Column, row: Column | None = None, default: str | None = None
) -> Column:
    """The first of configuration, row and default that the path honours."""
    choices = [present(config)]
    if row is not None:
        choices.append(row)
    if default is not None:
        choices.append(F.lit(default))
    return F.coalesce(*choices)


def layout_pieces(
    chat_template: Column, system: Column, layouts: Mapping[str, ChatLayout] = LAYOUTS
) -> Column:
    """What the named layout writes around a user's content; null for a name that is not a layout."""
    pieces = F.lit(None).cast("array<string>")
    for name, layout in layouts.items():
        pieces = F.when(chat_template == name, layout.pieces(system)).otherwise(pieces)
    return pieces


def trims_content(chat_template: Column, layouts: Mapping[str, ChatLayout] = LAYOUTS) -> Column:
    """Whether the named layout trims content; false without one."""
    trimming = [name for name, layout in layouts.items() if layout.trim_content]
    return F.coalesce(chat_template.isin(*trimming), F.lit(False)) if trimming else F.lit(False)


def joined_prompt(pieces: Column, prompt: Column, trim: Column) -> Column:
    """The prompt with its pieces around it: the prompt is what the array is joined with."""
    prompt = printed(prompt)
    return F.call_function("array_join", pieces, F.when(trim, stripped(prompt)).otherwise(prompt))
