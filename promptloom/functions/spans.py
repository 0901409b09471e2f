"""Which parts of a training example are targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.functions.values import optional_text, present


def response_spans(text: Column, instruction_part: str | Column, response_part: str | Column) -> Column:
    """A rendered example as array<struct<context, target>>.

    A target runs from a response marker to the next instruction marker, or to the end. The
    text in front of the first instruction marker counts only if it holds a response; any
    later piece without a response has a null target. Markers may differ by row; without both
    of them a row has no spans.
    """
    for marker in (instruction_part, response_part):
        if not isinstance(marker, Column) and not marker:
            raise ValueError("Response-only targets need both an instruction and a response marker")
    instruction_part, response_part = (optional_text(m) for m in (instruction_part, response_part))

    def span(piece: Column) -> Column:
        at = F.instr(piece, response_part)
        start = at + F.length(response_part)
        return F.struct(
            F.when(at > 0, F.substr(piece, F.lit(1), at - 1)).otherwise(piece).alias("context"),
            F.when(at > 0, F.substr(piece, start)).alias("target"),
        )

    spans = F.transform(F.split(text, _quoted(instruction_part), -1), span)
    marked = present(instruction_part).isNotNull() & present(response_part).isNotNull()
    return F.when(marked, F.filter(spans, lambda s, i: (i > 0) | s["target"].isNotNull()))


def message_targets(messages: Column) -> Column:
    """Messages with a flag: the assistant's turns are the targets."""
    return F.transform(
        messages,
        lambda m: F.struct(
            m["role"].alias("role"), m["content"].alias("content"), (m["role"] == "assistant").alias("is_target")
        ),
    )


def _quoted(marker: Column) -> Column:
    r"""The marker as a literal pattern; a `\E` inside it closes the quote and is quoted again."""
    return F.concat(F.lit(r"\Q"), F.replace(marker, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
