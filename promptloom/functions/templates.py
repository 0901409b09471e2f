"""Text templates with `{name}` or `{}` fields and `{{` / `}}` escapes.

A template known when the job is written becomes one `concat`. A template that comes with
the data (a request, a configuration table) is cut into segments once per request or
configuration, and the segments are put together for each row. Values are never searched
for fields, so braces inside a value stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.functions.values import printed

SEGMENTS = "array<struct<literal: string, field: string>>"
_TOKENS = r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"


def format_text(template: str, positional: Sequence[Column] = (), **named: Column) -> Column:
    """The template filled with columns, as a single expression.

    An unknown name raises KeyError and a position out of range IndexError, both while the
    job is built. Format specs, conversions and attribute access raise ValueError.
    """
    parts, numbering, position = [], set(), 0
    for literal, field, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if spec or conversion or any(c in field for c in ".["):
            raise ValueError(f"Unsupported field {{{field}}} with spec {spec!r} and conversion {conversion!r}")
        if field and not field.isdigit():
            parts.append(printed(named[field]))
            continue
        numbering.add("manual" if field else "automatic")
        if len(numbering) > 1:
            raise ValueError("A template cannot mix {} and {0} fields")
        index = int(field) if field else position
        position += 1
        if index >= len(positional):
            raise IndexError(f"Replacement index {index} out of range for positional args tuple")
        parts.append(printed(positional[index]))
    return F.concat(*parts) if parts else F.lit("")


def parse_templates(
    df: DataFrame, template: str, names: Sequence[str] = (), positions: int = 0, prefix: str = "template"
) -> DataFrame:
    """Rows with `<prefix>_segments` and `<prefix>_error` for the template in a column.

    A segment is a literal, or the name or position of a field. The error is the first thing
    wrong with the template, in the words of the exception; a null template has neither.
    """
    known = ", ".join(f"'{name}'" for name in names) or "NULL"
    return (
        df.withColumn("_tokens", F.regexp_extract_all(template, F.lit(_TOKENS), F.lit(0)))
        .withColumn("_manual", F.expr(r"exists(_tokens, t -> t RLIKE '^\\{[0-9]+\\}$')"))
        # `field` is null for literal text, and the running number of an automatic field.
        .withColumn("_pieces", F.expr("""
            transform(_tokens, (t, i) -> named_struct(
              'token', t,
              'field', CASE
                WHEN t = '{}' THEN string(size(filter(slice(_tokens, 1, i), e -> e = '{}')))
                WHEN length(t) > 2 AND startswith(t, '{') AND endswith(t, '}') THEN substr(t, 2, length(t) - 2)
              END))"""))
        .withColumn(f"{prefix}_segments", F.expr("""
            transform(_pieces, p -> named_struct(
              'literal', CASE
                WHEN p.field IS NOT NULL THEN NULL
                WHEN p.token = '{{' THEN '{' WHEN p.token = '}}' THEN '}' ELSE p.token END,
              'field', p.field))"""))
        .withColumn(f"{prefix}_error", F.expr(f"""
            try_element_at(filter(transform(_pieces, p -> CASE
              WHEN p.token IN ('{{', '}}') THEN concat("Single '", p.token, "' encountered in format string")
              WHEN p.field IS NULL THEN NULL
              WHEN p.field RLIKE '[:!.\\\\[]' THEN concat('Unsupported field ', p.token)
              WHEN p.token = '{{}}' AND _manual THEN 'A template cannot mix {{}} and {{0}} fields'
              WHEN p.field RLIKE '^[0-9]+$' THEN
                CASE WHEN NOT coalesce(try_cast(p.field AS int) < {positions}, false)
                THEN concat('Replacement index ', p.field, ' out of range for positional args tuple') END
              WHEN NOT coalesce(p.field IN ({known}), false) THEN concat("'", p.field, "'")
            END), e -> e IS NOT NULL), 1)"""))
        .drop("_tokens", "_manual", "_pieces")
    )


def template_segments(template: str) -> Column:
    """A template known when the job is written, as the segments of a parsed one."""
    segments = [
        F.struct(F.lit(literal).alias("literal"), F.lit(field).cast("string").alias("field"))
        for text, name, _, _ in Formatter().parse(template)
        for literal, field in ((text or None, None), (None, name))
        if literal is not None or field is not None
    ]
    return F.array(*segments).cast(SEGMENTS)


def template_pieces(template: str, field: str, values: Mapping[str, str]) -> Column:
    """`pieces_around` for a template and values known when the job is written."""
    pieces = [""]
    for literal, name, _, _ in Formatter().parse(template):
        pieces[-1] += literal
        if name == field:
            pieces.append("")
        elif name is not None:
            pieces[-1] += values[name]
    return F.array(*[F.lit(piece) for piece in pieces])


def filled_segments(segments: Column, values: Mapping[str, Column]) -> Column:
    """Segments put together with this row's values; keys are field names or positions."""
    return F.array_join(F.transform(segments, lambda segment: _text_of(segment, values)), "")


def pieces_around(segments: Column, field: str, values: Mapping[str, Column]) -> Column:
    """Segments with all fields but one put in, cut where that one goes.

    The pieces joined with that field's value are the text. Work that is the same for many rows, those of one
    request or configuration, is so done once.
    """

    def add(pieces: Column, segment: Column) -> Column:
        # A field that no value is given for, in a template with an error, leaves no null behind.
        longer = F.coalesce(F.concat(F.element_at(pieces, -1), _text_of(segment, values)), F.lit(""))
        grown = F.concat(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.array(longer))
        return F.when(segment["field"] == field, F.concat(pieces, F.array(F.lit("")))).otherwise(grown)

    return F.aggregate(segments, F.array(F.lit("")), add)


def _text_of(segment: Column, values: Mapping[str, Column]) -> Column:
    text = segment["literal"]
    for field, value in values.items():
        text = F.when(segment["field"] == field, printed(value)).otherwise(text)
    return text
