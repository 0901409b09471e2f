from string import Formatter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.constants import DEFAULT_TEXT_FORMAT
from promptloom.functions.decisions import joined_prompt
from promptloom.functions.templates import (
    filled_segments,
    format_text,
    parse_templates,
    pieces_around,
    template_pieces,
    template_segments,
)

NAMES = ("instruction", "input", "response")
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# Values may hold anything, braces and field names included.
value = st.one_of(st.none(), st.text("ab{}\n é", max_size=6), st.just("{input}"))
piece = st.sampled_from(["{{", "}}", "{instruction}", "{input}", "{response}", "a", "\n", " é", "'", "\\"])
named_templates = st.lists(piece, max_size=8).map("".join)
any_text = st.lists(st.sampled_from(["{", "}", "{}", "{0}", "{1}", "{2}", "{3}", "{x}", "{{", "}}", "t"]), max_size=6)


@FEW
@given(template=named_templates, values=st.lists(st.tuples(value, value, value), min_size=5, max_size=20))
def test_format_text_is_str_format(evaluate, template, values):
    column = format_text(template, **{n: F.col(n) for n in NAMES})
    got = evaluate(values, "instruction string, input string, response string", column)
    assert got == [template.format(**dict(zip(NAMES, row))) for row in values]


def formatted_by_row(spark, rows, schema, **parse):
    """Templates that come with the rows; (text, error) for each."""
    df = parse_templates(spark.createDataFrame(rows, schema), "template", **parse)
    names = parse.get("names") or [str(i) for i in range(parse["positions"])]
    columns = {n: F.col(c) for n, c in zip(names, NAMES)}
    return [tuple(r) for r in df.select(filled_segments(F.col("template_segments"), columns), "template_error").collect()]


@FEW
@given(rows=st.lists(st.tuples(named_templates, value, value, value), min_size=20, max_size=40))
def test_templates_in_rows_are_str_format(spark, rows):
    got = formatted_by_row(spark, rows, "template string, instruction string, input string, response string", names=NAMES)
    assert got == [(t.format(instruction=a, input=b, response=c), None) for t, a, b, c in rows]


@FEW
@given(rows=st.lists(st.tuples(named_templates, value, value, value), min_size=20, max_size=40))
def test_pieces_around_a_field_join_to_the_text(spark, rows):
    df = parse_templates(spark.createDataFrame(rows, "template string, a string, b string, c string"), "template", NAMES)
    others = {"instruction": F.col("a"), "response": F.col("c")}
    pieces = pieces_around(F.col("template_segments"), "input", others)
    got = [r[0] for r in df.select(joined_prompt(pieces, F.col("b"), F.lit(False))).collect()]
    assert got == [t.format(instruction=a, input=b, response=c) for t, a, b, c in rows]


@FEW
@given(rows=st.lists(st.tuples(any_text.map("".join), value, value, value), min_size=40, max_size=80))
def test_positional_templates_fail_where_str_format_fails(spark, rows):
    got = formatted_by_row(spark, rows, "template string, instruction string, input string, response string", positions=3)
    for (template, *values), (text, error) in zip(rows, got):
        try:
            expected = template.format(*values)
        except (KeyError, IndexError, ValueError):
            assert error is not None, template
        else:
            assert (text, error) == (expected, None), template


@pytest.mark.parametrize(
    "template, error",
    [
        ("{}{}{}{}", "Replacement index 3 out of range for positional args tuple"),
        ("{x}", "'x'"),
        ("a { b", "Single '{' encountered in format string"),
        ("a } b", "Single '}' encountered in format string"),
        ("{0:>10}", "Unsupported field {0:>10}"),
        ("{0!r}", "Unsupported field {0!r}"),
        ("{0.real}", "Unsupported field {0.real}"),
        ("{0[1]}", "Unsupported field {0[1]}"),
        ("{}{1}", "A template cannot mix {} and {0} fields"),
        ("", None),
        (None, None),
    ],
)
def test_template_errors(spark, template, error):
    df = spark.createDataFrame([(template,)], "template string")
    assert parse_templates(df, "template", positions=3).first()["template_error"] == error


def test_format_text_errors():
    one = F.lit("x")
    with pytest.raises(KeyError):
        format_text("{other}", input=one)
    with pytest.raises(IndexError):
        format_text("{}{}", positional=[one])
    for template in ("{input:>10}", "{input!r}", "{input.x}", "{input[0]}", "{}{0}", "{", "}"):
        with pytest.raises(ValueError):
            format_text(template, positional=[one], input=one)


def test_null_prints_none_and_braces_stay(evaluate):
    schema = "instruction string, input string, response string"
    got = evaluate([("{input}", "{{x}}", None)], schema, format_text(DEFAULT_TEXT_FORMAT, **{n: F.col(n) for n in NAMES}))
    assert got == ["### Instruction:\n{input}\n\n### Input:\n{{x}}\n\n### Response:\nNone"]


def test_literal_segments_equal_parsed_ones(spark):
    for template in (DEFAULT_TEXT_FORMAT, "{{a}} {input}", "{input}"):
        df = parse_templates(spark.createDataFrame([(template,)], "template string"), "template", names=NAMES)
        columns = {n: F.lit(n.upper()) for n in NAMES}
        filled = [filled_segments(s, columns) for s in (F.col("template_segments"), template_segments(template))]
        parsed, literal = df.select(*filled).first()
        values = {"instruction": "INSTRUCTION", "response": "RESPONSE"}
        known = template_pieces(template, "input", values)
        cut = pieces_around(F.col("template_segments"), "input", {n: F.lit(v) for n, v in values.items()})
        assert df.select(known).first()[0] == df.select(cut).first()[0]
        assert parsed == literal == template.format(**{n: n.upper() for n in NAMES})
        assert [f for _, f, _, _ in Formatter().parse(template) if f]
