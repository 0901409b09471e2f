import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.functions.spans import response_spans


def expected(text, instruction, response):
    spans = []
    for i, piece in enumerate(text.split(instruction)):
        context, marker, target = piece.partition(response)
        if marker:
            spans.append((context, target))
        elif i:
            spans.append((piece, None))
    return spans


CASES = [
    ("no marker at all", "<Q>", "<A>"),
    ("<Q>ask<A>answer", "<Q>", "<A>"),
    ("intro<Q>ask<A>answer<Q>again<A>", "<Q>", "<A>"),
    ("<A>early answer<Q>ask", "<Q>", "<A>"),
    ("<Q>ask<A>one<A>two<Q><A>three", "<Q>", "<A>"),
    ("<Q><Q><A>", "<Q>", "<A>"),
    ("a.*b(c[a.*b(c[", "a.*b(", "c["),
    (r"x\Ey$1x\Ey$1", r"x\E", "$1"),
    ("", "<Q>", "<A>"),
]


@pytest.mark.parametrize("text, instruction, response", CASES)
def test_spans(evaluate, text, instruction, response):
    got = evaluate([(text,)], "t string", response_spans(F.col("t"), instruction, response))
    assert [tuple(s) for s in got[0]] == expected(text, instruction, response)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(st.sampled_from(["[Q]", "[A]", "x", "\n", "é[", "]"]), max_size=10).map("".join), min_size=30))
def test_spans_of_any_text(evaluate, texts):
    got = evaluate([(t,) for t in texts], "t string", response_spans(F.col("t"), "[Q]", "[A]"))
    assert [[tuple(s) for s in spans] for spans in got] == [expected(t, "[Q]", "[A]") for t in texts]


def test_markers_by_row(spark):
    rows = [(*case, str(i)) for i, case in enumerate(CASES)] + [("x", None, "<A>", "n"), ("x", "<Q>", "", "e")]
    df = spark.createDataFrame(rows, "t string, q string, a string, id string")
    got = {r.id: r.s for r in df.select("id", response_spans(F.col("t"), F.col("q"), F.col("a")).alias("s")).collect()}
    assert got.pop("n") is None and got.pop("e") is None
    assert {i: [tuple(s) for s in spans] for i, spans in got.items()} == {
        str(i): expected(*case) for i, case in enumerate(CASES)
    }


def test_both_markers_are_needed():
    for markers in (("", "x"), ("x", ""), (None, "x")):
        with pytest.raises(ValueError):
            response_spans(F.col("t"), *markers)
