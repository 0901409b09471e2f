import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.llm import repetition
from promptloom.llm.repetition import LENGTHS, MOST_LINE_PERCENT, MOST_PERCENT, _groups, measure
from tests.llm.rows import documents, nothing, sample

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    later = [line for n, line in enumerate(lines) if line in lines[:n]]
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(later),
        "line_chars": sum(map(len, lines)), "dup_line_chars": sum(map(len, later)),
    }
    for n in LENGTHS:
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times, seen, again, twice = Counter(windows), set(), set(), set()
        for i, window in enumerate(windows):
            if times[window] > 1:
                twice.update(range(i, i + n))
            if window in seen:
                again.update(range(i, i + n))
            seen.add(window)
        if n == 5:
            out["n_repeat_words"] = len(twice)
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in again)
    failed = out["n_words"] < 10 or 100 * out["n_repeat_words"] > 20 * out["n_words"]
    over = out["dup_line_chars"] * 100 > out["line_chars"] * MOST_LINE_PERCENT or any(
        out[f"dup_chars_{n}"] * 100 > out["word_chars"] * most for n, most in zip(LENGTHS, MOST_PERCENT, strict=True)
    )
    return out | {"base_failed": failed, "kept": not failed and not over}


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    texts = [(row.doc_id, row.text) for row in docs.collect() if row.text is None or len(row.text) < 30_000]
    wanted = sorted((str(i), sorted(brute(t or "").items())) for i, t in texts)
    result = repetition.quality_report(docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 30_000)).collect()
    got = sorted((str(r.doc_id), sorted((k, v) for k, v in r.asDict().items() if k != "doc_id")) for r in result)
    assert got == wanted


def test_periods_of_all_lengths():
    texts = [" ".join(f"w{i % period}" for i in range(40)) for period in range(1, 45)]
    got = measure(texts)
    for i, text in enumerate(texts):
        wanted = brute(text)
        assert {name: int(values[i]) for name, values in got.items()} == {name: wanted[name] for name in got}


def test_windows_with_one_hash_are_told_apart_by_their_words():
    starts = np.arange(6)
    hashes = np.zeros(6, dtype=np.uint64)
    words = np.array([1, 2, 1, 3, 2, 2])
    repeated, first = _groups(starts, hashes, [np.zeros(6, dtype=np.int64), words])
    assert sorted(zip(repeated.tolist(), first.tolist(), strict=True)) == [
        (0, True), (1, True), (2, False), (4, False), (5, False)
    ]


def test_passing_rows_keep_their_columns(spark):
    docs = documents(spark).withColumn("_repetition", F.lit(1))
    result = repetition.passing_documents(docs)
    assert result.columns == docs.columns
    wanted = [row.doc_id for row in docs.collect() if brute(row.text or "")["kept"]]
    assert sorted(map(str, wanted)) == sorted(str(row.doc_id) for row in result.collect())


def test_empty_table(spark):
    assert repetition.quality_report(nothing(spark)).collect() == []
    assert repetition.passing_documents(nothing(spark)).collect() == []
