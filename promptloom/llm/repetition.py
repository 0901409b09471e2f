"""Quality rules on repetition: characters inside duplicated n-grams and lines, measured per text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.common import ASCII_SPACE, ascii_words, mixed, slices, whole

SYMBOLS = "#*$%&|<>"
LENGTHS = (5, 6, 7, 8, 9, 10)
# Most of a text's word characters that may lie in later occurrences of n-grams of each length, in percent.
MOST_PERCENT = (15, 14, 13, 12, 11, 10)
# Most of a text's characters that may lie in repeated lines, in percent.
MOST_LINE_PERCENT = 20

_MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "dup_line_chars",
    *[f"dup_chars_{n}" for n in LENGTHS],
]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _groups(starts: np.ndarray, hashes: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows that occur twice or more, and whether each is the first of its kind.

    Windows are grouped by hash; neighbours in the order are then compared by all their words and
    their text. Should two different windows share a hash, the words themselves are the order.
    """
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    left, right = order[:-1][same], order[1:][same]
    if not all(np.array_equal(key[left], key[right]) for key in keys):
        order = np.lexsort(keys)
        same = np.logical_and.reduce([key[order[1:]] == key[order[:-1]] for key in keys])
    member = np.zeros(len(order), dtype=bool)
    member[1:] = same
    member[:-1] |= same
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    firsts = np.minimum.reduceat(starts[order], heads)
    first_of = np.repeat(firsts, np.diff(np.append(heads, len(order))))
    repeated = starts[order][member]
    return repeated, repeated == first_of[member]


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which words lie inside windows of n words with these starts."""
    steps = np.zeros(size + 1, dtype=np.int32)
    steps[starts] += 1
    steps[starts + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """The measures of each text; flat arrays over the words of all texts, windows within a text."""
    count = len(texts)
    out = {name: np.zeros(count, dtype=np.int64) for name in _MEASURES}
    index: dict[str, int] = {}
    numbers: list[int] = []
    lengths: list[int] = []
    for i, text in enumerate(texts):
        words = ascii_words(text)
        out["n_words"][i] = len(words)
        numbers += [index.setdefault(word, len(index)) for word in words]
        lengths += map(len, words)
        out["n_symbols"][i] = sum(map(text.count, SYMBOLS))
        lines = [line for line in text.split("\n") if line.strip(ASCII_SPACE)]
        out["line_chars"][i] = sum(map(len, lines))
        kinds = set(lines)
        out["n_dup_lines"][i] = len(lines) - len(kinds)
        out["dup_line_chars"][i] = out["line_chars"][i] - sum(map(len, kinds))
    size = len(numbers)
    if not size:
        return out
    ids, chars = np.array(numbers, dtype=np.int64), np.array(lengths, dtype=np.int64)
    ends = np.cumsum(out["n_words"])
    of = np.repeat(np.arange(count), out["n_words"])
    per_text = lambda values: np.bincount(of, weights=values, minlength=count).astype(np.int64)
    out["word_chars"] = per_text(chars)

    # The hash of a window of n words is the one of n - 1 words times the base, plus the next word.
    word_hash = mixed(ids)
    starts = np.arange(size)
    hashes = mixed(of + (1 << 40))
    n = 0
    while n < LENGTHS[-1] and len(starts):
        n += 1
        inside = starts + n <= ends[of[starts]]
        starts, hashes = starts[inside], hashes[inside]
        hashes = hashes * _BASE + word_hash[starts + n - 1]
        if n not in LENGTHS or not len(starts):
            continue
        keys = [of[starts], *[ids[starts + k] for k in range(n)]]
        repeated, first = _groups(starts, hashes, keys)
        if n == LENGTHS[0]:
            out["n_repeat_words"] = per_text(_covered(repeated, n, size))
        out[f"dup_chars_{n}"] = per_text(np.where(_covered(repeated[~first], n, size), chars, 0))
        # A longer window that is repeated starts with a repeated one.
        keep = np.isin(starts, repeated, assume_unique=True)
        starts, hashes = starts[keep], hashes[keep]
    return out


def repetition_measures(text: Column) -> Column:
    """The measures of each text as a struct; null is empty."""

    @pandas_udf(", ".join(f"{name} bigint" for name in _MEASURES))
    def measured(text: pd.Series) -> pd.DataFrame:
        texts = whole(text)
        parts = [measure(texts[a:b]) for a, b in slices(texts)] or [measure([])]
        return pd.DataFrame({name: np.concatenate([part[name] for part in parts]) for name in _MEASURES})

    return measured(text)


def base_failed(measures: Column) -> Column:
    words = measures["n_words"]
    return (words < 10) | (measures["n_repeat_words"] * 100 > words * 20)


def repetitive(measures: Column) -> Column:
    """Whether too many characters lie in later occurrences of n-grams, or in repeated lines."""
    verdict = measures["dup_line_chars"] * 100 > measures["line_chars"] * MOST_LINE_PERCENT
    for n, most in zip(LENGTHS, MOST_PERCENT, strict=True):
        verdict |= measures[f"dup_chars_{n}"] * 100 > measures["word_chars"] * most
    return verdict


def quality_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Measures and verdict of each document, one row for each row, without a shuffle.

    Null and empty texts have no words and fail; a text of any length is measured whole; repeated
    ids and rows are judged each by itself; null ids are kept; an empty table gives an empty one.
    """
    m = F.col("m")
    measured = docs.select(F.col(id_column).alias("doc_id"), repetition_measures(F.col(text_column)).alias("m"))
    return measured.select(
        "doc_id",
        *[m[name].alias(name) for name in _MEASURES],
        base_failed(m).alias("base_failed"),
        (~base_failed(m) & ~repetitive(m)).alias("kept"),
    )


def passing_documents(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that pass, with their columns."""
    m = "_repetition"
    while m in docs.columns:
        m += "_"
    measured = docs.withColumn(m, repetition_measures(F.col(text_column)))
    return measured.filter(~base_failed(F.col(m)) & ~repetitive(F.col(m))).drop(m)
