"""Quality by ordinal regression: one set of hashed-text weights, ordered thresholds between the grades."""

from __future__ import annotations

import pickle
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.common import mixed, slices, whole
from promptloom.llm.labelled import Adam, Features, fit, held_out, word_hash

MOST_ROWS = 8000
BITS = 18
_SIZE = 1 << BITS
_MASK = np.uint64(_SIZE - 1)
_UPPER, _LOWER, _DIGIT = re.compile("[A-Z]+"), re.compile("[a-z]+|[^\x00-\x7f]+"), re.compile("[0-9]+")


def _shape(word: str) -> str:
    """Letters by case, digits and marks, runs as one, of the whole word: 'Don't!!' is 'Aa'a!!'."""
    return _DIGIT.sub("9", _LOWER.sub("a", _UPPER.sub("A", word)))


def _features(word: str) -> tuple[int, int]:
    return word_hash(word.lower()) & (_SIZE - 1), word_hash("shape " + _shape(word)) & (_SIZE - 1)


def _bucket(name: str, values: np.ndarray) -> np.ndarray:
    """Feature of a number that says something of a whole text."""
    seed = np.uint64(word_hash(name))
    return (mixed(values.astype(np.uint64) ^ seed) & _MASK).astype(np.int64)


def vectors(texts: list[str], features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the texts' hashed features.

    A text's words, their shapes, pairs of neighbouring shapes and repeats of the word before count
    with the root of their share; its length and its share of distinct words count by bucket.
    """
    found: list[tuple[int, int]] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    distinct = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        counts[i], distinct[i] = len(words), len(set(words))
        found += map(features.__getitem__, words)
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    row = np.repeat(np.arange(len(texts)), counts)
    word, shape = pairs[:, 0], pairs[:, 1]
    next_to = row[1:] == row[:-1]
    again = next_to & (word[1:] == word[:-1])
    couple = (mixed(shape[:-1] * _SIZE + shape[1:]) & _MASK).astype(np.int64)[next_to]
    repeat = np.full(int(again.sum()), word_hash("again") & (_SIZE - 1), dtype=np.int64)
    parts = [(row, word), (row, shape), (row[1:][next_to], couple), (row[1:][again], repeat)]
    rows, columns, values = [], [], []
    for at, column in parts:
        both, times = np.unique(at * _SIZE + column, return_counts=True)
        rows.append(both // _SIZE)
        columns.append(both % _SIZE)
        values.append(np.sqrt(times / np.maximum(counts, 1)[rows[-1]]))
    texts_at = np.arange(len(texts))
    for name, bucket in (
        ("length", np.log2(counts + 1).astype(np.int64)),
        ("distinct", 10 * distinct // np.maximum(counts, 1)),
    ):
        rows.append(texts_at)
        columns.append(_bucket(name, bucket))
        values.append(np.full(len(texts), 0.5))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def train(texts: list[str], grades: np.ndarray, epochs: int = 200, shrink: float = 1e-5) -> bytes:
    """Weights and thresholds that climb the log-likelihood of P(grade >= k) = sigmoid(score - threshold k).

    Thresholds are a first one and positive steps, so they stay in order. Grades are the distinct
    values seen, in ascending order; with none seen the model has the one grade 0.
    """
    levels, grade = np.unique(grades, return_inverse=True)
    if not len(levels):
        return pickle.dumps((np.zeros(_SIZE, dtype=np.float32), np.empty(0), np.zeros(1)))
    rows, columns, values = [], [], []
    features = Features(_features)
    for a, b in slices(texts):
        row, column, value = vectors(texts[a:b], features)
        rows.append(row + a)
        columns.append(column)
        values.append(value)
    row, column, value = np.concatenate(rows), np.concatenate(columns), np.concatenate(values)
    seen, column = np.unique(column, return_inverse=True)
    steps = len(levels) - 1
    weights, first, widths = np.zeros(len(seen)), -1.0, np.zeros(max(0, steps - 1))
    n = len(texts)
    adam = Adam(len(seen) + steps, 0.05)
    at = np.arange(n)
    thresholds = np.empty(0)
    for _ in range(epochs if steps else 0):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(widths))])
        score = np.bincount(row, weights=value * weights[column], minlength=n)
        above = _sigmoid(score[:, None] - thresholds)  # P(grade >= k), k from 1 on
        full = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        own = np.maximum(full[at, grade] - full[at, grade + 1], 1e-9)
        slopes = above * (1 - above)
        slope_low = np.hstack([np.zeros((n, 1)), slopes])[at, grade]
        slope_high = np.hstack([slopes, np.zeros((n, 1))])[at, grade]
        by_score = -(slope_low - slope_high) / own / n
        by_threshold = np.zeros(steps)
        has = grade > 0
        np.add.at(by_threshold, grade[has] - 1, (slope_low / own / n)[has])
        has = grade < steps
        np.add.at(by_threshold, grade[has], (-slope_high / own / n)[has])
        tails = np.cumsum(by_threshold[::-1])[::-1]  # a step moves all thresholds after it
        by_weight = np.bincount(column, weights=by_score[row] * value, minlength=len(seen)) + shrink * weights
        change = adam.step(np.concatenate([by_weight, [tails[0]], tails[1:] * np.exp(widths)]))
        weights -= change[: len(seen)]
        first -= change[len(seen)]
        widths -= change[len(seen) + 1 :]
    dense = np.zeros(_SIZE, dtype=np.float32)
    dense[seen] = weights
    if steps:
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(widths))])
    return pickle.dumps((dense, thresholds, levels))


class Model:
    def __init__(self, data: bytes) -> None:
        self.weights, self.thresholds, self.levels = pickle.loads(data)
        self.features = Features(_features)

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probabilities of each grade above the lowest or a higher one."""
        self.features.forget()
        row, column, value = vectors(texts, self.features)
        score = np.bincount(row, weights=value * self.weights[column], minlength=len(texts))
        above = _sigmoid(score[:, None] - self.thresholds[None, :])
        return self.levels[0] + above @ np.diff(self.levels), above


_models: dict[int, Model] = {}


def _loaded(data: bytes) -> Model:
    key = hash(data)
    if key not in _models:
        _models.clear()
        _models[key] = Model(data)
    return _models[key]


def quality(text: Column, model: bytes) -> Column:
    """Expected grade of each text, and P(grade or higher) for each grade above the lowest."""

    @pandas_udf("expected double, tails array<double>")
    def scored(text: pd.Series) -> pd.DataFrame:
        found, texts = _loaded(model), whole(text)
        expected, tails = [np.empty(0)], []
        for a, b in slices(texts):
            grade, above = found.score(texts[a:b])
            expected.append(grade)
            tails += above.tolist()
        return pd.DataFrame({"expected": np.concatenate(expected), "tails": tails})

    return scored(text)


def quality_model(docs: DataFrame, labels: DataFrame, grade: Column, most_rows: int = MOST_ROWS) -> bytes:
    """A model fitted on at most `most_rows` graded documents outside the held-out fold."""
    return fit(docs, labels, grade, train, most_rows)


def graded_documents(
    docs: DataFrame, model: bytes, least: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Grade of every row, whole texts, no shuffle: doc_id, held_out, expected_grade, tails, kept.

    `tails[k]` is the probability of the (k+2)nd grade or a higher one; `kept` says that a grade
    above the lowest has a probability of `least` or more. Null and empty texts have no words and
    are graded by their length; rows are graded each by itself, repeated ones alike; a null id
    counts as held out; without graded rows all texts have the grade 0 and are kept.
    """
    result = docs.select(F.col(id_column).alias("doc_id"), quality(F.col(text_column), model).alias("r"))
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("r.expected").alias("expected_grade"),
        "r.tails",
        F.coalesce(F.get("r.tails", F.lit(0)) >= least, F.lit(True)).alias("kept"),
    )
