"""Training on labelled documents: a bounded sample, brought to one task and fitted there."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.llm.common import whole, written

# Fold of a document: held out of training if it is HELD_OUT.
FOLDS, HELD_OUT = 4, 2
# Characters of all texts that a model is fitted on; one text has a sixteenth of them at most.
MOST_CHARS, LONGEST = 64_000_000, 16


def held_out(id_column: Column) -> Column:
    """Whether a document's labels are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    train: Callable[[list[str], np.ndarray], bytes],
    most_rows: int,
    names: tuple[str, str] = ("doc_id", "text"),
) -> bytes:
    """The model that `train` makes of at most `most_rows` labelled texts that are not held out, of
    `MOST_CHARS` characters together.

    Labelled ids are taken in the order of a hash, so that the sample is the same for the same rows
    and favours none; of an id's grades the least counts, of its texts the one with the least hash.
    Rows without a grade or an id, rows held out, and texts of over a `LONGEST`th of all characters
    are left out; so are those with which the characters would be more. Bounds hold after the join,
    whatever repeats.
    """
    id_column, text_column = names
    graded = labels.select(F.col(id_column).alias("doc_id"), grade.cast("double").alias("grade"))
    usable = graded.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    turn = F.xxhash64(F.col("doc_id"), F.lit(17))
    sample = usable.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(turn, "doc_id").limit(most_rows)
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    short = texts.filter(F.length("text") <= MOST_CHARS // LONGEST).join(F.broadcast(sample), "doc_id")
    # Reduced before the shuffle, so an id with very many rows is one row of each task.
    single = short.groupBy("doc_id").agg(
        F.min_by("text", F.struct("text_key", "text")).alias("text"), F.first("grade").alias("grade")
    )
    single = written(single)
    # Over at most `most_rows` ids with lengths.
    so_far = F.sum("chars").over(Window.orderBy("turn", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lengths = single.select("doc_id", F.length("text").alias("chars"), turn.alias("turn"))
    fitting = lengths.withColumn("so_far", so_far).filter(F.col("so_far") <= MOST_CHARS).select("doc_id")
    joined = single.join(F.broadcast(fitting), "doc_id").select("doc_id", "text", "grade")

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [part for part in batches if len(part)]
        if parts:
            rows = pd.concat(parts).sort_values(["doc_id", "text"])
            yield pd.DataFrame({"model": [train(whole(rows["text"]), rows["grade"].to_numpy())]})

    found = joined.repartition(1).mapInPandas(fitted, "model binary").collect()
    return bytes(found[0]["model"]) if found else train([], np.empty(0))


def word_hash(word: str) -> int:
    """63 bits of a digest, the same in every process."""
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little") >> 1


class Features(dict):
    """Number of a feature kept by word; what is kept is bounded by `forget`."""

    def __init__(self, of: Callable[[str], object], most: int = 400_000) -> None:
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word: str):
        value = self[word] = self.of(word)
        return value

    def forget(self) -> None:
        if len(self) > self.most:
            self.clear()


class Adam:
    """Steps along a gradient, scaled by its running mean and variance."""

    def __init__(self, size: int, rate: float) -> None:
        self.rate, self.steps = rate, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.01 * (gradient * gradient - self.square)
        mean = self.mean / (1 - 0.9**self.steps)
        square = self.square / (1 - 0.99**self.steps)
        return self.rate * mean / (np.sqrt(square) + 1e-8)
