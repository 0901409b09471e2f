"""What several operators need: batches by size, white space, hashes, tables in the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.session import shared_folder

# White space of the word rule [^\x20\x09-\x0D]+, as patterns for the JVM and for Python.
WORD = "[^\\x20\\x09-\\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"
_ASCII_RUN = re.compile("[\x20\x09-\x0d]+")
# What str.split() takes for white space besides.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def ascii_words(text: str) -> list[str]:
    """Runs of anything but the six ASCII white-space characters."""
    if _OTHER_SPACE.search(text) is None:
        return text.split()
    return [word for word in _ASCII_RUN.split(text) if word]


def slices(texts: Sequence[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters, one text at least: what is held at once is bounded."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > chars:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def whole(texts) -> list[str]:
    """Texts of a batch; null is empty."""
    return ["" if text is None else text for text in texts]


def mixed(numbers: np.ndarray) -> np.ndarray:
    """64-bit integers spread over all 64 bits (the finaliser of splitmix64)."""
    x = numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, dtype=np.int64) - before, lengths) + np.arange(int(lengths.sum()))


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and there when executors are lost."""
    folder = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table that `written` made and that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def fraction_of(key: Column, seed: str) -> Column:
    """A fraction from 0 to 1 that depends on the key alone: 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))
