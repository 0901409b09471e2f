"""Token ids of words kept by word: texts are split at white space and each new word is encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from promptloom.llm.common import ranges, slices

# The white space of tokenizers' pattern \s; str.split() also takes \x1c to \x1f.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
# A column is encoded in blocks of so many bytes and a text.
_BLOCK_BYTES = 4_000_000


def white_space_split(text: str) -> list[str]:
    if _SEPARATORS.search(text) is None:
        return text.split()
    return [word for word in _SPACE.split(text) if word]


class _Numbers(dict):
    """Numbers words in the order in which they first appear; `new` holds those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTable:
    """Encodes texts by a function that encodes words; for tokenizers that drop white space.

    `encode_words` gives the ids of all words one after the other, and how many each word has. What
    is kept is bounded: beyond so many words or characters the table begins anew.
    """

    def __init__(
        self,
        encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        most_words: int = 400_000,
        most_chars: int = 16_000_000,
    ) -> None:
        self.encode_words, self.most_words, self.most_chars = encode_words, most_words, most_chars
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.chars = _Numbers(), 0
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 16, dtype=np.int64)  # of the word before, then of each word
        self.words = 0

    def _grown(self, array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        larger = np.empty(max(size, 2 * len(array)), dtype=array.dtype)
        larger[: len(array)] = array
        return larger

    def _take_up_new(self) -> None:
        new = self.numbers.new
        if not new:
            return
        ids, lengths = self.encode_words(new)
        start = int(self.ends[self.words])
        self.ids = self._grown(self.ids, start + len(ids))
        self.ids[start : start + len(ids)] = ids
        self.ends = self._grown(self.ends, self.words + len(new) + 1)
        self.ends[self.words + 1 : self.words + len(new) + 1] = start + np.cumsum(lengths)
        self.words += len(new)
        self.chars += sum(map(len, new))
        self.numbers.new = []

    def renew(self) -> None:
        """Begins anew if the bounds are reached."""
        if self.words > self.most_words or self.chars > self.most_chars:
            self._clear()

    def encode_split(self, words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each run of so many words has."""
        return self._encoded(self._numbered(words), counts)

    def _numbered(self, words: list[str]) -> np.ndarray:
        number = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))
        self._take_up_new()
        return number

    def _encoded(self, number: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.ends[number]
        lengths = self.ends[number + 1] - starts
        total = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[ranges(starts, lengths)], np.diff(total[edges])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        parts, counts = [np.empty(0, dtype=np.uint32)], [np.empty(0, dtype=np.int64)]
        for a, b in slices(texts):
            self.renew()
            words: list[str] = []
            split = np.empty(b - a, dtype=np.int64)
            for i, text in enumerate(texts[a:b]):
                own = white_space_split(text)
                split[i] = len(own)
                words += own
            ids, found = self.encode_split(words, split)
            parts.append(ids)
            counts.append(found)
        return np.concatenate(parts), np.concatenate(counts)

    def encode_column(
        self, texts: pa.Array, apart: Callable[[pa.Array], tuple[pa.Array, np.ndarray]]
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """As `encode`, for a column without nulls, block by block: the first text of a block, the ids
        of its texts, and how many each has. Arrow splits texts at ASCII white space, as other white
        space is left to `encode_words`, and finds the distinct words, so that Python sees each of them
        once. `apart` gives the pieces of words, one after the other, and how many each word has."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // _BLOCK_BYTES
        for a, b in pairwise([*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(texts)]):
            self.renew()
            words = pc.ascii_split_whitespace(texts.slice(a, b - a))
            distinct = words.flatten().dictionary_encode()
            pieces, n_pieces = apart(distinct.dictionary)
            pieces = pieces.dictionary_encode()
            number = self._numbered(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
            book, lengths = self._encoded(number, n_pieces)
            starts = np.cumsum(lengths) - lengths
            at = distinct.indices.to_numpy()
            own = lengths[at]
            total = np.concatenate([[0], np.cumsum(own)])
            ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)
            yield a, book[ranges(starts[at], own)], np.diff(total[ends], prepend=0)
