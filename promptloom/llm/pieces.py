"""Encoding and decoding with merge-type piece vocabularies: an agenda of adjacent pairs, by score."""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.chunks import WordTable
from promptloom.llm.common import slices, whole

SPACE = "▁"
# Kinds of pieces, and field numbers, of the public model file format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
# Up to so many characters a list is a faster agenda than a heap.
FEW = 40
NONE = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one message of the file."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError("Not a file of pieces")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + size]
        at += size


class PieceBpe:
    """A model file of merge type with byte fallback whose texts are only given a leading space.

    Files that normalise characters, drop white space, or hold unused or user-defined pieces are
    refused: their texts would have to be changed or cut again before or after the merges.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        trainer = dict(field for number, value in model if number == TRAINER for field in _fields(value))
        normal = dict(field for number, value in model if number == NORMALIZER for field in _fields(value))
        rows = [dict(_fields(value)) for number, value in model if number == PIECES]
        kinds = [row.get(3, NORMAL) for row in rows]
        known = (
            trainer.get(3) == 2  # merges
            and trainer.get(35) == 1  # byte fallback
            and not trainer.get(24)  # white space as suffix
            and not normal.get(2)  # character map
            and normal.get(3, 1) == 1  # leading space
            and normal.get(4, 1) == 0  # white space dropped
            and normal.get(5, 1) == 1  # white space escaped
            and set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        )
        if not known:
            raise ValueError(f"{path} is not a merge-type vocabulary of the kind encoded here")
        names = [row[1].decode() for row in rows]
        self.cost = {n: -struct.unpack("<f", row[2])[0] for n, row, k in zip(names, rows, kinds, strict=True) if k == NORMAL}
        self.ids = {n: i for i, (n, k) in enumerate(zip(names, kinds, strict=True)) if k == NORMAL}
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.surface: list[str] = []
        for i, (name, kind) in enumerate(zip(names, kinds, strict=True)):
            if kind == BYTE:
                value = int(name[1:-1], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            text = {NORMAL: name.replace(SPACE, " "), UNKNOWN: trainer.get(44, b" \xe2\x81\x87 ").decode()}.get(kind, "")
            self.surface.append(text)
        # A byte below 128 is a character whatever stands around it.
        for i, value in self.byte_of.items():
            if value < 128:
                self.surface[i] = chr(value)
        self.odd = np.array([self.byte_of.get(i, 0) >= 128 for i in range(len(names))])
        self.strips = [kind == NORMAL and name.startswith(SPACE) for kind, name in zip(kinds, names, strict=True)]
        self.begin = names.index(trainer.get(78, b"<s>").decode())
        self.end = names.index(trainer.get(79, b"</s>").decode())
        # Texts are cut where no piece reaches across: before spaces that follow other characters, and at line ends.
        inner = any(SPACE in name.lstrip(SPACE) for name in self.ids)
        self.cuts = not inner and not any("\n" in name for name in self.ids)
        self.table = WordTable(self.encode_words)

    def merged(self, text: str) -> list[int]:
        """Ids of a piece of text. The agenda holds adjacent pairs that make a piece; the best score
        comes first, of equal ones the leftmost."""
        out, ids = [], self.ids
        for symbol in self._few_merged(text) if len(text) <= FEW else self._many_merged(text):
            number = ids.get(symbol)
            if number is None:
                out += [self.byte_ids[b] for b in symbol.encode()]
            else:
                out.append(number)
        return out

    def _few_merged(self, text: str) -> list[str]:
        """Symbols of a short text: the agenda is a list by place, of which the least is looked for."""
        symbols, cost = list(text), self.cost
        agenda = [cost.get(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            made = symbols[i] + symbols.pop(i + 1)
            symbols[i] = made
            del agenda[i]
            if i:
                agenda[i - 1] = cost.get(symbols[i - 1] + made, NONE)
            if i < len(agenda):
                agenda[i] = cost.get(made + symbols[i + 1], NONE)
        return symbols

    def _many_merged(self, text: str) -> list[str]:
        """Symbols of a text of any length: the agenda is a heap, in which a pair is out of date if either
        of its two symbols no longer has the extent it had when the pair was entered."""
        cost, count = self.cost, len(text)
        stop = list(range(1, count + 1))  # where the symbol that starts here ends; 0: none starts here
        start = list(range(-1, count))  # where the symbol that ends here starts
        agenda = []
        for i in range(count - 1):
            score = cost.get(text[i : i + 2])
            if score is not None:
                agenda.append((score, i, i + 1, i + 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, middle, end = heapq.heappop(agenda)
            if stop[i] != middle or stop[middle] != end:
                continue
            stop[i], stop[middle], start[end] = end, 0, i
            if i:
                before = start[i]
                score = cost.get(text[before:end])
                if score is not None:
                    heapq.heappush(agenda, (score, before, i, end))
            if end < count:
                after = stop[end]
                score = cost.get(text[i:after])
                if score is not None:
                    heapq.heappush(agenda, (score, i, end, after))
        symbols, at = [], 0
        while at < count:
            symbols.append(text[at : stop[at]])
            at = stop[at]
        return symbols

    def encode_words(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of what `keys` gives; a key that starts with neither a line end nor a space follows one space."""
        found = [self.merged(key if key[:1] in ("\n", SPACE) and key else SPACE + key) for key in keys]
        counts = np.array(list(map(len, found)), dtype=np.int64)
        return np.array([i for own in found for i in own], dtype=np.uint32), counts

    def keys(self, text: str) -> list[str]:
        """The text in parts that no piece crosses."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if not self.cuts:
            return [SPACE + text.replace(" ", SPACE)]
        if text[0] != " " and "  " not in text:
            return text.replace("\n", " \n").split(" ")
        parts = re.findall(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*", SPACE + text.replace(" ", SPACE))
        return [part if part[0] == "\n" or part[1:2] == SPACE else part[1:] for part in parts]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; without begin and end."""
        self.table.renew()
        keys: list[str] = []
        split = np.empty(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            own = self.keys(text)
            split[i] = len(own)
            keys += own
        return self.table.encode_split(keys, split)

    def _from_bytes(self, values: bytes) -> str:
        """Characters of a run of bytes; each byte that is part of none is the replacement character."""
        try:
            return values.decode()
        except UnicodeDecodeError:
            pass
        out, at = [], 0
        while at < len(values):
            first = values[at]
            size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            try:
                out.append(values[at : at + size].decode())
                at += size
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. Begin and end give nothing, the first space is left out, and ids that the
        vocabulary does not hold are left out."""
        ids = ids[ids < len(self.surface)].astype(np.int64)
        numbers = ids.tolist()
        odd = np.flatnonzero(self.odd[ids])
        parts = list(map(self.surface.__getitem__, numbers))
        # Runs of bytes are characters together; a byte below 128 is one by itself in any run.
        if len(odd):
            edges = np.flatnonzero(np.diff(odd) != 1) + 1
            for run in np.split(odd, edges):
                a, b = int(run[0]), int(run[-1]) + 1
                parts[a:b] = [self._from_bytes(bytes(self.byte_of[i] for i in numbers[a:b])), *[""] * (b - a - 1)]
        for i, part in enumerate(parts):
            if part:
                if self.strips[numbers[i]]:
                    parts[i] = part[1:]
                break
        return "".join(parts)


@functools.cache
def loaded(path: str) -> PieceBpe:
    return PieceBpe(path)


@functools.cache
def _library(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _with_ends(model: PieceBpe, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text between the begin and the end id; texts are taken some at a time."""
    for a, b in slices(texts):
        ids, counts = model.encode(texts[a:b])
        start = 0
        for n in counts.tolist():
            own = np.empty(n + 2, dtype="<u4")
            own[0], own[1:-1], own[-1] = model.begin, ids[start : start + n], model.end
            start += n
            yield own


def encode(text: Column, path: str) -> Column:
    """Ids of each text with begin and end, as little-endian unsigned 32-bit integers; null is empty."""

    @pandas_udf("binary")
    def encoded(text: pd.Series) -> pd.Series:
        return pd.Series([ids.tobytes() for ids in _with_ends(loaded(path), whole(text))], dtype=object)

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids as `encode` writes them; null is empty."""

    @pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        model = loaded(path)
        return pd.Series([model.decode(np.frombuffer(x or b"", dtype="<u4")) for x in ids], dtype=object)

    return decoded(ids)


def round_trip(text: Column, path: str) -> Column:
    """Counts and digests of a text's ids and of what they decode to, and whether the library, asked
    for the same batch, gives the same ids and the same text."""

    @pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string, as_library boolean")
    def digests(text: pd.Series) -> pd.DataFrame:
        model, library, rows = loaded(path), _library(path), []
        texts = whole(text)
        for a, b in slices(texts):
            wanted = library.encode(texts[a:b], add_bos=True, add_eos=True, num_threads=1)
            again = library.decode(wanted, num_threads=1)
            for ids, listed, back in zip(_with_ends(model, texts[a:b]), wanted, again, strict=True):
                decoded = model.decode(ids)
                rows.append((
                    len(ids),
                    hashlib.sha256(ids.tobytes()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                    decoded == back and ids.tolist() == listed,
                ))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "as_library"])

    return digests(text)


def encoded_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, as_library of each row.

    Each row is encoded by itself, whole: null and empty texts have the begin and the end id only,
    rows that repeat an id or a text have a result each, an empty table gives an empty one. Other
    columns are not read, so they may have any name.
    """
    result = docs.select(F.col(id_column).alias("doc_id"), round_trip(F.col(text_column), path).alias("r"))
    return result.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256", "r.as_library")
