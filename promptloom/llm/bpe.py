"""Byte-pair encoding and decoding with numpy merge rounds over the symbols of many words at once."""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.chunks import WordTable
from promptloom.llm.common import slices, whole


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves,
    the others for the characters from 256 on, in order."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordBpe:
    """A tokenizer file of the kind: canonical composition, white space as separator, lower case, a
    split pattern whose matches are the words, byte letters, and merges with a suffix at word ends.

    Any other kind of file is refused, as its words could not be encoded one by one.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        split, letters = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            steps == ["NFC", "Replace", "Lowercase"]
            and split["type"] == "Split"
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and letters["type"] == "ByteLevel"
            and not letters["add_prefix_space"]
            and not letters["use_regex"]
            and model["type"] == "BPE"
            and not any(model.get(key) for key in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
        )
        if not known:
            raise ValueError(f"{path} is not a word-level byte-pair tokenizer of the kind encoded here")
        vocab: dict[str, int] = dict(model["vocab"])
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = added
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

        suffix = model["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in byte_letters()], dtype=np.int64)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made
        # A merge is plain if no merge before it uses what it makes. Only then do all its places in a
        # word come before any merge that one of them makes possible.
        first_use = np.full(max(vocab.values()) + 1, len(pairs), dtype=np.int64)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.plain = first_use[made] > np.arange(len(pairs))

        size = max([*vocab.values(), *added.values()]) + 1
        tokens = [""] * size
        for token, number in (vocab | added).items():
            tokens[number] = token
        self.tokens = tokens
        self.table = WordTable(self.encode_words)

    def _merged(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, with the word each belongs to. A round merges, in every word that
        has a pair of the vocabulary left, the pair of lowest rank."""
        done_symbols, done_words = [], []
        none = len(self.keys)
        while len(symbols) > 1:
            key = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            rank = np.where((self.keys[at] == key) & (words[:-1] == words[1:]), self.ranks[at], none)
            heads = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            rank = np.append(rank, none)  # of the last symbol, which has no pair
            lowest = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(symbols)))
            active = np.repeat(lowest < none, sizes)
            if not active.all():
                done_symbols.append(symbols[~active])
                done_words.append(words[~active])
                symbols, words, rank = symbols[active], words[active], rank[active]
                sizes, lowest = sizes[lowest < none], lowest[lowest < none]
                if not len(symbols):
                    break
            wanted = np.repeat(lowest, sizes)
            hit = rank == wanted
            places = np.flatnonzero(hit)
            # Of places that follow each other, as in a run of one letter, every other one is merged.
            run = np.concatenate([[True], np.diff(places) != 1])
            run_start = np.maximum.accumulate(np.where(run, places, 0))
            chosen = (places - run_start) % 2 == 0
            single = ~self.plain[wanted[places]]
            if single.any():
                first = np.concatenate([[True], words[places[1:]] != words[places[:-1]]])
                chosen &= first | ~single
            places = places[chosen]
            symbols = symbols.copy()
            symbols[places] = self.made[wanted[places]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            symbols, words = symbols[keep], words[keep]
        if len(symbols):
            done_symbols.append(symbols)
            done_words.append(words)
        if not done_symbols:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def _pieces(self, text: str) -> list[str | int]:
        """Words of a run without white space; a special token's text gives its id."""
        out: list[str | int] = []
        for part in self.special_pattern.split(text) if self.special_pattern else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                # Lower case goes letter by letter: a sigma at a word's end is an ordinary one.
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += self.pattern.findall(plain)
        return out

    def encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[str | int] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            if text.isascii() and text.isalpha():
                pieces.append(text.lower())
                owner.append(i)
            else:
                found = self._pieces(text)
                pieces += found
                owner += [i] * len(found)
        raw = [piece.encode() if isinstance(piece, str) else b"\0" for piece in pieces]
        lengths = np.array(list(map(len, raw)), dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        words = np.repeat(np.arange(len(raw)), lengths)
        symbols = self.inner[data]
        if len(raw):
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.last[data[ends]]
            special = [i for i, piece in enumerate(pieces) if not isinstance(piece, str)]
            symbols[ends[special]] = [pieces[i] for i in special]
        symbols, words = self._merged(symbols, words)
        counts = np.bincount(np.array(owner, dtype=np.int64)[words], minlength=len(texts))
        return symbols.astype(np.uint32), counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.table.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens with a space between, as the file names no decoder; unknown ids are left out."""
        token = self.tokens
        if len(ids) and int(ids.max()) >= len(token):
            ids = ids[ids < len(token)]
        return " ".join(map(token.__getitem__, ids.tolist()))


@functools.cache
def loaded(path: str) -> WordBpe:
    return WordBpe(path)


def encode(text: Column, path: str) -> Column:
    """Token ids of each text, as little-endian unsigned 32-bit integers; null is empty."""

    @pandas_udf("binary")
    def encoded(text: pd.Series) -> pd.Series:
        bpe, out = loaded(path), []
        texts = whole(text)
        for a, b in slices(texts):
            ids, counts = bpe.encode(texts[a:b])
            ends = np.cumsum(counts)
            out += [ids[end - n : end].astype("<u4").tobytes() for end, n in zip(ends, counts, strict=True)]
        return pd.Series(out, dtype=object)

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids as `encode` writes them; null is empty."""

    @pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        bpe = loaded(path)
        return pd.Series([bpe.decode(np.frombuffer(x or b"", dtype="<u4")) for x in ids], dtype=object)

    return decoded(ids)


def round_trip(text: Column, path: str) -> Column:
    """What a text is encoded to and decoded back to, as counts and digests; one pass through Python."""

    @pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(text: pd.Series) -> pd.DataFrame:
        bpe, rows = loaded(path), []
        texts = whole(text)
        for a, b in slices(texts):
            ids, counts = bpe.encode(texts[a:b])
            start = 0
            for n in counts.tolist():
                own = ids[start : start + n]
                start += n
                rows.append((
                    n,
                    hashlib.sha256(own.astype("<u4").tobytes()).hexdigest(),
                    hashlib.sha256(bpe.decode(own).encode()).hexdigest(),
                ))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def encoded_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and digests of each row; null and empty texts have no ids, each row is encoded by itself."""
    result = docs.select(F.col(id_column).alias("doc_id"), round_trip(F.col(text_column), path).alias("r"))
    return result.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")
