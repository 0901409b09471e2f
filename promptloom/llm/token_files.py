"""Token ids in files, compressed by a grammar per shard (Re-Pair) and read back at any place.

A file is a Parquet table with a row per shard of whole documents:

| column | content |
| --- | --- |
| part, part_start, seq | range of ids the shard belongs to, ids of the part before it, place in the part |
| first_symbol | ids below it are token ids; symbol first_symbol + k is rule k |
| width | bytes of a symbol in `symbols` and `rules`: 2 or 4 |
| symbols | the shard's documents, one after the other |
| rules | two symbols for each rule, of token ids or rules before it |
| rule_lengths | token ids that each rule stands for (4 bytes) |
| doc_ids | 8 bytes for each document |
| doc_null | 1 byte for each document, 1 if its id is null |
| doc_symbols, doc_tokens | symbols and token ids of each document (4 bytes) |

All numbers are little-endian; no rule crosses the end of a document.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptloom.llm.bpe import byte_letters
from promptloom.llm.chunks import WordTable
from promptloom.llm.common import ranges

# A shard is closed at the first end of a document beyond so many ids.
SHARD_IDS = 1 << 19
# A pair becomes a rule while it occurs so often, and is replaced half as often at least.
LEAST_USES = 6
_MARK = "\0"
_MARKS = ".,!?;:#%&$*"
_NOTHING = np.empty(0, dtype=np.uint32)
# Small letters of Latin-1: canonical as they are, and each capital's small letter is one of them.
_LATIN = string.ascii_lowercase + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_BYTE_LETTERS = [(x, "".join(map(byte_letters().__getitem__, x.encode()))) for x in _LATIN if not x.isascii()]

SHARDS = (
    "part int, part_start bigint, seq int, first_symbol int, width int, symbols binary, rules binary, "
    "rule_lengths binary, doc_ids binary, doc_null binary, doc_symbols binary, doc_tokens binary"
)


def _sorted_pairs(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of symbols of so many bits in ascending order, left above right, and the places they come from."""
    pairs = left.astype(np.uint64)
    pairs <<= np.uint64(bits)
    pairs |= right
    room = 64 - 2 * bits
    if len(pairs) < 1 << room:
        # Pair and place in one number: sorting numbers is much faster than sorting places by them.
        pairs <<= np.uint64(room)
        pairs |= np.arange(len(pairs), dtype=np.uint64)
        pairs.sort()
        order = (pairs & np.uint64((1 << room) - 1)).view(np.int64)
        pairs >>= np.uint64(room)
        return pairs, order
    order = np.argsort(pairs)
    return pairs[order], order


def compress(ids: np.ndarray, last: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules, and which symbols end a document, of ids and which of them end one.

    A round counts pairs of neighbours, makes rules of the frequent ones, the most frequent first,
    and replaces each place whose pair is more frequent than the pairs it overlaps; of a run of one
    symbol every other place. Rounds go on until no pair is frequent. After the first, only symbols
    are worked on that have a live pair: one that was frequent, or came of one that was by a rule
    beside it, as other pairs cannot become frequent.
    """
    result, last = ids.astype(np.uint32), last.copy()
    there = np.ones(len(result), dtype=bool)
    rules: list[np.ndarray] = []
    next_symbol = first_symbol
    # The symbols worked on, their places in the result, and whether the pair with the next one is live.
    symbols, at, live = result.copy(), np.arange(len(result)), ~last
    live[-1:] = False
    while live.any():
        within = np.flatnonzero(live)
        bits = max(16, int(next_symbol).bit_length())
        ordered, order = _sorted_pairs(symbols[within], symbols[within + 1], bits)
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[: len(ordered)]
        counts = np.diff(np.append(heads, len(ordered)))
        frequent = np.flatnonzero(counts >= LEAST_USES)
        if not len(frequent):
            break
        frequent = frequent[np.lexsort((ordered[heads[frequent]], -counts[frequent]))]
        # Rank of the pair at each place: 0 is the most frequent.
        none = np.int32(len(frequent))
        rank = np.full(len(symbols), none, dtype=np.int32)
        of_pair = np.full(len(heads), none, dtype=np.int32)
        of_pair[frequent] = np.arange(none, dtype=np.int32)
        rank_within = np.empty(len(within), dtype=np.int32)
        rank_within[order] = np.repeat(of_pair, counts)
        rank[within] = rank_within
        chosen = rank < none
        chosen[1:] &= rank[1:] <= rank[:-1]
        chosen[:-1] &= rank[:-1] <= rank[1:]
        places = np.flatnonzero(chosen)
        # Places next to each other have one pair, of one symbol twice.
        begins = np.concatenate([[True], np.diff(places) != 1])
        run_start = np.maximum.accumulate(np.where(begins, places, 0))
        places = places[(places - run_start) % 2 == 0]
        uses = np.bincount(rank[places], minlength=none)
        # The most frequent pair is replaced half as often as it occurs at least, so a rule is always made.
        used = np.flatnonzero(uses >= LEAST_USES // 2)
        places = places[uses[rank[places]] >= LEAST_USES // 2]
        number = np.zeros(none, dtype=np.uint32)
        number[used] = next_symbol + np.arange(len(used), dtype=np.uint32)
        pair = ordered[heads[frequent[used]]]
        shift = np.uint64(bits)
        rules.append(np.stack([pair >> shift, pair & ((np.uint64(1) << shift) - np.uint64(1))], axis=1))
        next_symbol += len(used)
        symbols[places] = number[rank[places]]
        left, right = at[places], at[places + 1]
        result[left] = symbols[places]
        last[left] |= last[right]
        there[right] = False
        live = rank < none
        live[places] = live[places + 1]
        keep = live.copy()
        keep[1:] |= live[:-1]
        keep[places + 1] = False
        kept = np.flatnonzero(keep)  # taking by places is much faster than by a mask of no pattern
        symbols, at, live = symbols[kept], at[kept], live[kept]
    made = np.concatenate(rules).astype(np.uint32) if rules else np.empty((0, 2), dtype=np.uint32)
    kept = np.flatnonzero(there)
    return result[kept], made, last[kept]


def rule_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """Ids that each rule stands for. Rules use rules before them, level by level."""
    lengths = np.zeros(len(rules), dtype=np.int64)
    todo = np.arange(len(rules))
    below = rules.astype(np.int64) - first_symbol
    while len(todo):
        sides = below[todo]
        sizes = np.where(sides < 0, 1, lengths[np.maximum(sides, 0)])
        ready = (sizes > 0).all(axis=1)
        lengths[todo[ready]] = sizes[ready].sum(axis=1)
        todo = todo[~ready]
    return lengths


def expanded(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_symbol: int) -> np.ndarray:
    """The ids that symbols stand for: each rule is written out once, then copied to its places."""
    starts = np.cumsum(lengths) - lengths
    book = np.zeros(int(lengths.sum()), dtype=np.uint32)
    depth = np.zeros(len(rules), dtype=np.int64)
    sides = rules.astype(np.int64) - first_symbol
    for _ in range(len(rules)):
        deeper = np.where(sides < 0, 0, depth[np.maximum(sides, 0)] + 1).max(axis=1)
        if np.array_equal(deeper, depth):
            break
        depth = deeper
    for level in range(int(depth.max()) + 1 if len(rules) else 0):
        own = np.flatnonzero(depth == level)
        at = starts[own].copy()
        for side in (0, 1):
            child = sides[own, side]
            plain = child < 0
            book[at[plain]] = rules[own[plain], side]
            deep = child[~plain]
            book[ranges(at[~plain], lengths[deep])] = book[ranges(starts[deep], lengths[deep])]
            at += np.where(plain, 1, lengths[np.maximum(child, 0)])
    number = symbols.astype(np.int64) - first_symbol
    plain = number < 0
    if plain.all():
        return symbols.astype(np.uint32)
    sizes = np.where(plain, 1, lengths[np.maximum(number, 0)])
    out = np.empty(int(sizes.sum()), dtype=np.uint32)
    at = np.cumsum(sizes) - sizes
    out[at[plain]] = symbols[plain]
    deep = number[~plain]
    out[ranges(at[~plain], sizes[~plain])] = book[ranges(starts[deep], sizes[~plain])]
    return out


def _shard(ids: list[np.ndarray], doc_ids: list[int | None], tokens: list[int], first_symbol: int) -> dict:
    flat = np.concatenate(ids)
    counts = np.array(tokens, dtype=np.int64)
    last = np.zeros(len(flat), dtype=bool)
    last[np.cumsum(counts) - 1] = True
    symbols, rules, last = compress(flat, last, first_symbol)
    width = 2 if first_symbol + len(rules) <= 1 << 16 else 4
    ends = np.flatnonzero(last) + 1
    return {
        "first_symbol": first_symbol,
        "width": width,
        "symbols": symbols.astype(f"<u{width}").tobytes(),
        "rules": rules.astype(f"<u{width}").tobytes(),
        "rule_lengths": rule_lengths(rules, first_symbol).astype("<u4").tobytes(),
        "doc_ids": np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
        "doc_null": bytes(x is None for x in doc_ids),
        "doc_symbols": np.diff(ends, prepend=0).astype("<u4").tobytes(),
        "doc_tokens": counts.astype("<u4").tobytes(),
    }


class LibraryTable:
    """The tokenizers library's encoding of words, each of which it sees once while a bounded table holds it.

    `first_free` is the first number free for rules.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The library's model alone, for words that its normaliser and its pattern leave as they are but
        # for letters that stand for bytes: runs of letters, if that is so for the samples.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer, self.bare.pre_tokenizer = None, WhitespaceSplit()
        self.first_free = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

        a, mark = self.one_by_one(["a", _MARK])
        self.joinable = len(mark) == 1 and self.one_by_one([f"a {_MARK} a"])[0] == a + mark + a
        # Letters of which no added token is made, alone or with marks: it would be found inside words.
        added = [set(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        known = [x for x in (_LATIN, string.ascii_lowercase) if not any(own <= {*x, *_capitals(x), *_MARKS} for own in added)]
        plain = next((x for x in known if self._is_plain(x)), None)
        self.plain = re.compile(f"[{plain}]+") if plain else None
        # Letters and the marks after them are words of their own where the library says so for each mark:
        # then "Word", "word," and "word." need the library once.
        self.letters = next((x for x in known if self._marks_stand_apart(x)), "")
        self.table = WordTable(self.encode_words, most_words=800_000, most_chars=24_000_000)

    def one_by_one(self, words: list[str], bare: bool = False) -> list[list[int]]:
        by = self.bare if bare else self.tokenizer
        return [encoding.ids for encoding in by.encode_batch_fast(words, add_special_tokens=False)]

    def _is_plain(self, letters: str) -> bool:
        if not self.joinable or len(self.one_by_one(["!"], bare=True)[0]) != 1:
            return False
        probes = [*letters, letters, letters[::-1], "the", "tokenization", "zzyzx", "aeiou" * 9, letters[-1] * 9]
        probes += [f"{x}{y}{x}" for x, y in zip(letters, letters[::-1], strict=True)]
        return self.one_by_one(probes) == self.one_by_one(list(map(_as_bytes, probes)), bare=True)

    def _marks_stand_apart(self, letters: str) -> bool:
        marks = [*_MARKS, _MARKS, _MARKS[:2]]
        together = ["ab" + mark for mark in marks] + [x + _MARKS for x in (*letters, *_capitals(letters))]
        apart = ["ab " + mark for mark in marks] + [f"{x} {_MARKS}" for x in (*letters, *_capitals(letters).lower())]
        return self.one_by_one(together) == self.one_by_one(apart)

    def _joined(self, words: list[str], mark: str, bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Words are encoded 64 at a time, a mark after each that is a token of its own, which spares
        the library much work for each call."""
        end = self.one_by_one([mark], bare)[0]
        found: list[np.ndarray] = [_NOTHING]
        for start in range(0, len(words), 64 * 64):
            stop = min(start + 64 * 64, len(words))
            texts = [f" {mark} ".join(words[i : min(i + 64, stop)]) + f" {mark}" for i in range(start, stop, 64)]
            own = self.one_by_one(list(map(_as_bytes, texts)) if bare else texts, bare)
            found.append(np.fromiter(itertools.chain.from_iterable(own), dtype=np.uint32, count=sum(map(len, own))))
        ids = np.concatenate(found)
        ends = np.flatnonzero(ids == end[0])
        return ids[ids != end[0]], np.diff(ends, prepend=-1) - 1

    def _encode_any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.joinable and not any(_MARK in word for word in words):
            return self._joined(words, _MARK)
        single = self.one_by_one(words)
        return np.array([i for own in single for i in own], dtype=np.uint32), np.array(list(map(len, single)), dtype=np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.plain is None:
            return self._encode_any(words)
        is_plain = np.fromiter((x is not None for x in map(self.plain.fullmatch, words)), dtype=bool, count=len(words))
        parts = [
            self._joined(list(itertools.compress(words, is_plain)), "!", bare=True),
            self._encode_any(list(itertools.compress(words, ~is_plain))),
        ]
        lengths = np.empty(len(words), dtype=np.int64)
        starts = np.empty(len(words), dtype=np.int64)
        for kind, (_, own), before in zip((is_plain, ~is_plain), parts, (0, len(parts[0][0])), strict=True):
            lengths[kind] = own
            starts[kind] = before + np.cumsum(own) - own
        return np.concatenate([ids for ids, _ in parts]).astype(np.uint32)[ranges(starts, lengths)], lengths

    def apart(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words as their letters in lower case and the marks after them, others whole; and their numbers of pieces."""
        if not self.letters:
            return words, np.ones(len(words), dtype=np.int64)
        pattern = f"^[{self.letters}{_capitals(self.letters)}]+[{_MARKS}]*$"
        known = pc.match_substring_regex(words, pattern)
        lower = pc.if_else(known, pc.utf8_lower(words), words)
        first = pc.if_else(known, pc.ascii_rtrim(lower, characters=_MARKS), lower)
        marks = pc.utf8_ltrim(lower, characters=self.letters)
        has_marks = pc.and_(known, pc.not_equal(pc.binary_length(marks), 0)).to_numpy(zero_copy_only=False)
        counts = 1 + has_marks.astype(np.int64)
        # All first pieces, then all marks, taken in the order of the words.
        place = np.cumsum(counts) - counts
        order = np.empty(int(counts.sum()), dtype=np.int64)
        order[place] = np.arange(len(words))
        order[place[has_marks] + 1] = len(words) + np.arange(int(has_marks.sum()))
        return pa.concat_arrays([first, marks.filter(pa.array(has_marks))]).take(pa.array(order)), counts

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The first text of each block of texts, their ids, and how many each has; null is empty."""
        return self.table.encode_column(texts.fill_null(""), self.apart)


def _capitals(letters: str) -> str:
    return "".join(x for x in map(str.upper, letters) if x.lower() in letters and len(x) == 1 and x <= "Þ")


def _as_bytes(text: str) -> str:
    """The text with the letters of byte-level vocabularies for its bytes; white space stays."""
    if text.isascii():
        return text
    for letter, stands in _BYTE_LETTERS:
        text = text.replace(letter, stands)
    return text


@functools.cache
def _library_table(path: str) -> LibraryTable:
    return LibraryTable(path)


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encodes all texts and writes them to `folder` in ascending order of their ids, null first.

    Rows are dealt out by ranges of the id and, for ids that repeat, of the text's hash; each task
    writes shards of bounded size as it reads. The tokenizer must drop white space, so that its
    words can be encoded one by one; a null text is empty, and each document gets `end_id`.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _library_table(path)
        first_symbol = max(table.first_free, end_id + 1)
        part, part_start, seq = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        tokens: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal part_start, seq, held, ids, doc_ids, tokens
            row = {"part": part, "part_start": part_start, "seq": seq} | _shard(ids, doc_ids, tokens, first_symbol)
            part_start, seq, held = part_start + held, seq + 1, 0
            ids, doc_ids, tokens = [], [], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for a, encoded, counts in table.encode(batch.column(1)):
                start = 0
                for doc_id, n in zip(numbers[a : a + len(counts)], counts.tolist(), strict=True):
                    ids.append(np.append(encoded[start : start + n], np.uint32(end_id)))
                    start += n
                    doc_ids.append(doc_id)
                    tokens.append(n + 1)
                    held += n + 1
                    if held >= SHARD_IDS:
                        yield close()
        if doc_ids:
            yield close()

    doc_id = F.col(id_column).cast("bigint").alias("doc_id")
    rows = docs.select(doc_id, F.col(text_column).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(shards, SHARDS).write.parquet(folder)


_ARROW = pa.schema([
    ("part", pa.int32()), ("part_start", pa.int64()), ("seq", pa.int32()), ("first_symbol", pa.int32()),
    ("width", pa.int32()), *[(name, pa.binary()) for name in (
        "symbols", "rules", "rule_lengths", "doc_ids", "doc_null", "doc_symbols", "doc_tokens")],
])


class Shard:
    """A row of the file, for reading ids at any place."""

    def __init__(self, row: dict) -> None:
        kind = f"<u{row['width']}"
        self.first_symbol = row["first_symbol"]
        self.symbols = np.frombuffer(row["symbols"], dtype=kind)
        self.rules = np.frombuffer(row["rules"], dtype=kind).reshape(-1, 2)
        self.lengths = np.frombuffer(row["rule_lengths"], dtype="<u4").astype(np.int64)
        self.doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
        self.doc_null = np.frombuffer(row["doc_null"], dtype=bool)
        self.doc_symbols = np.frombuffer(row["doc_symbols"], dtype="<u4").astype(np.int64)
        self.doc_tokens = np.frombuffer(row["doc_tokens"], dtype="<u4").astype(np.int64)

    def ids(self) -> np.ndarray:
        return expanded(self.symbols, self.rules, self.lengths, self.first_symbol)

    def document(self, k: int) -> np.ndarray:
        """Ids of the shard's k-th document, without expanding the others."""
        end = int(self.doc_symbols[: k + 1].sum())
        return expanded(self.symbols[end - self.doc_symbols[k] : end], self.rules, self.lengths, self.first_symbol)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard: expansion lengths lead to the symbols that cover them."""
        number = self.symbols.astype(np.int64) - self.first_symbol
        sizes = np.where(number < 0, 1, self.lengths[np.maximum(number, 0)]) if len(self.rules) else np.ones(len(number))
        ends = np.cumsum(sizes).astype(np.int64)
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[a - 1]) if a else 0
        return expanded(self.symbols[a:b], self.rules, self.lengths, self.first_symbol)[start - before : stop - before]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    `start` counts the ids of all documents before. Shards know their place in their part; the
    parts' own sizes, one row for each task that wrote, are summed in one window and broadcast.
    """
    return _with_bases(spark, folder).mapInArrow(
        lambda batches: _documents(batches, digest=False), "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def read_token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As `read_token_files`, with the checksum of a document's ids in their place: ids_crc32."""
    return _with_bases(spark, folder).mapInArrow(
        lambda batches: _documents(batches, digest=True), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def _with_bases(spark: SparkSession, folder: str) -> DataFrame:
    shards = spark.read.schema(SHARDS).parquet(folder)
    last = shards.groupBy("part").agg(F.max_by("doc_tokens", "seq").alias("doc_tokens"), F.max("part_start").alias("n"))
    sizes = last.mapInArrow(_part_sizes, "part int, n bigint")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), "part")


def _part_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        sizes = [row["n"] + int(np.frombuffer(row["doc_tokens"], dtype="<u4").sum(dtype=np.int64)) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["part"] for row in rows], pa.int32()), pa.array(sizes, pa.int64())], names=["part", "n"]
        )


def _documents(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            shard = Shard(row)
            data = memoryview(shard.ids().astype("<u4").tobytes())
            ends = np.cumsum(shard.doc_tokens)
            starts = ends - shard.doc_tokens
            own = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            values = pa.array(map(zlib.crc32, own), pa.int64()) if digest else pa.array(map(bytes, own), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.doc_ids, pa.int64(), mask=shard.doc_null),
                    pa.array(row["base"] + row["part_start"] + starts, pa.int64()),
                    pa.array(shard.doc_tokens, pa.int64()),
                    values,
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
            )
