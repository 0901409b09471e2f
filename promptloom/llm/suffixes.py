"""Removal of repeated byte strings by a Burrows-Wheeler transform with bounded interval expansion.

Two equal strings of the minimum length choose the same anchor inside them: the k-gram of least
hash, the first of equal ones. The starts that share an anchor's place are a run, and the text they
span is the anchor's context, so equal strings lie in contexts of the same anchor. Contexts that
are equal as a whole need their first place only. Different contexts of one anchor are brought
together in blocks of bounded size; there the transform says which of their strings are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.common import mixed, ranges, slices, whole, written

LENGTH = 100
GRAM = 32
# Bytes of contexts in a block of the transform, on average.
BLOCK_BYTES = 500_000
# An anchor with more different contexts than a block should hold is split by the strings themselves.
MOST_CONTEXTS = 20_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = mixed(np.arange(256) + 5)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0x00000000FFFFFFFF)
_NO_ID = -(1 << 63)


class _Powers:
    """Powers of the factor and of its inverse, as far as a text has needed them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self.up):
            one = np.ones(1, dtype=np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(size, _FACTOR)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([one, np.full(size, _INVERSE)]), dtype=np.uint64)
        return self.up[:size], self.down[:size]


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int, powers: _Powers):
    """Start of each run of strings, number of strings in it, hash of its anchor, hash of its context,
    for texts one after the other in `data` that end at `ends`; strings lie within a text."""
    none = np.empty(0, dtype=np.int64)
    window = length - gram + 1
    if len(data) < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    letters = _LETTERS[data]
    hashes, size, factor = letters, 1, int(_FACTOR)
    rest = gram
    grown, done = None, 0
    while rest:  # by binary digits of the gram's length: hash of 2n letters from two of n
        if rest & 1:
            if grown is None:
                grown, done = hashes, size
            else:
                n = len(data) - done - size + 1
                grown = grown[:n] * np.uint64(pow(int(_FACTOR), size, 1 << 64)) + hashes[done : done + n]
                done += size
        rest >>= 1
        if rest:
            hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
            factor, size = factor * factor % (1 << 64), 2 * size
    hashes = mixed(grown)
    key = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
    least, width = key, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    starts = np.arange(len(least))
    inside = np.ones(len(least), dtype=bool)
    for end in ends[:-1].tolist():  # strings that would run over a text's end
        inside[max(0, end - length + 1) : end] = False
    starts = starts[inside]
    if not len(starts):
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = (least & _LOW).astype(np.int64)[inside]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(starts)))
    first = starts[heads]
    up, down = powers.to(len(data))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(letters * up, dtype=np.uint64)])
    context = (sums[first + runs + length - 1] - sums[first]) * down[first]
    return first, runs, hashes[place[heads]], mixed(context) ^ mixed(runs)


_OCCURRENCES = "anchor bigint, context bigint, k bigint, tie bigint, start int, run int, seen boolean"


def _occurrences(length: int, gram: int):
    """Rows of runs that no earlier text of the batch has in the same context; and, marked `seen`, the
    places of those that one has. So copies are reduced before the shuffle, however many there are."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            k, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.lexsort((tie, k))
            texts = [text.encode() for text in whole(batch.column(2).take(pa.array(order)).to_pylist())]
            k, tie = k[order], tie[order]
            found = [[] for _ in range(5)]
            for a, b in slices(texts, 250_000):
                lengths = np.array(list(map(len, texts[a:b])), dtype=np.int64)
                ends = np.cumsum(lengths)
                data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
                first, runs, anchor, context = anchors(data, ends, length, gram, powers)
                text = np.searchsorted(ends, first, side="right")
                parts = (text + a, first - (ends - lengths)[text], runs, anchor, context)
                for all_parts, part in zip(found, parts, strict=True):
                    all_parts.append(part)
            if not sum(map(len, found[0])):
                continue
            text, start, runs, anchor, context = map(np.concatenate, found)
            # Equal runs in the order of text and start, as the sort is stable.
            by = np.argsort(anchor ^ mixed(context), kind="stable")
            again = np.zeros(len(by), dtype=bool)
            same = (anchor[by[1:]] == anchor[by[:-1]]) & (context[by[1:]] == context[by[:-1]])
            group = np.cumsum(np.concatenate([[True], ~same])) - 1
            head = by[np.flatnonzero(np.concatenate([[True], ~same]))[group]]
            later = (text[by] != text[head]) & ((k[text[by]] != k[text[head]]) | (tie[text[by]] != tie[text[head]]))
            again[by] = later | ((text[by] == text[head]) & (start[by] != start[head]))
            # Places that touch are one, of which only the bytes matter.
            at = np.flatnonzero(again)
            stop = start[at] + runs[at] + length - 1
            joins = np.zeros(len(at), dtype=bool)
            joins[1:] = (text[at[1:]] == text[at[:-1]]) & (start[at[1:]] <= stop[:-1])
            firsts = np.flatnonzero(~joins)
            lasts = np.append(firsts[1:], len(at)) - 1 if len(at) else firsts
            one = np.flatnonzero(~again)
            spans = at[firsts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([anchor[one].view(np.int64), mixed(text[spans] + start[spans]).view(np.int64)])),
                    pa.array(np.concatenate([context[one].view(np.int64), np.zeros(len(spans), dtype=np.int64)])),
                    pa.array(np.concatenate([k[text[one]], k[text[spans]]])),
                    pa.array(np.concatenate([tie[text[one]], tie[text[spans]]])),
                    pa.array(np.concatenate([start[one], start[spans]]).astype(np.int32)),
                    pa.array(np.concatenate([runs[one], stop[lasts] - start[spans] - length + 1]).astype(np.int32)),
                    pa.array(np.concatenate([np.zeros(len(one), dtype=bool), np.ones(len(spans), dtype=bool)])),
                ],
                names=["anchor", "context", "k", "tie", "start", "run", "seen"],
            )

    return rows


def transform(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes by their first `length` letters, the letter before each, and which of them
    differs from the one before within its first 7 letters (common letters, else -1).

    Each context ends with a letter below all others; letters are 1 to 256, that end is 0. Ranks of 7
    letters are sorted first, then ranks of twice as many from two ranks, up to the length.
    """
    sizes = np.array(list(map(len, contexts)), dtype=np.int64)
    total = int(sizes.sum()) + len(contexts)
    letters = np.zeros(total + 8, dtype=np.uint64)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(total, dtype=bool)
    inside[ends] = False
    letters[:total][inside] = np.frombuffer(b"".join(contexts), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    # Seven letters of nine bits; what follows a context's end does not count.
    left = np.repeat(ends, sizes + 1) - np.arange(total)
    key = np.zeros(total, dtype=np.uint64)
    for n in range(7):
        key = (key << np.uint64(9)) | np.where(left >= n, letters[n : n + total], 0)
    order = np.argsort(key)
    ordered = key[order]
    differ = ordered[1:] ^ ordered[:-1]
    bits = np.frexp((differ >> np.uint64(32)).astype(np.float64))[1] + 32
    low = np.frexp((differ & _LOW).astype(np.float64))[1]
    bits = np.where(differ >> np.uint64(32) > 0, bits, low)
    common = np.concatenate([[0], np.where(differ > 0, (63 - bits) // 9, -1)]).astype(np.int16)
    rank = np.empty(total, dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], differ > 0]))
    known = 7
    while known < length:
        further = np.where(left >= known, rank[np.minimum(np.arange(total) + known, total - 1)] + 1, 0)
        key = rank * (total + 1) + further
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        known *= 2
    before = letters[:total][order - 1].astype(np.int16)  # a context's first letter follows another's end
    return order, before, common


def classes(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and a number for each place in it: suffixes with the same number have
    the same first `length` letters.

    The interval of a string of n letters begins where the common prefix with the suffix before has
    n - 1 letters. Going backward, every letter before the interval's suffixes gives the interval of
    a longer string; where that begins at a place without a value yet, the value is n, and the
    interval is expanded in turn. So values appear in increasing order, each place is expanded once,
    and at the minimum length what has no value is common for as long. Values below 7 and the
    intervals to begin with come from the first sort.
    """
    order, before, common = transform(contexts, length)
    total = len(order)
    by_letter = np.argsort(before, kind="stable")
    forward = np.empty(total, dtype=np.int64)  # place of the suffix that is one letter longer
    forward[by_letter] = np.arange(total)
    last_same = np.full(total, -1, dtype=np.int64)  # place before with the same letter, and next one
    next_same = np.full(total, total, dtype=np.int64)
    same = before[by_letter[1:]] == before[by_letter[:-1]]
    last_same[by_letter[1:][same]] = by_letter[:-1][same]
    next_same[by_letter[:-1][same]] = by_letter[1:][same]

    # The places of order are those of the final sort; its first seven letters are in the same order.
    prefix = common.copy()
    edges = np.append(np.flatnonzero(prefix >= 0), total)
    begins = np.flatnonzero(prefix[edges[:-1]] == 6)
    low, high = edges[begins], edges[begins + 1]
    n = 7
    while len(low) and n < length:
        at = ranges(low, high - low)
        start, stop = np.repeat(low, high - low), np.repeat(high, high - low)
        letter = before[at] > 0
        first = at[letter & (last_same[at] < start)]
        final = at[letter & (next_same[at] >= stop)]
        low, high = np.sort(forward[first]), np.sort(forward[final]) + 1
        fresh = prefix[low] < 0
        low, high = low[fresh], high[fresh]
        prefix[low] = n
        n += 1
    return order, np.cumsum(prefix >= 0)


def covered(contexts: list[bytes], place: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Contexts with strings that start earlier elsewhere, and the first and last of those strings.

    `place` orders the contexts' texts and starts: (number of the text << 32) + start.
    """
    order, number = classes(contexts, length)
    sizes = np.array(list(map(len, contexts)), dtype=np.int64) + 1
    starts = np.cumsum(sizes) - sizes
    context = np.repeat(np.arange(len(contexts)), sizes)[order]
    offset = order - starts[context]
    string = offset < runs[context]
    number, context, offset = number[string], context[string], offset[string]
    if not len(number):
        return (np.empty(0, dtype=np.int64),) * 3
    where = place[context] + offset
    heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    earliest = np.repeat(np.minimum.reduceat(where, heads), np.diff(np.append(heads, len(number))))
    again = where > earliest
    context, offset = context[again], offset[again]
    by = np.lexsort((offset, context))
    context, offset = context[by], offset[by]
    if not len(context):
        return (np.empty(0, dtype=np.int64),) * 3
    heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    tails = np.append(heads[1:], len(context)) - 1
    return context[heads], offset[heads], offset[tails]


def _block_spans(block: pa.Table, length: int) -> pa.Table:
    k, tie = block.column("k").to_numpy(), block.column("tie").to_numpy()
    start, runs = block.column("start").to_numpy().astype(np.int64), block.column("run").to_numpy().astype(np.int64)
    order = np.lexsort((start, tie, k))
    new = np.concatenate([[False], (k[order][1:] != k[order][:-1]) | (tie[order][1:] != tie[order][:-1])])
    text = np.empty(len(k), dtype=np.int64)
    text[order] = np.cumsum(new)
    hit, first, last = covered(block.column("bytes").to_pylist(), (text << 32) + start, runs, length)
    # Two strings of a context lie less than a string's length apart, so what they cover is one span.
    return pa.table({
        "k": k[hit], "tie": tie[hit],
        "start": (start[hit] + first).astype(np.int32), "stop": (start[hit] + last + length).astype(np.int32),
    })


_SPANS = "k bigint, tie bigint, start int, stop int"
_CONTEXTS = "block int, k bigint, tie bigint, start int, run int, bytes binary"


def _cut_contexts(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("block", "k", "tie", "start", "run", "bytes")}
            columns = (batch.column(i).to_pylist() for i in range(4))
            for k, tie, text, wanted in zip(*columns, strict=True):
                data = (text or "").encode()
                for one in wanted:
                    start, run = one["start"], one["run"]
                    values = (one["block"], k, tie, start, run, data[start : start + run + length - 1])
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW_CONTEXTS)

    return rows


_ARROW_CONTEXTS = pa.schema([
    ("block", pa.int32()), ("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("run", pa.int32()),
    ("bytes", pa.binary()),
])


def _hot_strings(length: int):
    """Every string of the contexts, by a 128-bit hash; for anchors with too many contexts for a block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for k, tie, text, wanted in zip(*columns, strict=True):
                data = (text or "").encode()
                for one in wanted:
                    for start in range(one["start"], one["start"] + one["run"]):
                        digest = hashlib.blake2b(data[start : start + length], digest_size=16).digest()
                        out.append({"string": digest, "k": k, "tie": tie, "start": start})
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_STRINGS)

    return rows


_STRINGS = "string binary, k bigint, tie bigint, start int"
_ARROW_STRINGS = pa.schema([("string", pa.binary()), ("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int32())])


def _with_keys(docs: DataFrame, id_column: str, text_column: str, k: str, tie: str) -> DataFrame:
    """The rows with their id, and with what orders rows that share one, which is 0 if all ids differ."""
    key = F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NO_ID))
    repeated = docs.groupBy(key.alias("k")).count().filter("count > 1").limit(1).count() > 0
    hashed = F.xxhash64(F.col(text_column)) if repeated else F.lit(0).cast("bigint")
    return docs.select("*", key.alias(k), hashed.alias(tie))


def repeated_spans(
    keyed: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    most_contexts: int = MOST_CONTEXTS,
) -> DataFrame:
    """(k, tie, spans) of rows (k, tie, text): the bytes covered by strings that also start earlier,
    for rows that have some. A row starts earlier than one of larger k, then of larger tie.

    Runs are shuffled once, by anchor; those whose whole context came earlier are covered, and the
    first places of an anchor's different contexts are compared in blocks.
    """
    runs = keyed.mapInArrow(_occurrences(length, gram), _OCCURRENCES)
    of_context = Window.partitionBy("anchor", "context").orderBy("k", "tie", "start")
    of_anchor = Window.partitionBy("anchor")
    ranked = runs.withColumn("turn", F.rank().over(of_context)).withColumn(
        "several", F.min("context").over(of_anchor) < F.max("context").over(of_anchor)
    )
    # A place marked `seen` has a hash of its own for an anchor: it is passed on as it is.
    known = F.col("seen") | (F.col("turn") > 1)
    kept = ranked.filter(known | F.col("several")).select(
        "k", "tie", "start", "run", known.alias("known"), F.when(~known, F.col("anchor")).alias("anchor")
    )
    kept = written(kept)
    stop = (F.col("start") + F.col("run") + (length - 1)).cast("int")
    spans = kept.filter("known").select("k", "tie", "start", stop.alias("stop"))

    asked = kept.filter("NOT known")
    size = asked.agg(F.sum(F.col("run") + (length - 1))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    hot = asked.groupBy("anchor").count().filter(F.col("count") > most_contexts).select("anchor")
    place = F.struct(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block"), "start", "run")
    by_text = lambda rows: rows.groupBy("k", "tie").agg(F.collect_list(place).alias("wanted"))
    read = lambda rows: keyed.join(by_text(rows), ["k", "tie"]).select("k", "tie", "text", "wanted")
    if hot.limit(1).count():
        hot_rows = asked.join(hot, "anchor", "left_semi")
        strings = read(hot_rows).mapInArrow(_hot_strings(length), _STRINGS)
        turn = F.rank().over(Window.partitionBy("string").orderBy("k", "tie", "start"))
        later = strings.withColumn("turn", turn).filter("turn > 1")
        spans = spans.union(later.select("k", "tie", "start", (F.col("start") + length).cast("int").alias("stop")))
        asked = asked.join(hot, "anchor", "left_anti")
    contexts = read(asked).mapInArrow(_cut_contexts(length), _CONTEXTS)
    in_blocks = contexts.groupBy("block").applyInArrow(lambda block: _block_spans(block, length), _SPANS)
    return spans.union(in_blocks).groupBy("k", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((span["start"], span["stop"]) for span in (spans if spans is not None else ())):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(data[at:start])
        at = stop
    return b"".join([*parts, data[at:]])


def removal_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Null and empty texts have no bytes; texts shorter than the minimum length are kept; a text of any
    length is read whole. Rows are in the order of their ids, null first; rows that share an id in
    the order of a hash of their text; rows alike in both are one document and have the same result.
    An empty table gives an empty one.
    """

    @pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    def report(text, spans):
        import pandas as pd

        rows = []
        for one, found in zip(text, spans, strict=True):
            data, merged = (one or "").encode(), _merged(found)
            kept = _kept(data, merged)
            rows.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    keyed = _with_keys(texts, "doc_id", "text", "k", "tie").select("k", "tie", "text")
    found = keyed.join(repeated_spans(keyed, **options), ["k", "tie"], "left")
    doc_id = F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id")
    return found.select(doc_id, report("text", "spans").alias("r")).select("doc_id", "r.*")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows, with their columns, and texts without what starts earlier elsewhere.

    Letters that a removed span cuts through go with it; a text that is repeated as a whole is left
    empty, a null one null. Rows are ordered as in `removal_report`.
    """

    @pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        out = [
            None if one is None else _kept(one.encode(), _merged(found)).decode(errors="ignore")
            for one, found in zip(text, spans, strict=True)
        ]
        return pd.Series(out, dtype=object)

    k, tie, spans = "_k", "_tie", "_spans"
    while {k, tie, spans} & set(docs.columns):
        k, tie, spans = k + "_", tie + "_", spans + "_"
    keyed = _with_keys(docs, id_column, text_column, k, tie)
    texts = keyed.select(F.col(k).alias("k"), F.col(tie).alias("tie"), F.col(text_column).alias("text"))
    found = repeated_spans(texts, **options).select(F.col("k").alias(k), F.col("tie").alias(tie), F.col("spans").alias(spans))
    joined = keyed.join(found, [k, tie], "left")
    return joined.withColumn(text_column, cut(F.col(text_column), F.col(spans))).select(*docs.columns)
