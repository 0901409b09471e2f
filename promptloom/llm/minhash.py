"""Near-duplicates by b-bit MinHash: bands give candidates, packed low bits an estimate, sets the proof."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import mixed, slices, whole, written
from promptloom.llm.components import components
from promptloom.llm.labelled import Features, word_hash

WORDS = 4
# Links are pairs with PERCENT * |union| <= 100 * |intersection|.
PERCENT = 80
# A pair of similarity 0.8 shares none of the bands with probability (1 - 0.8^5)^36 < 1e-6.
ROWS, BANDS = 5, 36
HASHES = ROWS * BANDS
BITS = 4
# Five standard deviations of the estimate below 0.8; pairs below are not compared by their sets.
LIKELY = 0.64
# Shingles in a block: what one task compares is two parts of this size.
BLOCK_SHINGLES = 1 << 19
# Bits of the filter that keeps texts without candidates out of the last shuffle.
FILTER_BITS = 1 << 26

_PER_WORD = 64 // BITS
_PACKED = -(-HASHES // _PER_WORD)
_PADDING = _PACKED * _PER_WORD - HASHES
_NIBBLES = np.uint64(0x1111111111111111)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_numbers = mixed(np.arange(2 * HASHES) + 77)
_FACTORS = (_numbers[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_numbers[HASHES:] >> np.uint64(32)).astype(np.uint32)
_SALTS = mixed(np.arange(BANDS) + 991)


def shingle_sets(texts: list[str], words: int, hashes: Features) -> list[np.ndarray]:
    """Distinct hashes of each text's runs of `words` words, in ascending order.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text of fewer words is
    one shingle; a text without words has none.
    """
    hashes.forget()
    out: list[np.ndarray] = []
    for a, b in slices(texts):
        split = [text.encode().lower().split() for text in texts[a:b]]
        counts = [len(own) for own in split]
        flat = np.array([h for own in split for h in map(hashes.__getitem__, own)], dtype=np.uint64)
        hashed = np.zeros(max(0, len(flat) - words + 1), dtype=np.uint64)
        for k in range(words):
            hashed = hashed * _BASE + flat[k : k + len(hashed)]
        hashed = mixed(hashed)
        start = 0
        for n in counts:
            if n >= words:
                out.append(np.unique(hashed[start : start + n - words + 1]))
            elif n:
                value = np.uint64(n)
                for h in flat[start : start + n]:
                    value = mixed(np.array([value ^ h]))[0]
                out.append(np.array([value], dtype=np.uint64))
            else:
                out.append(np.empty(0, dtype=np.uint64))
            start += n
    return out


def word_hashes() -> Features:
    return Features(lambda word: word_hash(word.decode()))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set; sets of any size in blocks."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for start in range(0, len(values), 4096):
        block = values[start : start + 4096, None] * _FACTORS + _SHIFTS
        least = np.minimum(least, block.min(axis=0))
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, mixed first so that unlike minima agree in them by chance only."""
    low = mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    low = np.concatenate([low, np.zeros(_PADDING, dtype=np.uint64)]).reshape(_PACKED, _PER_WORD)
    return np.bitwise_or.reduce(low << (np.arange(_PER_WORD, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def similarity(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of a signature to others, corrected for bits that agree by chance."""
    x = one ^ others
    differ = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & _NIBBLES
    agree = 1.0 - np.bitwise_count(differ).sum(axis=-1) / HASHES
    chance = 0.5**BITS
    return (agree - chance) / (1.0 - chance)


_SIGNATURES = "doc_id bigint, text_key bigint, n_shingles bigint, key_a bigint, key_b bigint, bands array<bigint>"


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """Hash of the text, size and 128-bit key of its set, and band keys of each row; one pass, no shuffle."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            texts = whole(batch.column(2).to_pylist())
            for start, stop in slices(texts):
                sets = shingle_sets(texts[start:stop], words, hashes)
                keys_a, keys_b, bands = [], [], []
                for own in sets:
                    keys_a.append(np.bitwise_xor.reduce(mixed(own ^ _SALTS[0])) if len(own) else np.uint64(0))
                    keys_b.append(mixed(own ^ _SALTS[1]).sum(dtype=np.uint64))
                    least = minima(own).astype(np.uint64).reshape(BANDS, ROWS)
                    key = _SALTS.copy()
                    for k in range(ROWS):
                        key = mixed(key ^ least[:, k])
                    bands.append(key.view(np.int64))
                counts = np.array(list(map(len, sets)), dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, BANDS, 0))])
                flat = np.concatenate([key for key, n in zip(bands, counts, strict=True) if n] or [np.empty(0, np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        batch.column(1).slice(start, stop - start),
                        pa.array(counts),
                        pa.array(np.array(keys_a, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(keys_b, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "key_a", "key_b", "bands"],
                )

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), _text_key(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(signed, _SIGNATURES)


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join what is connected among the sets, between those marked `left` and `right`.

    Sets with the most likely partners come first. For a set, those partners by the estimate that
    are not yet connected with it are compared by all their shingles at once. Memory grows with the
    sets, not with their pairs.
    """
    count = len(sets)
    signs = np.array([packed(minima(own)) for own in sets]).reshape(count, _PACKED)
    sizes = np.array(list(map(len, sets)))
    label = np.arange(count)
    links: list[tuple[int, int]] = []

    def likely(i: int, among: np.ndarray) -> np.ndarray:
        other = (left[i] & right) | (right[i] & left)
        fits = (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * percent) & other & among
        fits[i] = False
        at = np.flatnonzero(fits)
        return at[similarity(signs[i], signs[at]) >= LIKELY]

    # Partners are counted, not kept: what is held is a row of the block's pairs at a time.
    everything = np.ones(count, dtype=bool)
    partners = np.array([len(likely(i, everything)) for i in range(count)])
    for i in np.argsort(-partners, kind="stable").tolist():
        at = likely(i, label != label[i]) if partners[i] else np.empty(0, dtype=np.int64)
        if not len(at):
            continue
        own = sets[i]
        flat = np.concatenate([sets[j] for j in at])
        place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        hits = np.add.reduceat(own[place] == flat, np.cumsum(sizes[at]) - sizes[at])
        linked_with = at[hits * 100 >= (sizes[at] + len(own) - hits) * percent]
        # One link for each set of connected ones that is reached.
        reached, first = np.unique(label[linked_with], return_index=True)
        links += [(i, int(j)) for j in linked_with[first]]
        label[np.isin(label, reached)] = label[i]
    return links


def _compare(block: pa.Table, percent: int) -> pa.Table:
    nodes = block.column("node").to_numpy()
    sets = [np.frombuffer(x, dtype="<u8") for x in block.column("shingles").to_pylist()]
    part = block.column("part").to_numpy()
    a, b = block.column("a")[0].as_py(), block.column("b")[0].as_py()
    links = linked(sets, part == a, part == b, percent)
    pairs = np.array([(nodes[i], nodes[j]) for i, j in links], dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


_BLOCKS = "node bigint, group bigint, a int, b int, part int, shingles binary"


def _block_rows(words: int):
    """Rows of the blocks that a document belongs to, each with its set of shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            texts, blocks = whole(batch.column(1).to_pylist()), batch.column(2).to_pylist()
            nodes = batch.column(0).to_pylist()
            for start, stop in slices(texts):
                sets = shingle_sets(texts[start:stop], words, hashes)
                out = [
                    block | {"node": nodes[start + k], "shingles": own.astype("<u8").tobytes()}
                    for k, own in enumerate(sets)
                    for block in blocks[start + k]
                ]
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW_BLOCKS)

    return rows


_ARROW_BLOCKS = pa.schema([
    ("node", pa.int64()), ("group", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("part", pa.int32()),
    ("shingles", pa.binary()),
])


def _with_blocks(members: DataFrame) -> DataFrame:
    """(node, blocks) of members (node, group, n_shingles): a group of up to BLOCK_SHINGLES is one
    block; a larger one is cut into parts, and every two of its parts are a block."""
    sizes = members.groupBy("group").agg(F.sum("n_shingles").alias("total"))
    parts = F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")
    placed = members.join(sizes, "group").select("node", "group", parts.alias("parts"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node", "group"), F.col("parts")).cast("int"))
    block = lambda a, b: F.struct(F.col("group"), a.alias("a"), b.alias("b"), F.col("part"))
    part = F.col("part")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: block(F.least(part, k), F.greatest(part, k)))
    return placed.groupBy("node").agg(F.flatten(F.collect_list(others)).alias("blocks"))


def _candidate_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Blocks in which all candidates meet. Rows (node, band) that share a band make a group with all
    that they are connected with; a group larger than a block is compared band by band instead."""
    buckets = rows.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first <> last")
    shared = written(rows.join(buckets, "band").select("node", "band", "first"))
    groups = components(shared.filter("node <> first").select("node", "first"))
    members = written(groups.join(sizes, "node").select("node", F.col("component").alias("group"), "n_shingles"))
    large = members.groupBy("group").agg(F.sum("n_shingles").alias("total")).filter(F.col("total") > BLOCK_SHINGLES)
    of_small = members.join(large, "group", "left_anti").select("node", "group", "n_shingles")
    in_large = members.join(large, "group", "left_semi").select("node", "n_shingles")
    of_large = shared.join(in_large, "node").select("node", F.col("band").alias("group"), "n_shingles")
    return _with_blocks(of_small.union(of_large))


def _bit(node: Column) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(FILTER_BITS))


def _possible(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows whose node may be one of `nodes`: all that are, and few others while `nodes` are fewer than
    the bits of the filter. The filter is FILTER_BITS in pieces of 4 KB, 8 MB at any size of the
    tables, so it is broadcast; it is built from partial filters and never seen by the driver's code."""
    bit = _bit(F.col("node"))
    marked = nodes.select(F.bitmap_bucket_number(bit).alias("piece"), F.bitmap_bit_position(bit).alias("at"))
    pieces = marked.groupBy("piece").agg(F.bitmap_construct_agg("at").alias("bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(pieces), F.bitmap_bucket_number(bit) == F.col("piece"))
    return found.filter(F.getbit(byte, (at % 8).cast("int")) == 1).drop("piece", "bits")


def _verdicts(docs: DataFrame, words: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row."""
    signed = written(signatures(docs, words, id_column, text_column))
    keys = ["key_a", "key_b"]
    some = signed.filter("n_shingles > 0")
    classes = written(some.groupBy(*keys).agg(F.min("doc_id").alias("node")).filter("node IS NOT NULL"))
    named = some.join(classes.withColumnRenamed("node", "doc_id"), [*keys, "doc_id"])
    rows = named.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    sizes = named.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("n_shingles"))
    blocks = written(_candidate_blocks(rows, sizes))
    texts = docs.select(F.col(id_column).cast("bigint").alias("node"), F.col(text_column).alias("text"))
    # The same join at all sizes: only texts that may be in a block are shuffled for it.
    texts = _possible(texts, blocks).join(blocks.hint("merge"), "node")
    members = texts.select("node", "text", "blocks").mapInArrow(_block_rows(words), _BLOCKS)
    links = members.groupBy("group", "a", "b").applyInArrow(lambda block: _compare(block, percent), "a bigint, b bigint")
    found = components(links)
    ids = signed.select("doc_id", "text_key", "n_shingles", *keys).join(classes, keys, "left")
    joined = ids.join(found, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Texts with equal sets are one class from the start, known by its smallest id. Classes that
    share a band are candidates; they are compared in blocks of bounded size, by the estimate and
    then by their whole sets, and links are a spanning forest, so a group of near copies never
    becomes all its pairs. Rows without words are linked with nothing; rows that repeat an id are
    versions of one document, linked with what any of them is; rows with a null id keep it, and
    have a component if an equal set has an id. An empty table gives an empty one.
    """
    return _verdicts(docs, words, percent, id_column, text_column).drop("text_key")


def deduplicated(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One document of each group, with its columns: the one with the smallest id, once.

    Of rows that repeat that id, one with the smallest hash of its text stays. Of rows with a null
    id, those stay whose set no row with an id has, equal texts once.
    """
    verdicts = _verdicts(docs, words, percent, id_column, text_column).filter("kept")
    single = F.when(F.col("doc_id").isNull(), F.col("text_key"))
    chosen = verdicts.groupBy("doc_id", single.alias("single")).agg(F.min("text_key").alias("text_key"))
    kept_id, kept_key = "_kept_id", "_kept_key"
    while {kept_id, kept_key} & set(docs.columns):
        kept_id, kept_key = kept_id + "_", kept_key + "_"
    chosen = chosen.select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key))
    same = F.col(id_column).eqNullSafe(F.col(kept_id)) & (_text_key(F.col(text_column)) == F.col(kept_key))
    return docs.join(chosen, same).dropDuplicates([kept_id, kept_key]).drop(kept_id, kept_key)
