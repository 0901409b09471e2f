"""Large JSON arrays cut into their elements by all cores.

A file is read in blocks that Spark may split anywhere. What a block does to the state of a reader
depends on one bit, whether it begins inside a string: quotes flip that bit, brackets outside strings
change the depth. Both answers are worked out for each block, and sums over the blocks of a file, one
row each, tell where each block starts. A second pass cuts at the commas of depth 1; only the pieces
at the edges of blocks are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptloom.session import shared_folder

# Rows of a block end here; which strings they hold does not matter, as their text is joined again.
SEPARATOR = b"},"
# Text is looked at in parts of about this size.
PART_BYTES = 4 << 20
_SPACE = b" \t\n\r"
_STATE = "_inside int, _depth bigint"
_BLOCKS = "_file string, _block bigint, _quotes bigint, _rise0 bigint, _rise1 bigint"


class _Reader:
    """State of a reader within a block: whether it is in a string, and the depth."""

    def __init__(self, inside: int, depth: int) -> None:
        self.inside, self.depth = inside, depth

    def look(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each byte, whether it is inside a string, and the depth with it; texts end outside escapes."""
        if b"\\" in text:
            text = text.replace(b"\\\\", b"  ").replace(b'\\"', b"  ")
        data = np.frombuffer(text, dtype=np.uint8)
        inside = np.bitwise_xor.accumulate((data == 34).view(np.uint8)) ^ self.inside if len(data) else data
        # [ and ] are { and } less 32.
        folded = data | 32
        change = (folded == 123).astype(np.int8) - (folded == 125).astype(np.int8)
        change[inside == 1] = 0
        depth = np.cumsum(change, dtype=np.int64) + self.depth
        if len(data):
            self.inside, self.depth = int(inside[-1]), int(depth[-1])
        return inside, depth


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bool]]:
    """Parts of blocks in order, with the columns of their rows, and whether a part begins a block."""
    last = None
    for batch in batches:
        values = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
        others = {name: batch.column(i) for i, name in enumerate(batch.schema.names[:-1])}
        files, blocks = others["_file"].to_pylist(), others["_block"].to_pylist()
        start = size = 0
        for i, value in enumerate(values):
            size += len(value) + len(SEPARATOR)
            same = i + 1 < len(values) and files[i + 1] == files[i] and blocks[i + 1] == blocks[i]
            if not same or size >= PART_BYTES:
                key = files[i], blocks[i]
                row = {name: column[i].as_py() for name, column in others.items()}
                yield row, SEPARATOR.join(values[start : i + 1]) + SEPARATOR, key != last
                last, start, size = key, i + 1, 0


def _pieces(spark: SparkSession, files: list[str], base: str | None) -> DataFrame:
    """Rows of text with their file, block and place, and the partition columns of the file."""
    reader = spark.read.option("lineSep", SEPARATOR.decode())
    text = (reader.option("basePath", base) if base else reader).text(files)
    return text.select(
        *[name for name in text.columns if name != "value"],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        "value",
    )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does, whether it begins outside or inside a string. A long block may be cut by
    batches, not by tasks, so a row comes when the next block begins."""
    current, readers, quotes, first = None, (), 0, None

    def done() -> pa.RecordBatch:
        rises = [reader.depth for reader in readers]
        row = {"_file": current[0], "_block": current[1], "_quotes": quotes, "_rise0": rises[0], "_rise1": rises[1]}
        return pa.RecordBatch.from_pylist([row | {"_first": first}], schema=_SUMMARY)

    for row, text, begins in _texts(batches):
        if begins:
            if current is not None:
                yield done()
            current, readers, quotes, first = (row["_file"], row["_block"]), (_Reader(0, 0), _Reader(1, 0)), 0, None
        if first is None:
            first = text.removeprefix(b"\xef\xbb\xbf").lstrip(_SPACE)[:1].decode(errors="replace") or None
        for reader in readers:
            reader.look(text)
        quotes = readers[0].inside
    if current is not None:
        yield done()


_SUMMARY = pa.schema([
    ("_file", pa.string()), ("_block", pa.int64()), ("_quotes", pa.int64()), ("_rise0", pa.int64()),
    ("_rise1", pa.int64()), ("_first", pa.string()),
])


def _states(spark: SparkSession, pieces: DataFrame, folder: str) -> DataFrame:
    """For each block the state where it starts, and what its file comes to; a row for each block."""
    found = pieces.select("_file", "_block", "value").mapInArrow(_summaries, f"{_BLOCKS}, _first string")
    found.write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    own = Window.partitionBy("_file")
    before = own.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2).cast("int")
    started = blocks.withColumn("_inside", inside)
    started = started.withColumn("_rise", F.when(F.col("_inside") == 1, F.col("_rise1")).otherwise(F.col("_rise0")))
    return started.select(
        "_file",
        "_block",
        "_inside",
        F.coalesce(F.sum("_rise").over(before), F.lit(0)).alias("_depth"),
        (F.sum("_rise").over(own)).alias("_end"),
        (F.sum("_quotes").over(own) % 2).alias("_open"),
        F.max("_block").over(own).alias("_last_block"),
        F.min_by("_first", "_block").over(own).alias("_first"),
    )


def _cutter(kept: list[str]):
    """Elements of blocks, and what stands before the first and after the last comma between elements."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, row, held, part, ended = None, None, [], 0, False

        def out(text: bytes, whole: bool) -> dict:
            place = {name: row[name] for name in (*kept, "_file", "_block")}
            return place | {"_part": part, "_whole": whole, "value": text.decode()}

        def rows_of(found: list[dict]) -> pa.RecordBatch:
            kinds = {"_block": pa.int64(), "_part": pa.int64(), "_whole": pa.bool_()}
            names = [*kept, "_file", "_block", "_part", "_whole", "value"]
            columns = [pa.array([r[n] for r in found], kinds.get(n, pa.string())) for n in names]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for new, text, begins in _texts(batches):
            found: list[dict] = []
            if begins:
                if row is not None:
                    found.append(out(b"".join(held), False))
                reader, row, held, part = _Reader(new["_inside"], new["_depth"]), new, [], 0
                ended = new["_block"] > 0 and new["_depth"] <= 0
            row = new
            if row["_block"] == row["_last_block"]:
                # The separator after the last row of a file is none of its text; a row more, and it was.
                text = text[: -len(SEPARATOR)]
                if not begins:
                    text = SEPARATOR + text
            inside, depth = reader.look(text)
            # The array must not end before the file does; `ended` also holds at the byte that begins it.
            over = np.flatnonzero(depth <= 0)
            start = 0
            if row["_block"] == 0 and begins:
                start = text.index(b"[") + 1
                over = over[over >= start]
            if ended or len(over):
                at = int(over[0]) if len(over) else 0
                last = row["_block"] == row["_last_block"]
                if not last or text[at + (not ended) :].strip(_SPACE):
                    raise ValueError(f"{row['_file']} holds more than one JSON document")
                ended = True
            commas = np.flatnonzero((np.frombuffer(text, np.uint8) == 44) & (depth == 1) & (inside == 0))
            for at in commas.tolist():
                held.append(text[start:at])
                found.append(out(b"".join(held), part > 0))
                held, start, part = [], at + 1, part + 1
            held.append(text[start:])
            if found:
                yield rows_of(found)
        if row is not None:
            yield rows_of([out(b"".join(held), False)])

    return cut


def partition_bytes(spark: SparkSession) -> int:
    """The bytes of a partition of a scan, beyond which a file is split."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def array_elements(spark: SparkSession, files: list[str], base: str | None = None) -> tuple[str | None, list[str]]:
    """Writes the elements of large arrays as lines of JSON to the shared folder; returns its path, and
    the files that are no arrays, which cannot be cut.

    Each line is an array of one element. Folders of the form `name=value` between `base` and a file
    stay its partitions. An array without its end raises ValueError, text after it fails the job, and a
    broken element raises when the lines are read. An element is held whole by a task.
    """
    folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
    pieces = _pieces(spark, files, base)
    states = _states(spark, pieces, folder)
    ends = states.filter("_block = _last_block")
    others = sorted(unquote(row["_file"]) for row in ends.filter("_first IS NULL OR _first <> '['").collect())
    # A separator is counted after the last row of a file too, so a whole array ends at -1.
    broken = ends.filter("_first = '[' AND (_end <> -1 OR _open <> 0)").first()
    if broken:
        raise ValueError(f"{broken['_file']} is neither JSON Lines nor one JSON document")
    arrays = states.filter("_first = '['").select("_file", "_block", "_inside", "_depth", "_last_block")
    kept = [name for name in pieces.columns if not name.startswith("_") and name != "value"]
    placed = pieces.select(*[F.col(name).cast("string") for name in kept], "_file", "_block", "_place", "value")
    placed = placed.join(arrays, ["_file", "_block"]).sortWithinPartitions("_file", "_block", "_place")
    placed = placed.select(*kept, "_file", "_block", "_inside", "_depth", "_last_block", "value")
    fields = "".join(f"{name} string, " for name in kept)
    cut = placed.mapInArrow(_cutter(kept), f"{fields}_file string, _block bigint, _part bigint, _whole boolean, value string")
    cut.write.parquet(f"{folder}/parts")
    parts = spark.read.schema(cut.schema).parquet(f"{folder}/parts")

    # At the edges a block has the end of an element, and the start of another one: the part with the
    # highest number. A block without a comma between elements has one part, which is neither.
    edges = parts.filter("NOT _whole")
    counts = edges.groupBy("_file", "_block").agg(F.max("_part").alias("_commas"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    numbers = counts.withColumn("_earlier", F.coalesce(F.sum("_commas").over(before), F.lit(0)))
    numbered = edges.join(numbers, ["_file", "_block"]).withColumn("_element", F.col("_earlier") + F.col("_part"))
    texts = numbered.groupBy(*kept, "_file", "_element").agg(F.sort_array(F.collect_list(F.struct("_block", "_part", "value"))).alias("all"))
    # A last element of white space alone follows a comma, unless the array is empty.
    joined = texts.select(*kept, "_file", "_element", F.array_join(F.transform("all", lambda p: p["value"]), "").alias("value"))
    total = numbers.groupBy("_file").agg(F.sum("_commas").alias("_total"))
    joined = joined.join(total, "_file")
    is_last = F.col("_element") == F.col("_total")
    body = F.when(is_last, F.regexp_replace("value", r"\]\s*+$", "")).otherwise(F.col("value"))
    joined = joined.select(*kept, "_file", body.alias("value"), (F.col("_total") == 0).alias("_only"))
    lines = joined.unionByName(parts.filter("_whole").select(*kept, "_file", "value", F.lit(False).alias("_only")))
    text = F.translate("value", "\n\r", "  ")
    empty = (F.trim(text) == "") & ~F.col("_only")
    line = F.when(empty, F.raise_error(F.concat(F.lit("A comma without an element in "), F.col("_file")))).otherwise(
        F.concat(F.lit("["), text, F.lit("]"))
    )
    lines = lines.select(*kept, line.alias("value"))
    (lines.write.partitionBy(*kept) if kept else lines.write).text(f"{folder}/lines")
    return f"{folder}/lines", others
