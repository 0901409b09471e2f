"""Named datasets: a catalog table, or JSON records in the datasets folder."""

from __future__ import annotations

import json
import logging
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructType

from promptloom.constants import DATASETS_FOLDER, TRAINING_SPLIT
from promptloom.operators.guards import require_rows
from promptloom.sources.documents import array_elements, partition_bytes
from promptloom.sources.files import is_folder

logger = logging.getLogger(__name__)

LINES, DOCUMENT = "lines", "document"
# A document that is larger than a partition of a scan, to be cut if it is an array.
ARRAY = "array"
# What cutting costs, as a multiple of reading the document in one task (measured).
CUT_COST = 12
# A document beyond this is no text of one row, which Spark bounds at 2 GB.
MOST_TEXT_BYTES = 1 << 30


def read_dataset(
    spark: SparkSession,
    name: str,
    split: str | None = None,
    folder: str = DATASETS_FOLDER,
    schema: StructType | str | None = None,
    default_split: str = TRAINING_SPLIT,
    layout: str | None = None,
    cut: bool | None = None,
) -> DataFrame:
    """The dataset of that name: the catalog table if there is one, else `folder/name`.

    Only a table that does not exist leads to the folder; any other failure is raised. An
    empty dataset raises. Without a schema, JSON is read once more to infer it, and without a
    `layout` once more to judge its files.
    """
    if _is_table(spark, name):
        logger.debug("Reading table %s", name)
        df = spark.table(name)
    else:
        logger.debug("Reading %s from %s", name, folder)
        df = read_json(spark, f"{folder}/{name}", schema, layout, cut)
    return require_rows(select_split(df, split or default_split), name)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    layout: str | None = None,
    cut: bool | None = None,
) -> DataFrame:
    """JSON records of a file or a folder; a broken record raises, wherever it is.

    `layout` states how files hold them: `lines`, with one record or one array of records on each
    line, or `document`, one record or array over any number of lines. Without it each file is
    judged by all its lines, which reads the data once more; a folder may hold both, and a file
    that is neither raises ValueError. A document is one task, or, with `cut`, is cut into the elements
    of its array first, by all cores, if it is larger than a partition of a scan. Cutting costs about
    `CUT_COST` times a plain read, so unless stated it is done with more cores than that, and for
    documents too large to be judged as one text.
    """
    if layout not in (None, LINES, DOCUMENT):
        raise ValueError(f"Unknown layout {layout!r}, known are {LINES} and {DOCUMENT}")
    try:
        by_layout = _files_by_layout(spark, path, layout, cut)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"There is no file at {path}") from error
        raise
    parts = []
    if ARRAY in by_layout:
        large = by_layout[ARRAY]
        lines, others = array_elements(spark, large, path if is_folder(spark, path) else None)
        by_layout |= {ARRAY: lines}
        if others:
            by_layout |= {DOCUMENT: sorted([*by_layout.get(DOCUMENT, []), *others])}
        if len(others) == len(large):
            del by_layout[ARRAY]
    for kind, files in by_layout.items():
        reader = spark.read.option("mode", "FAILFAST").option("multiLine", kind == DOCUMENT)
        if files and kind != ARRAY and is_folder(spark, path):
            # Files by name, with the folders above them as partitions of the whole.
            reader = reader.option("basePath", path)
        parts.append((reader.schema(schema) if schema else reader).json(files or path))
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part, allowMissingColumns=True)
    return df


def select_split(df: DataFrame, split: str) -> DataFrame:
    """The rows of one split. As a partition column, `split` prunes the files read.

    Data without a `split` column is a single split and is returned whole.
    """
    return df.filter(F.col("split") == split) if "split" in df.columns else df


def _is_table(spark: SparkSession, name: str) -> bool:
    try:
        return spark.catalog.tableExists(name)
    except ParseException:
        return False


@F.arrow_udf(IntegerType())
def _line_kind(value: pa.Array) -> pa.Array:
    """0: no text, 1: records and nothing else, 2: anything else."""

    def kind(line: str) -> int:
        if not line.strip():
            return 0
        try:
            return 1 if isinstance(json.loads(line), dict | list) else 2
        except ValueError:
            return 2

    return pa.array([kind(line) for line in value.to_pylist()], pa.int32())


@F.arrow_udf(BooleanType())
def _is_document(value: pa.Array) -> pa.Array:
    def whole(text: str) -> bool:
        try:
            return isinstance(json.loads(text), dict | list)
        except ValueError:
            return False

    return pa.array([whole(text) for text in value.to_pylist()], pa.bool_())


def _files_by_layout(spark: SparkSession, path: str, layout: str | None, cut: bool | None) -> dict[str, list[str] | None]:
    """The files of each layout; None for all files of the path. Files are as many rows as the driver lists."""
    if layout == LINES:
        return {LINES: None}
    file, size = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    if layout == DOCUMENT:
        # The content is not asked for, so it is not read.
        listed = spark.read.format("binaryFile").load(path)
        listed = listed.select(file, F.lit(2).alias("kind"), size)
    else:
        lines = spark.read.text(path).select(file, _line_kind("value").alias("kind"), size)
        listed = lines.filter("kind > 0").groupBy("file").agg(F.max("kind").alias("kind"), F.max("size").alias("size"))
    found = listed.collect()
    documents = sorted(unquote(row["file"]) for row in found if row["kind"] == 2)
    if cut is None:
        cut = spark.sparkContext.defaultParallelism > CUT_COST
    most = partition_bytes(spark) if cut else MOST_TEXT_BYTES
    arrays = sorted(unquote(row["file"]) for row in found if row["kind"] == 2 and row["size"] > most)
    documents = sorted(set(documents) - set(arrays))
    if documents and layout is None:
        texts = spark.read.text(documents, wholetext=True)
        broken = texts.filter(~_is_document("value")).select("_metadata.file_path").first()
        if broken:
            raise ValueError(f"{broken[0]} is neither JSON Lines nor one JSON document")
    lines = sorted(unquote(row["file"]) for row in found if row["kind"] == 1)
    by_layout = {kind: files for kind, files in ((LINES, lines), (DOCUMENT, documents), (ARRAY, arrays)) if files}
    if len(by_layout) > 1 or ARRAY in by_layout:
        return by_layout
    return {kind: None for kind in by_layout} or {layout or LINES: None}
