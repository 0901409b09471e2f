"""Mixing sources to target weights: documents are repeated so that each source comes near its share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.llm.common import WORD, fraction_of, written


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_rate: int) -> DataFrame:
    """Target of each source: source, source_size, target.

    `sizes` has a row per document: source, size. Sources in the order of their code points, null
    last, take the weights in turn and divide `share` of all sizes; a target stops at `max_rate`
    times its source's size and what is left goes to the others by weight. Sources filled at the
    water level are a prefix of the sources by size per weight, so running sums find it. The
    windows without a key run over one row per source, after the documents are summed up.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(names) - 1) % len(weights) + 1
    weighed = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn))
    weighed = weighed.withColumn("most", F.col("source_size") * max_rate)

    all_rows = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = all_rows.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = all_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = weighed.select(
        "*",
        (F.sum("source_size").over(everywhere) * share).alias("wanted"),
        F.sum("weight").over(everywhere).alias("weight_all"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("most_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    left_over = (F.col("wanted") - F.col("most_before")) / (F.col("weight_all") - F.col("weight_before"))
    marked = summed.withColumn("full", F.col("most") / F.col("weight") <= left_over)
    full_sum = lambda name: F.sum(F.when(F.col("full"), F.col(name)).otherwise(0)).over(everywhere)
    levelled = marked.select(
        "*",
        (F.col("wanted") - full_sum("most")).alias("rest"),
        (F.col("weight_all") - full_sum("weight")).alias("rest_weight"),
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        F.col("weight") * F.col("rest") / F.col("rest_weight")
    )
    return levelled.select("source", "source_size", target.alias("target"))


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_rate: int = 2,
    seed: str = "mix",
    names: Sequence[str] = ("doc_id", "text", "source"),
    prefix: str = "mix_",
) -> DataFrame:
    """The documents with how often each is taken: size, source_size, target, copies, named with `prefix`.

    A source's rate is its target by its size. A document is taken floor(rate) times, and once more
    if a fraction drawn from its id and the seed is below the rest. Null texts and texts without
    words have size 0; a source of size 0 has rate 0; null is a source of its own; rows that repeat
    an id are decided alike, rows without one by their text; an empty table gives an empty one.
    Columns of the documents that have one of the four names are replaced. Only ids, sources and
    sizes are summed; the targets are a table of one row per source, joined as Spark's size
    threshold says.
    """
    id_column, text_column, source_column = names
    own = free_prefix(docs.columns)
    size = word_count(F.col(text_column))
    sizes = docs.select(F.col(source_column).alias("source"), size.alias("size"))
    targets = written(source_targets(sizes, weights, share, max_rate)).select(
        F.col("source").alias(f"{own}key"),
        F.col("source_size").alias(f"{own}source_size"),
        F.col("target").alias(f"{own}target"),
    )
    joined = docs.withColumn(f"{own}size", size).join(
        targets, F.col(source_column).eqNullSafe(F.col(f"{own}key")), "left"
    )
    source_size, target = F.col(f"{own}source_size"), F.col(f"{own}target")
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    # Without an id, the text decides: else all such rows were taken together or not at all.
    key = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text_column, F.lit("")))))
    once_more = fraction_of(key, seed) < rate - F.floor(rate)
    copies = F.floor(rate) + F.when(once_more, 1).otherwise(0)
    new = [(f"{prefix}{name}", F.col(f"{own}{name}")) for name in ("size", "source_size", "target")]
    new.append((f"{prefix}copies", copies))
    kept = [name for name in docs.columns if name not in dict(new)]
    return joined.select(*kept, *[column.alias(name) for name, column in new])


def free_prefix(columns: Sequence[str]) -> str:
    """A prefix that none of the columns begins with, in whatever case."""
    prefix = "mix_"
    while any(name.lower().startswith(prefix) for name in columns):
        prefix += "_"
    return prefix


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns it came with, of any name."""
    prefix = free_prefix(docs.columns)
    taken = with_copies(docs, **(options | {"prefix": prefix})).filter(F.col(f"{prefix}copies") > 0)
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{prefix}copies")))
    return taken.withColumn(f"{prefix}copy", copy).select(*[taken[c] for c in docs.columns])
