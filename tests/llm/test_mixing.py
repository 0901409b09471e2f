import pytest
from pyspark.sql import functions as F

from promptloom.llm import mixing
from tests.llm.rows import documents, nothing


def levelled(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing out again and again until none is above its bound; sizes in order of sources."""
    wanted, target = sum(sizes) * share, [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        rest = wanted - sum(most * sizes[i] for i in full)
        total = sum(w for i, w in enumerate(weight) if i not in full)
        over = set()
        for i, size in enumerate(sizes):
            target[i] = most * size if i in full else rest * weight[i] / total
            if i not in full and target[i] > most * size:
                over.add(i)
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [[5], [1, 1000, 10], [10, 10, 10, 10], [0, 7, 0], [1, 2, 3, 400, 5, 6, 70000, 8]])
def test_targets(spark, sizes):
    rows = [(f"s{i:02}", size) for i, size in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint"), (3, 1, 2), 1.5, 2).collect()
    by_source = {row.source: row.target for row in found}
    for (source, size), target in zip(rows, levelled(sizes), strict=True):
        assert by_source[source] == pytest.approx(target)
        assert by_source[source] <= 2 * size


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.expr("concat('s', CASE WHEN id % 3 = 0 THEN 0 ELSE id % 10 END)").alias("source"),
        F.expr("repeat('word ', CAST(1 + id % 50 AS INT))").alias("text"),
    )
    rows = mixing.with_copies(docs).collect()
    taken, target = {}, {}
    for row in rows:
        taken[row.source] = taken.get(row.source, 0) + row.mix_copies * row.mix_size
        target[row.source] = row.mix_target
        assert row.mix_copies <= 2
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.12)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(row.mix_size for row in rows), rel=0.03)
    assert sorted(map(str, mixing.with_copies(docs).collect())) == sorted(map(str, rows))


CLASHES = ["mix_size", "MIX_key", "mix_copy", "mix_target", "mix_source_size", "mix_copies", "mix__size"]


def test_rows(spark):
    docs = documents(spark)
    counted = mixing.with_copies(docs).collect()
    clashing = docs.select("*", *[F.concat(F.lit(f"{name} of "), F.col("k").cast("string")).alias(name) for name in CLASHES])
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    rows = mixed.collect()
    assert all(row[name] == f"{name} of {row.k}" for row in rows for name in CLASHES)
    wanted = {row.k: row.mix_copies for row in counted if row.mix_copies}
    assert {k: sum(row.k == k for row in rows) for k in {row.k for row in rows}} == wanted
    # `with_copies` puts its own columns in place of those of the same name.
    again = mixing.with_copies(clashing).collect()
    assert sorted((r.k, r.mix_size, r.mix_source_size, r.mix_copies) for r in again) == sorted(
        (r.k, r.mix_size, r.mix_source_size, r.mix_copies) for r in counted
    )
    assert len(counted) == docs.count()
    assert all(row.mix_size == 0 for row in counted if not (row.text or "").strip())


def test_rows_without_an_id_are_decided_by_their_text(spark):
    text = F.concat(F.lit("one two three "), F.col("id").cast("string"))
    docs = spark.range(4000).select(F.lit(None).cast("bigint").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"))
    rows = mixing.with_copies(docs).collect()
    assert sum(row.mix_copies * row.mix_size for row in rows) == pytest.approx(1.5 * 4 * 4000, rel=0.03)


def test_empty_table(spark):
    assert mixing.with_copies(nothing(spark)).collect() == []
    assert mixing.mixed_documents(nothing(spark)).collect() == []
