import pathlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.llm import minhash
from promptloom.llm.components import components
from promptloom.llm.minhash import linked, minima, packed, similarity
from promptloom.session import shared_folder
from tests.llm.rows import documents, nothing, sample


def shingles(text, words=4):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(rows, words=4, percent=80):
    """Components by all pairs of rows (id, text); rows of one id are one document."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t, words)) for i, t in rows]
    named = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, s) in enumerate(named):
        for j, t in named[:a]:
            shared = len(s & t)
            if 100 * shared >= percent * (len(s) + len(t) - shared):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    first = {}
    for i, s in named:
        first[s] = min(first.get(s, i), i)
    return [
        (i, len(s), i if not s else find(first[s]) if s in first else None)
        for i, s in sets
    ]


def near_copies(count, seed=1):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(90)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(rnd.randint(0, 5)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"v{rnd.randrange(60)}" for _ in range(rnd.randint(0, 12)))) for i in range(150)]
    rows += [(2000 + i, rows[i][1].upper()) for i in range(20)]
    rnd.shuffle(rows)
    return rows


def as_rows(result):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 19, 700])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)  # small blocks: bands, and parts against parts
    rows = near_copies(120)
    result = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert as_rows(result) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    wanted = sorted(brute([(row.doc_id, row.text) for row in docs.collect()]), key=repr)
    result = minhash.near_duplicates(docs)
    assert as_rows(result) == wanted
    for row in result.collect():
        assert row.kept == (row.component_id is None or row.doc_id == row.component_id)


def test_empty_table(spark):
    assert minhash.near_duplicates(nothing(spark)).collect() == []
    assert minhash.deduplicated(nothing(spark)).collect() == []


def test_deduplicated_rows_keep_their_columns(spark):
    docs = documents(spark)
    result = minhash.deduplicated(docs, words=5)
    assert result.columns == docs.columns
    kept = [(row.doc_id, row.text) for row in result.collect()]
    ids = [i for i, _ in kept if i is not None]
    assert sorted(ids) == [-3, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert len([i for i, _ in kept if i is None]) == 2


def test_estimate():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(100):
        both, own = int(rng.integers(50, 400)), int(rng.integers(1, 100))
        values = rng.integers(0, 1 << 63, both + 2 * own).astype(np.uint64)
        a, b = np.sort(values[: both + own]), np.sort(np.concatenate([values[:both], values[both + own :]]))
        estimate = similarity(packed(minima(a)), packed(minima(b))[None, :])[0]
        errors.append(estimate - both / (both + 2 * own))
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < 0.05


def test_links_are_a_forest():
    sets = [np.arange(i, i + 100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(30)]
    sets = [np.sort(s) for s in sets]
    every = np.ones(30, dtype=bool)
    assert len(linked(sets, every, every, 80)) == 29


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(60)]
    pairs += [(900, 1000 + i) for i in range(300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    root = {}
    for a, b in pairs:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert found == root


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
    assert components(spark.range(3).select(F.col("id").alias("a"), F.col("id").alias("b"))).collect() == []


def test_memory_of_a_block_grows_with_its_sets():
    rnd = np.random.default_rng(3)
    base = np.unique(rnd.integers(0, 2**63, 40).astype(np.uint64))
    sets = []
    for _ in range(3000):
        own = base.copy()
        own[rnd.integers(0, 40, 2)] = rnd.integers(0, 2**63, 2).astype(np.uint64)
        sets.append(np.unique(own))
    every = np.ones(len(sets), dtype=bool)
    tracemalloc.start()
    links = linked(sets, every, every, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links) == 2999 and peak < 40e6  # all pairs took 72 MB


def test_filter_keeps_all_nodes_and_few_others(spark):
    rows = spark.range(-50_000, 50_000).withColumnRenamed("id", "node").withColumn("text", F.lit("x"))
    nodes = spark.range(0, 50_000, 5).withColumnRenamed("id", "node")
    kept = {r.node for r in minhash._possible(rows, nodes).collect()}
    assert kept >= set(range(0, 50_000, 5)) and len(kept) < 10_300
    assert minhash._possible(rows, nodes.filter("node < 0")).count() == 0


def test_rounds_of_components_are_deleted(spark):
    folder = pathlib.Path(shared_folder(spark))
    before = set(folder.iterdir())
    found = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint"))
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(41)}
    assert len(set(folder.iterdir()) - before) == 1
