"""Each stage against brute force on what the stage before it has made."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_bpe, test_minhash, test_mixing, test_repetition, test_suffixes
from tests.llm.rows import documents, nothing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for docs in stages[1:-1]:
        assert docs.dtypes == stages[0].dtypes


def test_quality(stages):
    wanted = [r.doc_id for r in stages[0].collect() if test_repetition.brute(r.text or "")["kept"]]
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(wanted)
    assert 0.7 * stages[0].count() < len(wanted) < stages[0].count()


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    wanted = [i for i, _, component in test_minhash.brute(rows, words=5) if i == component]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(wanted)
    assert len(wanted) < len(rows)


def test_repeated_passages(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    wanted = test_suffixes.brute(rows)
    got = {r.doc_id: r for r in stages[3].collect()}
    assert len(got) == len(rows)
    for key, (_, _, _, kept) in wanted.items():
        text = kept.decode(errors="ignore")
        assert (got[key[0]].text, got[key[0]].n_chars) == (text, len(text))
    assert any(spans for _, _, spans, _ in wanted.values())


def test_mixture(stages):
    rows = stages[3].collect()
    sizes = [len(test_repetition.WORD.findall(r.text)) for r in rows]
    by_source = Counter()
    for row, size in zip(rows, sizes, strict=True):
        by_source[row.source] += size
    names = sorted(by_source)
    target = dict(zip(names, test_mixing.levelled([by_source[n] for n in names]), strict=True))
    wanted = Counter()
    for row in rows:
        rate = target[row.source] / by_source[row.source]
        digits = hashlib.md5(f"mix:{row.doc_id}".encode()).hexdigest()[:13]
        copies = math.floor(rate) + (int(digits, 16) / 2**52 < rate - math.floor(rate))
        if copies:
            wanted[row.doc_id] = copies
    assert Counter(r.doc_id for r in stages[4].collect()) == wanted


def test_token_ids(stages):
    wanted = sorted((r.doc_id, *test_bpe.expected(r.text)) for r in stages[4].collect())
    assert sorted(map(tuple, stages[5].collect())) == wanted


def test_run(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))


def test_rows(spark, tmp_path):
    for number, start in enumerate((documents(spark), nothing(spark))):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            folder = str(tmp_path / f"{number}{name}")
            stage(spark, docs.withColumn("n_chars", F.col("n_chars")), SF).write.parquet(folder)
            docs = spark.read.schema(start.schema).parquet(folder)
            assert docs.columns == start.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
