import json
import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.llm import labelled, ordinal, toxicity
from promptloom.llm.common import mixed
from promptloom.llm.labelled import fit, held_out, word_hash
from tests.llm.rows import documents, nothing

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_fold(spark):
    ids = spark.range(-50, 200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(row.out == (zlib.crc32(str(row.id).encode()) % 4 == 2) for row in ids)


def test_toxicity_of_held_out_documents(tables):
    documents, labels = tables
    model = toxicity.toxicity_model(documents, labels)
    scored = toxicity.score_documents(documents, model).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in scored if r.toxic == 1], [r for r in scored if r.toxic == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.8
    assert np.mean([r.predicted for r in clean]) < 0.01
    for row in scored:
        assert row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1
    found = [r for r in toxic if r.sentences]
    assert len(found) > 0.7 * len(toxic)
    texts = {r.doc_id: r.text for r in documents.join(labels, "doc_id").filter("toxic = 1").collect()}
    for row in found[:50]:
        for s in row.sentences:
            sentence = texts[row.doc_id][s.start : s.stop]
            assert "\n" not in sentence and sentence in toxicity.sentences(texts[row.doc_id])


def test_labels_alone_decide_nothing_but_the_training(spark, tables):
    documents, labels = tables
    few = documents.filter("doc_id < 500").select("doc_id", "text")
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.toxicity_model(few, labels) == toxicity.toxicity_model(few, turned)


def test_noisy_or():
    model = toxicity.Model(toxicity.train(["a bad word here. fine words", "fine words. more words"] * 20, np.array([1.0, 0.0] * 20)))
    scores, located = model.score(["", "fine words", "fine words. a bad word here. more", "bad", None or ""], 0.3)
    assert scores[0] == scores[4] < 0.3 > scores[1] and scores[2] > 0.5 and scores[3] > scores[1]
    assert [("fine words. a bad word here. more"[s["start"] : s["stop"]]) for s in located[2]] == ["a bad word here."]


@pytest.mark.parametrize("trained", [False, True])
def test_number_of_sentences_alone_is_no_evidence(trained):
    texts, labels = ["a bad word here. fine words", "fine words. more words"] * 20, np.array([1.0, 0.0] * 20)
    model = toxicity.Model(toxicity.train(texts, labels) if trained else toxicity.train([], np.empty(0)))
    plain = "Nothing told so. " * 100_000
    scores, located = model.score(["Nothing told so.", plain, plain + "a bad word here."], 0.3)
    assert scores[1] == scores[0] < 0.3 and not located[1]
    found = [(plain + "a bad word here.")[s["start"] : s["stop"]] for s in located[2]]
    assert (scores[2] > 0.5) == trained and found == ["a bad word here."] * trained


def test_quality_of_held_out_documents(tables):
    documents, labels = tables
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = ordinal.quality_model(documents, labels, grade)
    scored = ordinal.graded_documents(documents, model).join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r for r in scored if r.quality == 1], [r for r in scored if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.99
    assert np.mean([r.kept for r in bad]) < 0.1
    for row in scored:
        assert 1 >= row.tails[0] >= row.tails[1] >= 0
        assert row.expected_grade == pytest.approx(sum(row.tails))


def test_ordered_grades():
    texts = [f"{'good ' * g}{'poor ' * (3 - g)}text" for g in (0, 1, 2, 3)] * 25
    grades = np.array([0.0, 1.0, 2.0, 5.0] * 25)
    model = ordinal.Model(ordinal.train(texts, grades, epochs=400))
    expected, tails = model.score(texts[:4])
    assert (np.diff(expected) > 0).all() and (np.diff(model.thresholds) > 0).all()
    assert expected[0] < 1 and expected[3] > 3.5


def test_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (10, None, None)], "doc_id bigint, quality int, toxic int")
    for model, score in (
        (toxicity.toxicity_model(docs, labels), toxicity.score_documents),
        (ordinal.quality_model(docs, labels, F.col("quality")), ordinal.graded_documents),
    ):
        rows = score(docs, model).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
        assert all(r.held_out for r in rows if r.doc_id is None)
        assert score(nothing(spark), model).collect() == []


def test_no_labels(spark):
    docs, labels = documents(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs.filter("doc_id = 1"), toxicity.toxicity_model(docs, labels)).collect())
    assert all(r.kept for r in ordinal.graded_documents(docs, ordinal.quality_model(docs, labels, F.col("quality"))).collect())


ODD = ["", "one", "A bad word here! Fine?  Yes. no", "x\n\ny. z", "Don't SHOUT... 123abc 日本 été " * 30, "word " * 5000, "bad " * 50]


def test_quality_against_a_plain_loop(tables):
    documents, labels = tables
    model = ordinal.quality_model(documents.filter("doc_id < 2000"), labels, F.col("quality") * (2 - F.col("toxic")))
    weights, thresholds, levels = pickle.loads(model)
    size, log2 = 1 << ordinal.BITS, lambda n: int(math.log2(n))

    def plain(text):
        words, z = text.split(), 0.0
        shape = [re.sub("[0-9]+", "9", re.sub("[a-z]+|[^\x00-\x7f]+", "a", re.sub("[A-Z]+", "A", w))) for w in words]
        hashed = [word_hash("shape " + s) % size for s in shape]
        couples = [int(mixed(np.array([a * size + b]))[0]) % size for a, b in zip(hashed, hashed[1:])]
        again = [word_hash("again") % size for a, b in zip(words, words[1:]) if a.lower() == b.lower()]
        for found in ([word_hash(w.lower()) % size for w in words], hashed, couples, again):
            for column, times in Counter(found).items():
                z += math.sqrt(times / len(words)) * float(weights[column])
        for name, value in (("length", log2(len(words) + 1)), ("distinct", 10 * len(set(words)) // max(len(words), 1))):
            column = int(mixed(np.array([value], dtype=np.uint64) ^ np.uint64(word_hash(name)))[0]) % size
            z += 0.5 * float(weights[column])
        tails = [1 / (1 + math.exp(-(z - t))) for t in thresholds]
        return levels[0] + sum(p * (b - a) for p, a, b in zip(tails, levels, levels[1:])), tails

    texts = ODD + [row.text for row in documents.filter("doc_id % 40 = 0").collect()]
    expected, tails = ordinal.Model(model).score(texts)
    for text, grade, above in zip(texts, expected, tails):
        wanted, wanted_tails = plain(text or "")
        assert grade == pytest.approx(wanted, abs=1e-6) and above.tolist() == pytest.approx(wanted_tails, abs=1e-6)


def test_toxicity_against_a_plain_loop(tables):
    documents, labels = tables
    model = toxicity.toxicity_model(documents.filter("doc_id < 2000"), labels)
    weights, bias = pickle.loads(model)
    sigmoid = lambda z: 1 / (1 + math.exp(-z))

    def grams(word):
        marked = "^" + word.strip("\"'`.,;:!?()[]{}<>|/\\*#%&$-_=+~").lower() + "$"
        return {marked, *(marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1))}

    def plain(text):
        innocent = 1 - sigmoid(bias)
        for sentence in re.split("(?<=[.!?]) |\n", text):
            z = bias + sum(weights.get(g, 0.0) for w in sentence.split() for g in grams(w))
            if z > bias:
                innocent *= (1 - sigmoid(z)) / (1 - sigmoid(bias))
        return 1 - innocent

    texts = ODD + [row.text for row in documents.filter("doc_id % 40 = 0").collect()]
    scores, _ = toxicity.Model(model).score([t or "" for t in texts], 0.3)
    assert max(scores) > 0.5 and scores.tolist() == pytest.approx([plain(t or "") for t in texts], abs=1e-7)


def test_fit_is_bounded_whatever_repeats(spark, monkeypatch):
    monkeypatch.setattr(labelled, "MOST_CHARS", 1600)
    docs = [(1, f"version {i}") for i in range(500)] + [(i, "x" * 40) for i in (3, 4, 5, 6, 8, 9)] + [(10, "y" * 101)]
    docs = spark.createDataFrame(docs * 2, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, g) for i in (1, 1, 3, 4, 5, 6, 8, 9, 10) for g in (1.0, 0.0)], "doc_id bigint, grade double")

    def seen(most_rows):
        return json.loads(fit(docs, labels, F.col("grade"), lambda t, g: json.dumps([t, g.tolist()]).encode(), most_rows))

    texts, grades = seen(100)
    kept = [i for i in (1, 3, 4, 5, 6, 8, 9) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(texts) == len(kept) and set(grades) == {0.0} and sum(t.startswith("version") for t in texts) == 1
    assert len(seen(2)[0]) == 2 and set(seen(2)[0]) <= set(texts) and seen(2) == seen(2)
    monkeypatch.setattr(labelled, "MOST_CHARS", 16 * 40)
    monkeypatch.setattr(labelled, "LONGEST", 16)
    assert sum(map(len, seen(100)[0])) <= 640
    monkeypatch.setattr(labelled, "MOST_CHARS", 100)
    monkeypatch.setattr(labelled, "LONGEST", 1)
    assert sum(map(len, seen(100)[0])) <= 100 and seen(100)[0]
