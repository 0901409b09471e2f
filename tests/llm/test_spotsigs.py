import hashlib

import pytest
from pyspark.sql import functions as F

from promptloom.llm import spotsigs
from tests.llm.rows import documents, nothing, sample
from tests.llm.test_minhash import near_copies


def edited(texts):
    out = []
    for i, text in enumerate(texts):
        quarter = len(text) // 4
        out.append(text[: len(text) - quarter] + texts[(i + 1) % len(texts)][:quarter])
    return out


def signatures(fingerprint):
    return {fingerprint[i : i + 8] for i in range(0, len(fingerprint), 8)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.expr("xxhash64(coalesce(text, ''))").alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    wanted = sorted(
        (str(r.doc_id), len(r.text), hashlib.sha256(e.encode()).hexdigest())
        for r, e in zip(rows, edited([r.text for r in rows]), strict=True)
    )
    result = spotsigs.fingerprint_report(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in result) == wanted
    by_id = {}
    for row in result:
        a, b = signatures(row.fingerprint), signatures(row.edited_fingerprint)
        assert len(a) * 8 == len(row.fingerprint) and row.fingerprint == "".join(sorted(a, key=lambda x: int(x, 16) - (1 << 32) * (x >= "8")))
        assert row.near_edited == pytest.approx(jaccard(a, b))
        by_id[row.doc_id] = a
    if make is sample:
        ids = sorted(by_id)
        for row in result:
            after = ids[(ids.index(row.doc_id) + 1) % len(ids)]
            assert row.near_next == pytest.approx(jaccard(by_id[row.doc_id], by_id[after]))


def test_signatures(spark):
    texts = ["The big house and a small garden.", "the BIG house!! and a small garden", "house the garden", "xyz", "", "the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = {r.i: r.s for r in docs.select("i", spotsigs.spots(F.col("text")).alias("s")).collect()}
    assert found[0] == found[1] and len(found[0]) >= 3
    assert found[2] and found[3] and found[4] == [] and len(found[5]) == 1
    hashed = docs.limit(1).select(
        F.hash(F.lit("the"), F.lit("big"), F.lit("house")).alias("a"), F.hash(F.lit("a"), F.lit("small"), F.lit("garden")).alias("b")
    ).first()
    assert {hashed.a, hashed.b} <= set(found[0])


def test_one_row_is_its_own_next(spark):
    docs = spark.createDataFrame([(5, "The one text of the table, and the only one.")], "doc_id bigint, text string")
    row = spotsigs.fingerprint_report(docs).first()
    assert row.near_next == 1.0
    text = "The one text of the table, and the only one."
    assert row.edited_sha256 == hashlib.sha256(edited([text])[0].encode()).hexdigest()


def test_ids_of_all_sizes(spark):
    ids = [-(10**15), -2, -1, 0, 1, 2, 3, 2**52, 2**52 + 1, *range(100, 180)]
    docs = spark.createDataFrame([(i, f"The text of {i} and the number {i * 7} of it.") for i in ids], "doc_id bigint, text string")
    texts = [f"The text of {i} and the number {i * 7} of it." for i in sorted(ids)]
    wanted = dict(zip(sorted(ids), edited(texts), strict=True))
    for row in spotsigs.fingerprint_report(docs.repartition(7)).collect():
        assert row.edited_sha256 == hashlib.sha256(wanted[row.doc_id].encode()).hexdigest(), row.doc_id


def test_links_against_all_pairs(spark):
    rows = [(i, "the " + t.replace(" ", " the ")) for i, t in near_copies(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {r.doc_id: frozenset(r.s) for r in docs.select("doc_id", spotsigs.spots(F.col("text")).alias("s")).collect()}
    classes, links = spotsigs.spot_links(docs, 0.6)
    heads = {}
    for i, s in sets.items():
        heads[s] = min(i, heads.get(s, i))
    assert {r.doc_id: r.class_id for r in classes.collect()} == {i: heads[s] for i, s in sets.items()}
    wanted = {
        (min(i, j), max(i, j))
        for s, i in heads.items() for t, j in heads.items()
        if i < j and s and t and jaccard(s, t) >= 0.6
    }
    assert {(r.a, r.b) for r in links.collect()} == wanted and wanted


def test_empty_table(spark):
    assert spotsigs.fingerprint_report(nothing(spark)).collect() == []
    classes, links = spotsigs.spot_links(nothing(spark))
    assert classes.collect() == [] and links.collect() == []


def test_nothing_but_columns(spark):
    plan = spotsigs.fingerprint_report(sample(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
