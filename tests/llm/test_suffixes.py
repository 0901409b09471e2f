import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.llm import suffixes
from promptloom.llm.suffixes import _Powers, anchors, classes
from tests.llm.rows import documents, nothing, sample


def brute(rows, length=100):
    """(n_bytes, n_removed, n_spans, kept) of rows (id, text) in order; equal rows are one document."""
    seen, out = {}, {}
    for key, text in rows:
        data = (text or "").encode()
        if (key, text) in out:
            continue
        again = []
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                again.append(p)
            else:
                seen[data[p : p + length]] = True
        removed = np.zeros(len(data) + 1, dtype=bool)
        for p in again:
            removed[p : p + length] = True
        kept = bytes(b for b, gone in zip(data, removed, strict=False) if not gone)
        spans = int((removed[1:] & ~removed[:-1]).sum() + removed[0])
        out[(key, text)] = (len(data), len(data) - len(kept), spans, kept)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_classes_are_equal_strings(seed):
    rnd = random.Random(seed)
    length = rnd.choice([8, 9, 15, 20])
    letters = rnd.choice([b"ab", b"abc", b"\x00\x01\xff", bytes(range(97, 110))])
    base = bytes(rnd.choice(letters) for _ in range(80))
    contexts = []
    for _ in range(rnd.randint(1, 12)):
        start = rnd.randint(0, 40)
        own = bytearray(base[start : start + rnd.randint(length, length + 30)])
        if rnd.random() < 0.6:
            own[rnd.randrange(len(own))] = rnd.choice(letters)
        contexts.append(bytes(own))
    order, number = classes(contexts, length)
    sizes = np.array([len(c) + 1 for c in contexts])
    starts = np.cumsum(sizes) - sizes
    found = {}
    for p, n in zip(order.tolist(), number.tolist(), strict=True):
        i = int(np.searchsorted(starts, p, side="right") - 1)
        string = contexts[i][p - starts[i] : p - starts[i] + length]
        if len(string) == length:
            found.setdefault(n, set()).add(string)
    assert all(len(strings) == 1 for strings in found.values())
    assert len({next(iter(strings)) for strings in found.values()}) == len(found)


def test_every_string_has_one_run_and_equal_strings_one_anchor():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 300))) for _ in range(20)] + [b"a" * 250, b""]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum(list(map(len, texts)))
    first, runs, anchor, _ = anchors(data, ends, 20, 7, _Powers())
    found = {}
    for start, run, hashed in zip(first.tolist(), runs.tolist(), anchor.tolist(), strict=True):
        for p in range(start, start + run):
            assert p not in found
            found[p] = hashed
    wanted = {int(e) - len(t) + i for t, e in zip(texts, ends, strict=True) for i in range(len(t) - 19)}
    assert found.keys() == wanted
    by_string = {}
    for p, hashed in found.items():
        assert by_string.setdefault(data[p : p + 20].tobytes(), hashed) == hashed


def repeats(seed=2):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(20, 150))) for _ in range(30)]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6)))) for i in range(90)]
    rows += [(200 + i, "ab" * 120 + str(i)) for i in range(10)] + [(300, "x" * 500), (301, "x" * 99), (302, "x" * 100)]
    rows += [(400 + i, f"{i} " + parts[0] + parts[1] + f" {i}") for i in range(60)]
    return rows


@pytest.mark.parametrize(
    "options", [{}, {"block_bytes": 2000}, {"most_contexts": 20}, {"length": 40, "gram": 13}], ids=["one", "blocks", "hot", "short"]
)
def test_repeats(spark, options):
    rows = repeats()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    wanted = {i: v for (i, _), v in brute(rows, options.get("length", 100)).items()}
    for row in suffixes.removal_report(docs, **options).collect():
        n_bytes, n_removed, n_spans, kept = wanted[row.doc_id]
        assert tuple(row[1:]) == (n_bytes, n_removed, n_spans, hashlib.sha256(kept).hexdigest()), row.doc_id


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    wanted = brute([(r.doc_id, r.text) for r in rows])
    wanted_rows = [(r.doc_id, *wanted[(r.doc_id, r.text)][:3], hashlib.sha256(wanted[(r.doc_id, r.text)][3]).hexdigest()) for r in rows]
    assert sorted(map(tuple, suffixes.removal_report(docs).collect()), key=repr) == sorted(wanted_rows, key=repr)
    trimmed = suffixes.without_repeats(docs)
    assert trimmed.columns == docs.columns
    texts = [(r.doc_id, None if r.text is None else wanted[(r.doc_id, r.text)][3].decode(errors="ignore")) for r in rows]
    assert sorted(((r.doc_id, r.text) for r in trimmed.collect()), key=repr) == sorted(texts, key=repr)


def test_empty_table(spark):
    assert suffixes.removal_report(nothing(spark)).collect() == []
    assert suffixes.without_repeats(nothing(spark)).collect() == []
