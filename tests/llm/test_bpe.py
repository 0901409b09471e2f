import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpus_pipeline import tokenizer_path
from promptloom.llm import bpe
from tests.llm.rows import documents, nothing, sample

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = [
    *"aabbcdehtn'stres 0123456789!#-_", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "Σ", "ς",
    "İ", "ß", "Å", "Ǻ", "é", "½", "٣", "<|startoftext|>", "<|endoftext|>", "日",
    "\U0001f600", "‍", "﻿", "​", "\x00", "the", "ing", "'re", "'LL",
]


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def same(texts):
    tokenizer = bpe.WordBpe(PATH)
    ids, counts = tokenizer.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts, strict=True):
        own = ids[end - n : end]
        wanted = LIBRARY.encode(text, add_special_tokens=False).ids
        assert own.tolist() == wanted, text[:80]
        assert tokenizer.decode(own) == LIBRARY.decode(wanted, skip_special_tokens=False)


def test_random_texts():
    rnd = random.Random(7)
    same(["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(3000)])


def test_random_words():
    rnd = random.Random(8)
    same(["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 40))) for _ in range(5000)])


def test_runs_and_long_words():
    same(["a" * n for n in range(1, 70)] + ["ab" * n for n in range(1, 40)] + ["!" * 3000, "na" * 2000, "x" * 20000])


def test_merges_that_make_an_earlier_one_possible_are_done_singly():
    tokenizer = bpe.WordBpe.__new__(bpe.WordBpe)
    # 0 a, 1 b, 2 ab, 3 aba: pairs (ab, a) before (a, b), so merging one "ab" must look again.
    tokenizer.keys = np.array([(0 << 32) | 1, (2 << 32) | 0])
    tokenizer.ranks, tokenizer.made = np.array([1, 0]), np.array([3, 2])
    tokenizer.plain = np.array([True, False])
    symbols, words = tokenizer._merged(np.array([0, 1, 0, 1]), np.zeros(4, dtype=np.int64))
    assert symbols.tolist() == [3, 1]
    assert words.tolist() == [0, 0]


def test_small_table_is_renewed():
    tokenizer = bpe.WordBpe(PATH)
    tokenizer.table.most_words = 10
    texts = [f"some words number {i} and {i * 7}" for i in range(200)] * 2
    for text in texts:
        ids, _ = tokenizer.encode([text])
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_other_kinds_of_file_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.WordBpe(tokenizer_path("byte_bpe_50k.json"))


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    rows = bpe.encoded_documents(docs, PATH).collect()
    wanted = sorted((str(row.doc_id), *expected(row.text)) for row in docs.collect())
    assert sorted((str(row[0]), *row[1:]) for row in rows) == wanted


def test_empty_table(spark):
    assert bpe.encoded_documents(nothing(spark), PATH).collect() == []


def test_columns_round_trip(spark):
    docs = documents(spark)
    ids = bpe.encode(docs["text"], PATH)
    rows = docs.select("text", ids.alias("ids")).select("text", "ids", bpe.decode(ids, PATH).alias("back")).collect()
    for row in rows:
        wanted = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == wanted
        assert row.back == LIBRARY.decode(wanted, skip_special_tokens=False)
