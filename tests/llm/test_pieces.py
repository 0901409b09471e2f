import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from corpus_pipeline import tokenizer_path
from promptloom.llm import pieces
from tests.llm.rows import documents, nothing, sample

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
MODEL = pieces.PieceBpe(PATH)
ALPHABET = [
    *"aabbcdehtn'stres 0123456789!#-_<>/", " ", " ", "  ", "\n", "\n\n", "\t", "\r", "\x00", "\x1c", "\x85", "\xa0",
    "▁", "▁▁", "　", "Σ", "\xdf", "Å", "\xe9", "\xbd", "日", "本", "\U0001f600", "‍", "﻿",
    "​", "�", "\U0010ffff", "<s>", "</s>", "<unk>", "<0x0A>", "the", " the", "ing", "'re",
]


def expected(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


def same(texts):
    ids, counts = MODEL.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts, strict=True):
        own = ids[end - n : end]
        wanted = LIBRARY.encode(text)
        assert own.tolist() == wanted, text[:80]
        assert MODEL.decode(own) == LIBRARY.decode(wanted), text[:80]


def test_random_texts():
    rnd = random.Random(3)
    same(["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(6000)])


def test_random_words():
    rnd = random.Random(4)
    same(["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 40))) for _ in range(5000)])


def test_runs_and_long_words():
    runs = ["a" * n for n in range(70)] + [" " * n for n in range(70)] + ["\n" * n + " " * n for n in range(20)]
    same(runs + ["ab" * 40, "!" * 3000, "na" * 2000, "x" * 20000, "a  b   c\n  d \n e  "])


def test_decoding_any_ids():
    rnd = random.Random(5)
    some = [[*range(0, 260), *rnd.choices(range(32000), k=200)], list(range(3, 259)), [*range(130, 259), 28705, 259, 272]]
    for _ in range(4000):
        ids = [rnd.choice(rnd.choice(some)) for _ in range(rnd.randint(0, 12))]
        assert MODEL.decode(np.array(ids, "<u4")) == LIBRARY.decode(ids), ids


def test_both_agendas_agree():
    rnd = random.Random(6)
    for _ in range(3000):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 30))).replace(" ", "▁")
        assert MODEL._few_merged(text) == MODEL._many_merged(text)


def test_without_cuts_the_whole_text_is_one_agenda():
    model = pieces.PieceBpe(PATH)
    model.cuts = False
    for text in ["a  b\nc the cat", " x", "\n", "one two  three"]:
        assert model.encode([text])[0].tolist() == LIBRARY.encode(text)


def test_other_kinds_of_file_are_refused(tmp_path):
    changed = bytearray(open(PATH, "rb").read())
    at = changed.rindex(b"identity")
    flags = changed[at:]
    place = at + flags.index(b"\x20\x00")  # white space dropped: no
    changed[place + 1] = 1
    (tmp_path / "model").write_bytes(bytes(changed))
    with pytest.raises(ValueError):
        pieces.PieceBpe(str(tmp_path / "model"))


@pytest.mark.parametrize("make", [documents, sample])
def test_rows(spark, make):
    docs = make(spark)
    rows = pieces.encoded_documents(docs, PATH).collect()
    assert all(row.as_library for row in rows)
    wanted = sorted((str(row.doc_id), *expected(row.text)) for row in docs.collect())
    assert sorted((str(row[0]), *row[1:4]) for row in rows) == wanted


def test_empty_table(spark):
    assert pieces.encoded_documents(nothing(spark), PATH).collect() == []


def test_columns_round_trip(spark):
    docs = documents(spark)
    ids = pieces.encode(docs["text"], PATH)
    for row in docs.select("text", ids.alias("ids"), pieces.decode(ids, PATH).alias("back")).collect():
        wanted = LIBRARY.encode(row.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(row.ids, "<u4").tolist() == wanted
        assert row.back == LIBRARY.decode(wanted)
