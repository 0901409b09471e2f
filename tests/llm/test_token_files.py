import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpus_pipeline import tokenizer_path
from promptloom.llm import chunks, token_files
from promptloom.llm.token_files import LEAST_USES, Shard, _shard, compress, expanded, rule_lengths
from tests.llm.rows import documents, nothing, sample

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("first_symbol", [100, 70000])
@pytest.mark.parametrize("seed", range(6))
def test_round_trip(seed, first_symbol):
    rng = np.random.default_rng(seed)
    docs = [np.append(rng.integers(3, 3 + 2 ** (seed + 1), rng.integers(0, 400)), 2).astype(np.uint32) for _ in range(40)]
    docs += [np.append(np.full(300, 7), 2).astype(np.uint32), docs[0], docs[0]]
    row = _shard(docs, [None, *range(1, len(docs))], list(map(len, docs)), first_symbol)
    shard = Shard(row)
    assert row["width"] == (2 if first_symbol < 1 << 15 else 4)
    flat = np.concatenate(docs)
    assert np.array_equal(shard.ids(), flat)
    assert shard.doc_null.tolist() == [True] + [False] * (len(docs) - 1)
    for k, own in enumerate(docs):
        assert np.array_equal(shard.document(k), own)
    for start, stop in [(0, 1), (5, 100), (len(flat) - 3, len(flat)), (17, 18), (0, len(flat))]:
        assert np.array_equal(shard.slice(start, stop), flat[start:stop])
    assert (shard.lengths >= 2).all()
    assert shard.lengths.sum() == 0 or len(shard.symbols) < len(flat)


def test_no_rule_crosses_an_end():
    ids = np.tile(np.array([9, 2], dtype=np.uint32), 100)
    symbols, rules, last = compress(ids, ids == 2, 50)
    assert rules.tolist() == [[9, 2]]
    assert last.all() and len(symbols) == 100


def test_nothing_repeats():
    ids = np.arange(3, 40, dtype=np.uint32)
    symbols, rules, last = compress(ids, np.zeros(len(ids), dtype=bool), 50)
    assert np.array_equal(expanded(symbols, rules, rule_lengths(rules, 50), 50), ids)


def expected(docs):
    rows = docs.collect()
    encoded = [(row.doc_id, LIBRARY.encode(row.text or "", add_special_tokens=False).ids + [2], row.text) for row in rows]
    return sorted(encoded, key=lambda row: (row[0] is not None, row[0] or 0))


@pytest.mark.parametrize("make", [documents, sample])
def test_files(spark, tmp_path, make):
    docs = make(spark)
    folder = str(tmp_path / "files")
    token_files.write_token_files(docs, folder, PATH, 2)
    digests = sorted(token_files.read_token_digests(spark, folder).collect(), key=lambda row: row.start)
    full = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda row: row.start)
    wanted = expected(docs)
    assert [row.doc_id for row in digests] == [row[0] for row in wanted]
    start = 0
    by_id = {}
    for doc_id, ids, _ in wanted:
        by_id.setdefault(doc_id, []).append(ids)
    for digest, row in zip(digests, full, strict=True):
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids in by_id[row.doc_id]
        by_id[row.doc_id].remove(ids)
        assert (digest.start, digest.n_tokens) == (start, len(ids)) == (row.start, row.n_tokens)
        assert digest.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not any(by_id.values())


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_token_files(nothing(spark), folder, PATH, 2)
    assert token_files.read_token_digests(spark, folder).collect() == []


def frequent_pairs(symbols, last):
    return [p for p, n in Counter((a, b) for a, b, end in zip(symbols, symbols[1:], last) if not end).items() if n >= LEAST_USES]


@pytest.mark.parametrize("seed", range(4))
def test_no_pair_stays_frequent(seed):
    rnd = np.random.default_rng(seed)
    copy = rnd.integers(0, 40_000, 1000)
    ids = np.concatenate([rnd.choice([copy, copy[::-1], rnd.integers(0, 30, 1000), np.full(1000, 7)]) for _ in range(60)])
    last = np.zeros(len(ids), dtype=bool)
    last[999::1000] = True
    symbols, rules, ends = compress(ids, last, 49_408)
    assert frequent_pairs(symbols.tolist(), ends.tolist()) == []
    lengths = rule_lengths(rules, 49_408)
    assert np.array_equal(written_out(symbols, rules, 49_408), ids)
    assert lengths.max() >= 500  # a rule stands for most of a copy, over all its rounds


def written_out(symbols, rules, first):
    """The ids of symbols, by a stack."""
    out, stack = [], symbols.tolist()[::-1]
    while stack:
        symbol = stack.pop()
        if symbol < first:
            out.append(symbol)
        else:
            stack += [int(rules[symbol - first][1]), int(rules[symbol - first][0])]
    return np.array(out)


def test_more_rules_than_16_bits_hold():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 65_000, 40_000)
    ids = np.tile(base, 6)
    symbols, rules, ends = compress(ids, np.zeros(len(ids), dtype=bool), 65_500)
    assert 65_500 + len(rules) > 1 << 16 and np.array_equal(written_out(symbols, rules, 65_500), ids)
    assert frequent_pairs(symbols.tolist(), ends.tolist()) == []


def test_runs_of_one_symbol():
    ids = np.full(4096, 3)
    symbols, rules, _ = compress(ids, np.zeros(4096, dtype=bool), 50)
    assert len(symbols) < 12 and np.array_equal(written_out(symbols, rules, 50), ids)


LETTERS = "abzßàéöøþÿ" + "ABZÀÉÖØÞ"
ODD = ["\xa0", "\x1c", "\x85", "\u3000", "\0", "\u0301", "\u0338", *"ΣςİŸµª×日😀9", "'s", "<|endoftext|>"]


def column_ids(table, texts):
    found = []
    for first, ids, counts in table.encode(texts):
        assert first == len(found)
        found += [own.tolist() for own in np.split(ids, np.cumsum(counts)[:-1])]
        assert sum(counts) == len(ids)
    return found


@pytest.mark.parametrize("block", [1, 300, 4_000_000])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_are_encoded_as_by_the_library(monkeypatch, block, kind):
    monkeypatch.setattr(chunks, "_BLOCK_BYTES", block)
    rnd = random.Random(block)
    usual, odd = [*LETTERS, *".,!?;:#%&$*", *"  \t\n"], [*LETTERS, *".,!*", *ODD, *"  \v"]
    texts = ["".join(rnd.choices(rnd.choice([usual, odd]), k=rnd.choice([1, 4, 30]))) for _ in range(2000)]
    texts = ["", " ", None, "\n a ", *texts, None]
    wanted = [encoding.ids for encoding in LIBRARY.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    table = token_files.LibraryTable(PATH)
    assert column_ids(table, pa.array(["x", *texts], kind)[1:]) == wanted
    assert column_ids(table, pa.array([], kind)) == []


def test_the_library_sees_a_word_once(monkeypatch):
    """Capitals and marks make no new words, of whatever Latin letters, and the model alone encodes those."""
    table = token_files.LibraryTable(PATH)
    by_model, by_library = [], []
    joined, any_words = table._joined, table._encode_any

    def noted(words, mark, bare=False):
        by_model.extend(words if bare else [])
        return joined(words, mark, bare=bare)

    monkeypatch.setattr(table, "_joined", noted)
    monkeypatch.setattr(table, "_encode_any", lambda words: by_library.extend(words) or any_words(words))
    texts = pa.array(["Éclair éclair, ÉCLAIR! word Word; größe", "Größe, éclair.*** WORD! größe; 12"] * 50)
    assert column_ids(table, texts)[:2] == [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts[:2].to_pylist()]
    assert sorted(by_model) == sorted(["éclair", "word", "größe"])
    assert sorted(by_library) == sorted([",", "!", ";", ".***", "12"])


@pytest.mark.parametrize("added", [["für"], ["cat"], ["ß"], ["e!"]])
def test_added_tokens_inside_words(tmp_path, added):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_tokens(added)
    tokenizer.save(str(tmp_path / "added.json"))
    texts = ["a cat concatenates", "für Dafür, daß Straße!", "one! two"]
    table = token_files.LibraryTable(str(tmp_path / "added.json"))
    assert column_ids(table, pa.array(texts)) == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
