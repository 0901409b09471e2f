import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from promptloom.llm import repair

SCHEMA = "conv_id string, turn int, role string, text string, digest int, sign string, copies string"
LETTERS = ASCII = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """Least cost, then least letters, of edits of (role, text, fault) rows: paths tried in that order."""
    legal = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, at, state, out = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in (0, 3):
            return cost, audit, out

        def go(more, letter, at, role, text, new=True):
            if not new:
                heapq.heappush(queue, (cost + more, audit + letter, at, state, out))
            elif role[:1] in legal[state]:
                heapq.heappush(queue, (cost + more, audit + letter, at, legal[state][role[:1]], (*out, f"{role}:{text}")))

        for role in ("user", "assistant"):
            go(3, "I", at, role, "")
        if at < len(rows):
            role, text, fault = rows[at]
            go(4, "D", at + 1, None, None, new=False)
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                go(extra, "K", at + 1, role, text)
                for other in ("user", "assistant"):
                    go(3 + extra, "R", at + 1, other, text)


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        rule = zlib.crc32(key.encode()) % 20
        text = "" if rule == 1 else text.translate(str.maketrans("", "", ".!?")) if rule == 2 else text
        role = "user" if rule == 4 else role
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(rule, 1)


def report(rows, damaging=True):
    """What the operator says, worked out plainly."""
    left = {}
    ids = {row[0] for row in rows}
    for row in damage(rows) if damaging else [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]:
        left.setdefault(row[0], []).append(row[1:])
    for conv in ids:
        own = left.get(conv, [])
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in own:
            body = text.strip(LETTERS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        cost, audit, lines = cheapest(marked)
        count = [sum(f == name for *_, f in marked) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        yield (conv, gaps, *count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def key(row):
    return tuple(map(str, row))


def check(spark, rows):
    frame = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], SCHEMA)
    for damaging, make in ((True, repair.damaged), (False, repair.as_given)):
        found = repair.repair_report(make(frame)).select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
        )
        assert sorted(map(tuple, found.collect()), key=key) == sorted(report(rows, damaging), key=key)


def made(seed, conversations, most):
    rnd = random.Random(seed)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "uncle"]
    texts = ["Yes.", "No!", "Why?", "cut", "", "  \n", "ends. \t", "a\x1c", None, "Yes."]
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, most)):
            number = None if rnd.random() < 0.05 else turn + rnd.choice([0, 0, 0, 1])
            rows.append((f"c{conv}" if conv else None, number, rnd.choice(roles), rnd.choice(texts)))
    return rows


def test_random_conversations(spark):
    check(spark, made(1, 300, 12))


def test_small_ones_of_all_signs():
    signs = ["s", "u", "a", "o", "S", "U", "A", "O", "x"]
    automaton = repair.SuffixAutomaton()
    role = {"s": "system", "u": "user", "a": "assistant", "o": "other"}
    every = ["".join(s) for n in range(5) for s in itertools.product(signs, repeat=n)]
    for signature in sorted(every, key=lambda s: s[::-1])[::3]:
        rows = [
            ("x", "", "blank") if s == "x" else (role[s.lower()], "t", "truncated" if s.isupper() else "") for s in signature
        ]
        assert automaton.cheapest(signature) == cheapest(rows)[:2], signature


def test_each_suffix_is_one_node():
    signatures = sorted(["ua" * n for n in range(1, 50)], key=lambda s: s[::-1])
    automaton = repair.SuffixAutomaton()
    for signature in signatures:
        automaton.cheapest(signature)
    assert automaton.made == 98


def test_long_hot_conversation_over_many_tasks(spark):
    rnd = random.Random(5)
    rows = [("hot", t // 2, rnd.choice(["user", "assistant", "system"]), rnd.choice(["One.", "cut", f"{t}.", ""])) for t in range(3000)]
    rows += [("same", 1, "user", "Same.")] * 500 + [("nulls", None, None, None)] * 40
    adaptive, parts = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    found = repair.repair_report(repair.damaged(table)).collect()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(row[n] for n in names) for row in found), key=key) == sorted(report(rows), key=key)


def test_repaired_rows(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "user", "Hi."), ("a", 3, "system", "cut"), ("b", 1, "user", "")]
    frame = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], SCHEMA)
    found = sorted(map(tuple, repair.repaired_conversations(repair.as_given(frame)).collect()))
    # a: the second row must go (4); "system" becomes the assistant (3 and 3) or goes and one is inserted (4 + 3).
    assert found == [("a", 0, "K", "user", "Hi."), ("a", 1, "R", "assistant", "cut")]


def test_empty_table(spark):
    assert repair.repair_report(repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_very_long_text(spark):
    check(spark, [("c", 1, "user", "word " * 200_000 + "."), ("c", 2, "assistant", "x" * 1_000_000)])


@pytest.mark.parametrize("wrong", ["us", "aa", "uu", "as"])
def test_grammar_pairs(wrong):
    assert wrong not in repair.LEGAL
