import random

import pytest

from promptloom.sources.conversations import conversation_inputs, conversation_pairs

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    pairs = []
    for conv_id in {r[0] for r in rows}:
        turns = sorted(r for r in rows if r[0] == conv_id)
        instruction = max((r[3] for r in turns if r[2] == "system"), default=None)
        for now, after in zip(turns, [*turns[1:], (None,) * 4]):
            if now[2] == "user":
                pairs.append((conv_id, now[1], instruction, now[3], after[3] if after[2] == "assistant" else None))
    return sorted(pairs, key=lambda p: p[:2])


def turns_of(rng, conv_id, length, gaps):
    turn, rows = rng.choice([0, 0, 3]) if gaps else 0, []
    for _ in range(length):
        role = rng.choice(["user", "user", "assistant", "assistant", "system"])
        rows.append((conv_id, turn, role, f"{conv_id}/{turn}/{rng.random()}"))
        turn += rng.choice([1, 1, 2, 9]) if gaps else 1
    return rows


@pytest.mark.parametrize("block_turns", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("gaps", [False, True])
def test_pairs_with_a_hot_conversation(spark, block_turns, gaps):
    rng = random.Random(block_turns)
    rows = [row for c in range(60) for row in turns_of(rng, c, rng.randrange(1, 9), gaps)]
    # One conversation holds a third of all turns.
    rows += turns_of(rng, 1000, len(rows) // 2, gaps)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conversation_pairs(turns, block_turns).collect()
    assert sorted((tuple(r) for r in got), key=lambda p: p[:2]) == expected(rows)


def test_hot_conversation_is_spread(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", str(t)) for t in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = conversation_pairs(spark.createDataFrame(rows, SCHEMA), block_turns=50)
        sizes = pairs.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 and max(sizes) < 700


@pytest.mark.parametrize("block_turns", [16_384, 2])
def test_the_table_is_read_once(spark, block_turns):
    pairs = conversation_pairs(spark.read.parquet("/root/testdata/sf0.1/conversations.parquet"), block_turns)
    pairs.write.format("noop").mode("overwrite").save()
    pairs.collect()
    final = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final or final.count("REPARTITION_BY_COL") == 1




def test_inputs_are_those_of_the_pairs_without_a_shuffle(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    inputs = conversation_inputs(turns)
    pairs = conversation_pairs(turns).select("conv_id", "turn", "input")
    assert sorted(map(tuple, inputs.collect())) == sorted(map(tuple, pairs.collect()))
    plan = inputs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(role,user)" in plan
