import random

import pytest
from pyspark.sql import functions as F

from promptloom.constants import TASK_STATES
from promptloom.schemas import TASK_EVENT
from promptloom.streaming.tasks import (
    compact_task_state,
    compacted_task,
    create_tasks,
    fold_task_events,
    get_task,
    known_tasks,
    latest_task_state,
    lookup_tasks,
    stream_task_state,
    unexpired_tasks,
    unknown_tasks,
)

EVENTS = [
    ("ok", "queued", 1.0, None), ("ok", "running", 2.0, None), ("ok", "done", 3.0, None),
    ("failed", "queued", 1.0, None), ("failed", "running", 2.0, None), ("failed", "error", 3.0, "why"),
    ("tied", "done", 1.0, None), ("tied", "running", 1.0, None), ("tied", "queued", 1.0, None),
    ("waiting", "queued", 5.0, None),
    ("unknown", "running", 2.0, None), ("unknown", "done", 3.0, None),
    ("ok", "running", 2.0, None),
    ("waiting", "nonsense", 9.0, None),
]
STATES = {
    "ok": ("done", None, 1.0, 2.0, 3.0),
    "failed": ("error", "why", 1.0, 2.0, None),
    "tied": ("done", None, 1.0, 1.0, 1.0),
    "waiting": ("queued", None, 5.0, None, None),
    "unknown": ("done", None, None, 2.0, 3.0),
}


def rows_of(df):
    return {r.task_id: (r.status, r.error, r.queued_at, r.running_at, r.done_at) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_fold_does_not_depend_on_order_or_repeats(spark, seed):
    rng = random.Random(seed)
    events = EVENTS + rng.sample(EVENTS, 5)
    rng.shuffle(events)
    assert rows_of(fold_task_events(spark.createDataFrame(events, TASK_EVENT).repartition(3))) == STATES


def test_fold_against_brute_force(spark):
    rng = random.Random(5)
    # One task has a third of all events.
    events = [
        (f"t{0 if rng.random() < 0.33 else rng.randrange(40)}", rng.choice(TASK_STATES), float(rng.randrange(1000)), None)
        for _ in range(3000)
    ]
    got = rows_of(fold_task_events(spark.createDataFrame(events, TASK_EVENT).repartition(7)))
    for task in {e[0] for e in events}:
        own = [e for e in events if e[0] == task]
        status = max(own, key=lambda e: (e[2], TASK_STATES.index(e[1])))[1]
        times = [max((e[2] for e in own if e[1] == s), default=None) for s in ("queued", "running", "done")]
        assert got[task] == (status, None, *times)


def test_unknown_ids(spark):
    states = fold_task_events(spark.createDataFrame(EVENTS, TASK_EVENT))
    assert [r.task_id for r in unknown_tasks(states).collect()] == ["unknown"]
    assert set(rows_of(known_tasks(states))) == set(STATES) - {"unknown"}


def test_lookups(spark):
    states = known_tasks(fold_task_events(spark.createDataFrame(EVENTS, TASK_EVENT)))
    assert get_task(states, "ok").done_at == 3.0
    for absent in ("unknown", "never"):
        with pytest.raises(KeyError, match=f"Task {absent} not found"):
            get_task(states, absent)
    asked = spark.createDataFrame([("ok",)] * 50 + [("never",)], "task_id string")
    assert {(r.task_id, r.found, r.status) for r in lookup_tasks(asked, states).collect()} == {
        ("ok", True, "done"), ("never", False, None),
    }


def test_lookup_reads_one_task(spark, tmp_path):
    spark.createDataFrame(EVENTS, TASK_EVENT).write.parquet(str(tmp_path / "e"))
    states = known_tasks(fold_task_events(spark.read.parquet(str(tmp_path / "e"))))
    plan = states.filter(F.col("task_id") == "ok")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(task_id,ok)" in plan


def test_expiry(spark):
    states = spark.createDataFrame([("a", None), ("b", 100.0), ("c", 99.9)], "task_id string, done_at double")
    assert [r.task_id for r in unexpired_tasks(states, F.lit(700.0)).collect()] == ["a", "b"]


def test_created_tasks_keep_their_ids(spark):
    tasks = create_tasks(spark.range(100, numPartitions=4).select(F.array(F.lit("p")).alias("prompts"), "id"))
    first, again = ({r.id: r.task_id for r in tasks.collect()} for _ in range(2))
    assert first == again and len(set(first.values())) == 100
    assert tasks.filter("status = 'queued' and queued_at > 0").count() == 100


def test_stream_equals_batch(spark, tmp_path):
    events, state = tmp_path / "events", str(tmp_path / "state")
    events.mkdir()
    for part in (EVENTS[8:], EVENTS[:8]):
        spark.createDataFrame(part, TASK_EVENT).coalesce(1).write.mode("append").json(str(events))
        stream = spark.readStream.schema(TASK_EVENT).json(str(events))
        query = stream_task_state(stream, state, str(tmp_path / "checkpoint"))
        assert query.awaitTermination(120)
    assert rows_of(latest_task_state(spark, state)) == STATES


def expiring(spark, tmp_path, batches, **options):
    """Runs batches one after the other; the state, and the rows of state after each batch with data."""
    events, state = tmp_path / "events", str(tmp_path / "state")
    events.mkdir()
    totals = []
    for batch in batches:
        spark.createDataFrame(batch, TASK_EVENT).coalesce(1).write.mode("append").json(str(events))
        stream = spark.readStream.schema(TASK_EVENT).json(str(events))
        query = stream_task_state(stream, state, str(tmp_path / "checkpoint"), **options)
        assert query.awaitTermination(180)
        totals.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    return {r.task_id: (r.status, r.error, r.queued_at, r.running_at, r.done_at) for r in latest_task_state(spark, state).collect()}, totals


def test_expiring_state_equals_the_fold_while_nothing_is_due(spark, tmp_path):
    got, totals = expiring(spark, tmp_path, [EVENTS[9:], EVENTS[4:9], EVENTS[:4]], ttl_seconds=600)
    assert got == STATES and totals[-1] == len(STATES)


def test_state_falls_after_the_time_to_live(spark, tmp_path):
    def task(name, start, *states):
        return [(name, s, float(start + k), "why" if s == "error" else None) for k, s in enumerate(states)]

    whole = ("queued", "running", "done")
    first = [e for i in range(20) for e in task(f"t{i}", 1000 + i, *whole)] + task("open", 1000, "queued", "running")
    # Events out of order, within the lateness of the latest.
    second = task("late", 1000, "done") + task("new", 1100, *whole) + task("failed", 1050, "queued", "error")
    third = task("last", 1615, *whole)  # at most 1617: t0 to t14 were done by 1016, "late" at 1000
    fourth = task("t0", 1700, "running")
    got, totals = expiring(spark, tmp_path, [first, second, third, fourth], ttl_seconds=600, lateness_seconds=300)
    expired = {name for name, row in got.items() if row[0] == "expired"}
    # At 1700 tasks done before 1100 are over.
    assert expired == {f"t{i}" for i in range(1, 20)} | {"late"}
    assert got["t5"] == ("expired", None, 1005.0, 1006.0, 1007.0)
    assert got["open"][0] == "running" and got["failed"] == ("error", "why", 1050.0, None, None)
    assert got["t0"] == ("running", None, None, 1700.0, None)  # a new task, which nobody created
    assert totals[0] == 21 and totals[1] == 24 and totals[2] < 12 and totals[3] == 5


def test_compaction(spark, tmp_path):
    states = [(f"t{i}", "done", None, 1.0, 2.0, float(i)) for i in range(40)] + [("open", "running", None, 1.0, 2.0, None)]
    schema = "task_id string, status string, error string, queued_at double, running_at double, done_at double"
    older = [(*s[:1], "queued", None, 1.0, None, None) for s in states]
    for batch, rows in enumerate((older, states)):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "state" / f"batch_id={batch}"))
    target = str(tmp_path / "compact")
    compact_task_state(spark, str(tmp_path / "state"), target, now=620.0, ttl_seconds=600, buckets=8)
    kept = spark.read.parquet(target).collect()
    assert sorted(r.task_id for r in kept) == sorted(["open", *(f"t{i}" for i in range(20, 40))])
    found = compacted_task(spark, target, "t25", buckets=8)
    assert (found.status, found.done_at) == ("done", 25.0)
    with pytest.raises(KeyError):
        compacted_task(spark, target, "t3", buckets=8)
