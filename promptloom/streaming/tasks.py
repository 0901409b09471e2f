"""Task events folded to the state of each task. The fold is the same in batch and streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from promptloom.constants import TASK_STATES, TASK_TTL_SECONDS
from promptloom.session import checkpointed

# The status of a task that left the state of a stream.
EXPIRED = "expired"


def create_tasks(requests: DataFrame) -> DataFrame:
    """Requests as new tasks: a random `task_id`, status `queued` and `queued_at`.

    The ids are fixed in the shared checkpoint folder; computed again they would differ.
    """
    now = F.unix_micros(F.current_timestamp()) / 1_000_000
    return checkpointed(
        requests.withColumn("task_id", F.expr("uuid()"))
        .withColumn("status", F.lit("queued"))
        .withColumn("queued_at", now)
    )


def fold_task_events(events: DataFrame) -> DataFrame:
    """The state of each task: its latest status, and the time each state was reached.

    Events may come in any order and more than once. On equal times the later state wins. An
    error sets no `done_at`. Each task is reduced before the shuffle, so one with many events
    is no hot key.

    Times alone are reduced in hash tables, where a text would force a sort of all events. So
    in batch the messages of the few error events are reduced by themselves and joined, both
    sides already being partitioned by task. A stream keeps them in the same state.
    """
    status, at = F.col("status"), F.col("event_at")
    reached = [F.max(F.when(status == state, at)).alias(f"{state}_at") for state in TASK_STATES]
    message = F.max(F.when(status == "error", F.struct(at, "error")))["error"].alias("error")
    by_task = events.filter(status.isin(*TASK_STATES)).groupBy("task_id")
    if events.isStreaming:
        folded = by_task.agg(*reached, message)
    else:
        errors = events.filter(status == "error").groupBy("task_id").agg(message)
        folded = by_task.agg(*reached).join(errors, "task_id", "left")
    return folded.select("task_id", _latest_state().alias("status"), "error", "queued_at", "running_at", "done_at")


def _latest_state() -> Column:
    """The state reached last, from the times all states were reached."""
    latest = F.greatest(*[F.col(f"{state}_at") for state in TASK_STATES])
    status = F.lit(None).cast("string")
    for state in TASK_STATES:
        status = F.when(F.col(f"{state}_at") == latest, state).otherwise(status)
    return status


def known_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks that were created; the others are updates of an unknown id."""
    return tasks.filter(F.col("queued_at").isNotNull())


def unknown_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("queued_at").isNull())


def unexpired_tasks(tasks: DataFrame, now: Column, ttl_seconds: float = TASK_TTL_SECONDS) -> DataFrame:
    """Tasks that are not done, or were done within the time to live, and that no stream let go."""
    return tasks.filter(F.col("done_at").isNull() | (now - F.col("done_at") <= ttl_seconds))


def get_task(tasks: DataFrame, task_id: str) -> Row:
    """The record of one task; KeyError if there is none. The filter reaches below the fold."""
    found = tasks.filter(F.col("task_id") == task_id).first()
    if found is None:
        raise KeyError(f"Task {task_id} not found")
    return found


def lookup_tasks(ids: DataFrame, tasks: DataFrame) -> DataFrame:
    """Many lookups at once: each distinct `task_id` with its record and `found`.

    An id asked for very often is reduced to one row before the shuffle, so that both sides
    of the join have one row per task.
    """
    asked = ids.select("task_id").distinct()
    return asked.join(tasks.withColumn("found", F.lit(True)), "task_id", "left").withColumn(
        "found", F.coalesce(F.col("found"), F.lit(False))
    )


_STATE = "task_id string, status string, error string, queued_at double, running_at double, done_at double"
# The times of the states in order, then the time and text of the last error.
_KEPT = "queued_at double, running_at double, done_at double, error_at double, error string"


def _with_events(kept: tuple, events: pd.DataFrame) -> tuple:
    """State of a task after more of its events: what `fold_task_events` says of all of them."""
    times = dict(zip(TASK_STATES, kept, strict=False))
    message = kept[4]
    for status, at, error in zip(events["status"], events["event_at"], events["error"], strict=True):
        if status not in times or at is None or at != at:
            continue
        if status == "error":
            # Of errors at one time the greatest text counts; a null is less than any.
            before = None if times["error"] is None else (times["error"], message is not None, message or "")
            if before is None or (at, error is not None, error or "") > before:
                message = error
        if times[status] is None or at > times[status]:
            times[status] = at
    return (*times.values(), message)


def _record(task_id: str, kept: tuple, status: str | None = None) -> pd.DataFrame:
    queued, running, done, failed, message = kept
    reached = [(at, place) for place, at in enumerate(kept[:4]) if at is not None]
    status = status or TASK_STATES[max(reached)[1]]
    row = (task_id, status, message if failed is not None else None, queued, running, done)
    return pd.DataFrame([row], columns=[field.split()[0] for field in _STATE.split(", ")])


def fold_expiring_events(
    events: DataFrame, ttl_seconds: float = TASK_TTL_SECONDS, lateness_seconds: float = TASK_TTL_SECONDS
) -> DataFrame:
    """The changed states of a stream of events whose tasks leave the state when their time is over.

    A task is forgotten, and given once more with status `expired`, when the stream has seen an event
    more than `ttl_seconds` after the task was done. Events may come in any order within
    `lateness_seconds` of the latest one; Spark drops those that are later than that. Tasks that are
    not done stay. An event of a task that was forgotten begins a new one. Times are after 1970, where
    watermarks begin.
    """
    lateness = min(lateness_seconds, ttl_seconds)

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            kept = state.get
            state.remove()
            yield _record(key[0], kept, EXPIRED)
            return
        kept = state.get if state.exists else (None,) * 5
        for part in parts:
            kept = _with_events(kept, part)
        if all(at is None for at in kept[:4]):
            return
        state.update(kept)
        if kept[2] is not None:
            # The watermark is the latest time less the lateness, so it gets here as the time to live ends.
            due = int((kept[2] + ttl_seconds - lateness) * 1000)
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield _record(key[0], kept)

    timed = events.withColumn("event_time", F.timestamp_micros((F.col("event_at") * 1_000_000).cast("bigint")))
    return (
        timed.withWatermark("event_time", f"{int(lateness * 1000)} milliseconds").groupBy("task_id")
        .applyInPandasWithState(fold, _STATE, _KEPT, "update", GroupStateTimeout.EventTimeTimeout)
    )


def stream_task_state(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    ttl_seconds: float | None = None,
    lateness_seconds: float = TASK_TTL_SECONDS,
    **trigger,
) -> StreamingQuery:
    """Keeps the state of each task up to date from a stream of events.

    Each batch writes the tasks it changed to its own directory, replaced if it runs again. With a
    time to live, tasks that are done for longer leave the state (`fold_expiring_events`) and are
    written once more as expired; without one the state keeps every task, in generated code.
    """

    def write_changed(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    folded = fold_task_events(events) if ttl_seconds is None else fold_expiring_events(events, ttl_seconds, lateness_seconds)
    return (
        folded.writeStream.outputMode("update").foreachBatch(write_changed)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def compact_task_state(
    spark: SparkSession, folder: str, target: str, now: float, ttl_seconds: float = TASK_TTL_SECONDS, buckets: int = 64
) -> None:
    """Writes the latest state of every unexpired task of `folder` to `target`, by a hash of the id.

    What `stream_task_state` wrote stays; a reader turns to the new table once it is whole. Tasks
    that are done for longer than the time to live are left behind, so that the table, unlike the
    batches, holds living tasks only. A lookup reads one of its buckets.
    """
    living = unexpired_tasks(latest_task_state(spark, folder), F.lit(now), ttl_seconds)
    bucketed = living.withColumn("bucket", _bucket(F.col("task_id"), buckets))
    bucketed.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(target)


def compacted_task(spark: SparkSession, target: str, task_id: str, buckets: int = 64) -> Row:
    """One task of a compacted table, from its bucket alone; KeyError if there is none."""
    own = spark.read.parquet(target).filter(F.col("bucket") == _bucket(F.lit(task_id), buckets))
    return get_task(own.drop("bucket"), task_id)


def _bucket(task_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(task_id), F.lit(buckets)).cast("int")


def latest_task_state(spark: SparkSession, folder: str) -> DataFrame:
    """What `stream_task_state` wrote, at each task's latest batch."""
    written = spark.read.parquet(folder)
    columns = [c for c in written.columns if c not in ("task_id", "batch_id")]
    latest = F.max_by(F.struct(*columns), "batch_id").alias("latest")
    return written.groupBy("task_id").agg(latest).select("task_id", "latest.*")
