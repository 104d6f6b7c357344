"""Task and task-log tables: state, paging, transitions, messages."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrylog.functions.status import FINAL_TASK_STATUSES, task_payload
from ferrylog.operators.ranges import ordered_page
from ferrylog.schema import TASK_LOGS, TASKS
from ferrylog.sinks.ledger import latest_per_key

# Defaults of a new task, message topics and their partition.
DEFAULT_SOURCE, DEFAULT_TARGET = "default-source", "default-target"
TOPIC_NEW, TOPIC_UPDATES = "sync-tasks", "sync-task-updates"
TOPIC_PARTITION = 0

#: Rows before a page from which on they are counted by ranges, not sorted.
DEEP = 100_000


def current_tasks(versions: DataFrame) -> DataFrame:
    return latest_per_key(versions, "id")


def live_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.where(~F.col("is_deleted"))


def task_by_id(tasks: DataFrame, task_id) -> DataFrame:
    return live_tasks(tasks).where(F.col("id") == task_id)


def task_total(tasks: DataFrame) -> DataFrame:
    return live_tasks(tasks).agg(F.count(F.lit(1)).alias("total"))


def page_tasks(tasks: DataFrame, page=1, size=10) -> DataFrame:
    """One page, newest first, with the total of live tasks; ties go by id.

    A page behind more than ``DEEP`` rows is found by counting ranges instead of sorting them.
    """
    live = live_tasks(tasks)
    if (page - 1) * size > DEEP:
        return ordered_page(live, ["created_at", "id"], page, size, ["created_at"])
    total = task_total(tasks).scalar()
    return (live.orderBy(F.desc("created_at"), "id").offset((page - 1) * size).limit(size)
                .withColumn("total", total))


def task_log_page(logs: DataFrame, task_id, newest_first=True, page=1,
                  size: Optional[int] = None) -> DataFrame:
    """Logs of one task; all of them unless a page size is given."""
    mine = logs.where(F.col("task_id") == task_id)
    order = (F.desc("created_at"), F.desc("id")) if newest_first else ("id",)
    ordered = mine.orderBy(*order)
    return ordered if size is None else ordered.offset((page - 1) * size).limit(size)


def task_with_logs(tasks: DataFrame, logs: DataFrame) -> DataFrame:
    """Live tasks with their logs, one row per log line (and one for a task without).

    The lines of a task are not gathered into an array, so a task with a great many
    of them stays spread over rows; sort by ``logged_at`` to read them. An outer
    join cannot split a skewed inner side, an inner join can: hence the two parts.
    """
    live = live_tasks(tasks)
    lines = logs.select("task_id", F.col("id").alias("log_id"), "level", "message",
                        F.col("created_at").alias("logged_at"))
    told = live.join(lines, F.col("id") == F.col("task_id")).drop("task_id")
    silent = live.join(logs.select(F.col("task_id").alias("id")).distinct(), "id", "left_anti")
    return told.unionByName(silent, allowMissingColumns=True)


def task_transition(tasks: DataFrame, transitions: DataFrame) -> DataFrame:
    """Task states after ``transitions(seq, task_id, status, progress, error_message, changed_at)``.

    Later values win: a NULL progress and a blank error keep the old one; a final
    status sets the completion time and stops billing. Every rule is a "last of",
    so one grouped aggregate replaces walking the transitions.
    """
    def last(value, when=None):
        at = F.col("seq") if when is None else F.when(when, F.col("seq"))
        return F.max_by(value, at)

    final = F.col("status").isin(FINAL_TASK_STATUSES)
    error = F.coalesce(F.col("error_message"), F.lit(""))
    moves = transitions.groupBy("task_id").agg(
        last("status").alias("t_status"), last("changed_at").alias("t_at"),
        last("progress", F.col("progress").isNotNull()).alias("t_progress"),
        last("error_message", error != "").alias("t_error"),
        last("changed_at", final).alias("t_done"))
    joined = tasks.join(moves, F.col("id") == F.col("task_id"), "left")
    done = F.col("t_done").isNotNull()
    return joined.withColumns({
        "status": F.coalesce("t_status", "status"),
        "progress": F.coalesce("t_progress", "progress"),
        "error_message": F.coalesce("t_error", "error_message"),
        "updated_at": F.coalesce("t_at", "updated_at"),
        "completed_at": F.coalesce("t_done", "completed_at"),
        "is_billing": F.when(done, F.lit(False)).otherwise(F.col("is_billing")),
    }).select(*tasks.columns)


# --- writes -----------------------------------------------------------------

def new_tasks(requests: DataFrame, now=None, version=None) -> DataFrame:
    """First versions of tasks asked for by ``(name, source_connection, target_connection)``.

    Keeps a given ``id``; else makes one. Missing end points get the defaults.
    """
    now = F.current_timestamp() if now is None else now
    given = F.col("id") if "id" in requests.columns else F.lit(None).cast("string")
    values = {
        "id": F.coalesce(given, F.expr("uuid()")), "name": F.col("name"),
        "source_connection": F.coalesce(F.nullif("source_connection", F.lit("")), F.lit(DEFAULT_SOURCE)),
        "target_connection": F.coalesce(F.nullif("target_connection", F.lit("")), F.lit(DEFAULT_TARGET)),
        "status": F.lit("pending"), "progress": F.lit(0), "created_at": now, "updated_at": now,
        "completed_at": F.lit(None), "error_message": F.lit(None),
        "is_billing": F.lit(True), "is_deleted": F.lit(False),
        "version": F.lit(1) if version is None else version,
    }
    named = requests.where(F.coalesce("name", F.lit("")) != "")
    return named.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in TASKS])


def new_logs(lines: DataFrame) -> DataFrame:
    return lines.select(*[F.col(f.name).cast(f.dataType) for f in TASK_LOGS])


def soft_delete(tasks: DataFrame, ids: DataFrame, now=None) -> DataFrame:
    """New versions of the live tasks among ``ids(id)``; no row means no hit."""
    now = F.current_timestamp() if now is None else now
    return (live_tasks(tasks).join(ids.select("id").distinct(), "id", "left_semi")
            .withColumns({"is_deleted": F.lit(True), "updated_at": now,
                          "version": F.col("version") + 1}))


def task_messages(tasks: DataFrame, topic=TOPIC_UPDATES) -> DataFrame:
    """Messages to publish: topic, partition, key and JSON value."""
    return tasks.select(F.lit(topic).alias("topic"), F.lit(TOPIC_PARTITION).alias("partition"),
                        F.col("id").alias("key"), task_payload().alias("value"))


def publish_task_status(tasks: DataFrame, format="kafka", topic=TOPIC_UPDATES, **options) -> bool:
    """Publish status messages; a sink that cannot be reached is reported, not raised."""
    try:
        (task_messages(tasks, topic).write.format(format).options(**options)
                                    .mode("append").save())
        return True
    except Exception:  # noqa: BLE001 - a lost message must not fail the task
        return False
