"""The task dashboard: one page of tasks with their messages and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ferrylog.operators import tasks as op


def task_dashboard(tasks: DataFrame, logs: DataFrame, page=1, size=10) -> DataFrame:
    """The newest tasks of a page, each with its payload and one row per log line."""
    rows = op.page_tasks(tasks, page, size).drop("total")
    payload = op.task_messages(rows).select(F.col("key").alias("id"), F.col("value").alias("payload"))
    return (op.task_with_logs(rows, logs).join(payload, "id")
              .select("id", "status", "payload", "level", "message", "logged_at"))
