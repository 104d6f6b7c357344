"""Ledger and task state rules as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ferrylog.functions.text import col

# Ledger states and the task stages' progress marks.
PENDING, IN_PROGRESS, COMPLETED, FAILED = "PENDING", "IN_PROGRESS", "COMPLETED", "FAILED"
INCOMPLETE = [PENDING, IN_PROGRESS, FAILED]
STAGE_MARKS = [10, 20, 30, 40, 50, 70, 90, 100]
# Task statuses that end a task and stop its billing.
FINAL_TASK_STATUSES = ["completed", "failed"]


def progress_pct(migrated, total) -> Column:
    total = col(total)
    share = col(migrated).cast("double") / F.nullif(total, F.lit(0)).cast("double") * F.lit(100.0)
    return F.when(total == 0, F.lit(0.0)).otherwise(share)


def copy_decision(status) -> Column:
    """What a copy start does with the ledger status of its table."""
    status = col(status)
    return (F.when(status.isNull(), F.lit("new"))
             .when(status == COMPLETED, F.lit("restart"))
             .otherwise(F.lit("resume")))


def next_status(event, status) -> Column:
    """Ledger status after an event: start, complete, fail or reset."""
    event = col(event)
    fresh = col(status).isNull() | (col(status) == COMPLETED)
    return (F.when(event == "start", F.when(fresh, F.lit(PENDING)).otherwise(F.lit(IN_PROGRESS)))
             .when(event == "complete", F.lit(COMPLETED))
             .when(event == "fail", F.lit(FAILED))
             .when(event == "reset", F.lit(PENDING))
             .otherwise(col(status)))


def task_resume_stage(progress) -> Column:
    """First stage mark above the progress; a finished task starts over."""
    marks = F.array(*[F.lit(m) for m in STAGE_MARKS])
    above = F.filter(marks, lambda m: m > F.coalesce(col(progress), F.lit(0)))
    return F.coalesce(F.get(above, F.lit(0)), F.lit(STAGE_MARKS[0]))


def task_payload(name="name", id="id", source="source_connection", target="target_connection",
                 created="created_at", progress="progress", status="status",
                 updated="updated_at") -> Column:
    """JSON status message of a task; a missing progress is 0."""
    def iso(c):
        return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.to_json(F.struct(
        col(name).alias("taskName"), col(id).alias("taskId"),
        col(source).alias("sourceConnection"), col(target).alias("targetConnection"),
        iso(created).alias("createTime"),
        F.coalesce(col(progress), F.lit(0)).alias("executionProgress"),
        col(status).alias("currentStatus"), iso(updated).alias("updateTime")))
