"""Append-only control tables: progress ledger and checkpoints.

Each write appends versions; the latest version of a key is its state. Files stay
small because a row is written per table or per micro-batch, never per data row.

A log is a snapshot of the states and a tail of later writes. Once the tail has more
than ``TAIL`` writes, the next writer folds it into a new snapshot, which counts from the
moment its list of folded writes is there; readers list only what that leaves. What a
snapshot has folded is deleted by the one after it, when its readers are done. States
only advance, so a write that is read twice, or folded by two writers, does no harm.
"""

from __future__ import annotations

import time
import uuid
from typing import Optional

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrylog.functions.position import Position
from ferrylog.functions.status import INCOMPLETE, progress_pct
from ferrylog.schema import CHECKPOINTS, PROGRESS_LOG
from ferrylog.session import delete_path
from ferrylog.sources.files import child_names, exists


def latest_per_key(log: DataFrame, key, version="version") -> DataFrame:
    """Last write of each key. A grouped aggregate: versions fold before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), version).alias("r"))
               .select("r.*"))


def _next_version() -> int:
    return time.time_ns()


#: Writes behind a snapshot from which on they are folded.
TAIL = 64
_SNAPSHOT = "snapshot-"
# Columns that rows need not have: the bound of keys that are no single whole number.
_MAY_LACK = ("last_migrated_key",)


def _parts(spark: SparkSession, path: str) -> tuple[Optional[str], list[str], list[str]]:
    """Latest whole snapshot, the writes it has not folded, and what it makes superfluous."""
    names = [n for n in child_names(spark, path) if not n.startswith(("_", "."))]
    whole = [n for n in names if n.startswith(_SNAPSHOT) and exists(spark, f"{path}/{n}/folded/_SUCCESS")]
    tail = [n for n in names if not n.startswith(_SNAPSHOT)]
    if not whole:
        return None, tail, []
    folded = {r.name for r in spark.read.schema("name string").parquet(f"{path}/{whole[-1]}/folded").collect()}  # at most some more than TAIL
    return whole[-1], [n for n in tail if n not in folded], [*whole[:-1], *(n for n in tail if n in folded)]


def _read(spark, path, shape) -> DataFrame:
    snapshot, tail, _ = _parts(spark, path) if exists(spark, path) else (None, [], [])
    paths = [f"{path}/{n}" for n in tail] + ([f"{path}/{snapshot}/states"] if snapshot else [])
    return spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)


def _few_files(rows: DataFrame) -> DataFrame:
    """One file for few rows; many rows stay with many tasks, which get about equal shares."""
    return rows.hint("rebalance")


def _write(rows: DataFrame, path, shape, one=False):
    """Each write has a folder of its own, so writers of one log cannot disturb each other."""
    given = [F.lit(None) if f.name in _MAY_LACK and f.name not in rows.columns else F.col(f.name) for f in shape]
    rows = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(given, shape)])
    (rows.coalesce(1) if one else _few_files(rows)).write.parquet(f"{path}/{time.time_ns():020d}-{uuid.uuid4().hex}")


def _append(rows: DataFrame, path, shape, states, one=False):
    """Write, and fold a long tail; ``states`` gives the rows of a log that still count. ``one``: it is a single row."""
    _write(rows, path, shape, one)
    spark = rows.sparkSession
    if len(child_names(spark, path)) > TAIL:
        fold_tail(spark, path, shape, states)


def fold_tail(spark: SparkSession, path: str, shape, states, longest: Optional[int] = None):
    """Make a new snapshot if more than ``longest`` writes stand behind the last one."""
    longest = TAIL if longest is None else longest
    snapshot, tail, superfluous = _parts(spark, path)
    if len(tail) <= longest:
        return
    name = f"{path}/{_SNAPSHOT}{time.time_ns():020d}-{uuid.uuid4().hex}"
    _few_files(states(_read(spark, path, shape)).select(*[f.name for f in shape])).write.parquet(f"{name}/states")
    spark.createDataFrame([(n,) for n in tail], "name string").coalesce(1).write.parquet(f"{name}/folded")
    for old in superfluous:
        delete_path(spark, f"{path}/{old}")


# --- progress ---------------------------------------------------------------

def progress_versions(rows: DataFrame, version=None, deleted=False) -> DataFrame:
    """Ledger rows stamped as a new version."""
    stamp = F.lit(_next_version()) if version is None else version
    return rows.withColumns({"deleted": F.lit(deleted), "version": stamp})


def append_progress(rows: DataFrame, path: str, one=False):
    _append(progress_versions(rows), path, PROGRESS_LOG, _latest_progress, one)


def delete_progress(rows: DataFrame, path: str):
    """Delete the progress of the tables of some ledger rows."""
    _append(progress_versions(rows, deleted=True), path, PROGRESS_LOG, _latest_progress)


def _latest_progress(log: DataFrame) -> DataFrame:
    """Latest version of each table, tombstones too: they still count against older writes."""
    return latest_per_key(log, "table_name")


def current_progress(log: DataFrame) -> DataFrame:
    """State of the ledger: latest version of each table that is not a tombstone."""
    return latest_per_key(log, "table_name").where("NOT coalesce(deleted, false)")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return current_progress(_read(spark, path, PROGRESS_LOG))


def progress_tombstones(ledger: DataFrame, table: Optional[str] = None, version=None) -> DataFrame:
    """Rows that delete one table's progress, or everything."""
    gone = ledger if table is None else ledger.where(F.col("table_name") == table)
    return progress_versions(gone, version, deleted=True)


def clear_progress(spark: SparkSession, path: str, table: Optional[str] = None):
    _append(progress_tombstones(read_progress(spark, path), table), path, PROGRESS_LOG, _latest_progress)


def order_ledger(ledger: DataFrame) -> DataFrame:
    return ledger.orderBy("table_name")


def incomplete_tables(ledger: DataFrame) -> DataFrame:
    return order_ledger(ledger.where(F.col("status").isin(INCOMPLETE)))


def has_incomplete(ledger: DataFrame) -> bool:
    return not incomplete_tables(ledger).limit(1).isEmpty()


def progress_summary(ledger: DataFrame) -> DataFrame:
    """Table count and counts by status: one row."""
    def count(status):
        return F.count_if(F.col("status") == status)
    return ledger.agg(F.count(F.lit(1)).alias("tables"),
                      count("COMPLETED").alias("completed"),
                      count("IN_PROGRESS").alias("in_progress"),
                      count("FAILED").alias("failed"), count("PENDING").alias("pending"))


def progress_report(ledger: DataFrame) -> DataFrame:
    return ledger.select("table_name", "status", "migrated_rows", "total_rows",
                         progress_pct("migrated_rows", "total_rows").alias("progress_pct"))


# --- checkpoints ------------------------------------------------------------

def _later(a: Position, b: Optional[Position]) -> bool:
    return b is None or (a.file, a.pos) > (b.file, b.pos)


def save_checkpoint(spark: SparkSession, path: str, stream_id: str,
                    position: Optional[Position]) -> bool:
    """Record a position; NULL is ignored and a checkpoint never moves back."""
    if position is None or not _later(position, read_checkpoint(spark, path, stream_id)):
        return False
    now = _next_version()
    row = (stream_id, position.file, position.pos, position.gtid, now // 1_000_000, now)
    values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, CHECKPOINTS)]
    _append(spark.range(0, 1, 1, 1).select(*values), path, CHECKPOINTS, _greatest_checkpoints, one=True)
    return True


def current_checkpoints(log: DataFrame) -> DataFrame:
    return latest_per_key(log, "stream_id")


def _greatest_checkpoints(log: DataFrame) -> DataFrame:
    return latest_per_key(log, "stream_id", F.struct("file", "pos", "version"))


def advancing(log: DataFrame) -> DataFrame:
    """Checkpoint per stream that never moves back: the greatest position written."""
    at = F.struct("file", "pos")
    return (log.groupBy("stream_id").agg(F.max_by(F.struct("file", "pos", "gtid"), at).alias("p"))
               .select("stream_id", "p.*"))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoints of all streams."""
    return advancing(_read(spark, path, CHECKPOINTS))


def save_checkpoints(spark: SparkSession, path: str, positions: DataFrame):
    """Record the greatest of any number of positions ``(stream_id, file, pos, gtid)`` of each stream.

    Positions without a file or place are ignored and no checkpoint moves back.
    """
    at, now = F.struct("file", "pos"), _next_version()
    new = advancing(positions.where("file IS NOT NULL AND pos IS NOT NULL"))
    old = read_checkpoints(spark, path).select(F.col("stream_id").alias("__stream"), at.alias("__old"))
    moved = new.join(old, F.col("stream_id").eqNullSafe(F.col("__stream")), "left").where(F.col("__old").isNull() | (at > F.col("__old")))
    rows = moved.withColumns({"ts_ms": F.lit(now // 1_000_000), "version": F.lit(now)})
    _append(rows, path, CHECKPOINTS, _greatest_checkpoints)


def read_checkpoint(spark: SparkSession, path: str, stream_id: str) -> Optional[Position]:
    row = (advancing(_read(spark, path, CHECKPOINTS).where(F.col("stream_id") == stream_id))
           .first())
    return Position(row.file, row.pos, row.gtid) if row else None
