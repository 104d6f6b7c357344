"""Full copy of a source: create targets, copy rows in committed ranges, keep a ledger."""

from __future__ import annotations

import hashlib
import json
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Mapping, Optional, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.util import inheritable_thread_target

from ferrylog.errors import first_line
from ferrylog.functions.position import Position
from ferrylog.operators.copying import (append_new_rows, has_bad_rows, plan_copy, project_columns,
                                         resume_filter, split_bad_rows)
from ferrylog.operators.ranges import between, key_cuts, orderable
from ferrylog.schema import PROGRESS_LOG
from ferrylog.sinks.ledger import append_progress, read_progress, save_checkpoint
from ferrylog.sinks.tables import BATCH_SIZE, JdbcTable, create_tables, write_table
from ferrylog.session import delete_path
from ferrylog.sources.files import child_names, exists, make_folder, move
from ferrylog.sources.tables import (attach_keys, column_catalog, primary_keys, row_counts,
                                     skip_empty_tables)


@dataclass
class CopyConfig:
    """Switches of a copy and where its control tables live."""

    ledger_path: str
    checkpoint_path: Optional[str] = None
    batch_size: int = BATCH_SIZE
    create_tables: bool = True
    drop_tables: bool = False
    migrate_data: bool = True
    continue_on_error: bool = False
    enable_resume: bool = True
    included_tables: Sequence[str] = field(default_factory=tuple)
    ranges: int = 1  # committed units per table, cut by key quantiles
    descending_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)  # by table: key columns in falling order
    read_partitions: int = 8  # parallel reads of one table behind JDBC
    parallel_tables: int = 4  # tables in flight; each is a distributed job
    quarantine_path: Optional[str] = None  # refused rows, one folder per table, in it one per range


class FolderTarget:
    """Targets as Parquet folders ``<root>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table):
        return f"{self.root}/{table}.parquet"

    def create(self, columns: DataFrame, tables, drop: bool) -> list[tuple]:
        """Folders appear with the first write; dropping replaces them by an empty table."""
        for t in tables:
            if drop and exists(self.spark, self.path(t)):
                old = self.spark.read.parquet(self.path(t))
                self.spark.createDataFrame([], old.schema).write.mode("overwrite").parquet(self.path(t))
        return [(t, True, None) for t in tables]

    def read(self, table) -> Optional[DataFrame]:
        return (self.spark.read.parquet(self.path(table))
                if exists(self.spark, self.path(table)) else None)

    def write(self, df, table, batch_size, mode="append"):
        write_table(df, self.path(table), batch_size, mode)

    def write_once(self, df, table, batch_size, stage) -> int:
        """Append rows without a key exactly once, however often it is tried.

        They are written apart, then their files move over one by one; what has moved
        is no longer there to move. The stage stays until the caller has noted the end.
        """
        if not exists(self.spark, f"{stage}/_SUCCESS"):
            self.write_stage(df, stage, batch_size)
        rows = self.spark.read.parquet(f"{stage}-count").first()[0]
        make_folder(self.spark, self.path(table))
        for name in child_names(self.spark, stage, ".parquet"):
            move(self.spark, f"{stage}/{name}", f"{self.path(table)}/{name}")
        return rows

    def write_stage(self, df, stage, batch_size):
        seen = Observation()
        write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{stage}-new", batch_size, "overwrite")
        self.spark.createDataFrame([(seen.get.get("rows") or 0,)], "rows long").write.mode("overwrite").parquet(f"{stage}-count")
        delete_path(self.spark, stage)
        move(self.spark, f"{stage}-new", stage)


def _missing_rows(df, stored):
    """The rows of ``df`` that ``stored`` has not, repeated rows counted."""
    return df if stored is None else df.exceptAll(stored.select(*df.columns))


class CatalogTarget:
    """Targets as tables of a session-catalog database; ``types="mysql"`` for sources with MySQL column types."""

    def __init__(self, spark: SparkSession, database="default", types="spark"):
        self.spark, self.database, self.types = spark, database, types

    def create(self, columns, tables, drop):
        return create_tables(self.spark, columns, self.database, drop, types=self.types)

    def read(self, table):
        name = f"`{self.database}`.`{table}`"
        return self.spark.table(name) if self.spark.catalog.tableExists(f"{self.database}.{table}") else None

    def write(self, df, table, batch_size, mode="append"):
        df.write.mode(mode).saveAsTable(f"`{self.database}`.`{table}`")

    def write_once(self, df, table, batch_size, stage) -> int:
        """Append what is not there yet; older equal rows count as there."""
        rows = df.count()
        self.write(_missing_rows(df, self.read(table)), table, batch_size)
        return rows


class JdbcTarget:
    """Targets as JDBC tables, created by the first write."""

    def __init__(self, spark: SparkSession, url: str, properties=None):
        self.spark, self.url, self.properties = spark, url, dict(properties or {})

    def create(self, columns, tables, drop):
        return [(t, True, None) for t in tables]

    def read(self, table):
        """The stored table, or None if the database says that there is none; other errors are raised."""
        try:
            return self.spark.read.jdbc(self.url, table, properties=self.properties)
        except Exception as e:  # noqa: BLE001 - raised again unless the table is missing
            if self._missing(e):
                return None
            raise

    @staticmethod
    def _missing(error) -> bool:
        """SQLSTATE class 42 with a missing table: 42S02, 42P01 (as others write it), 42X05."""
        cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
        while cause is not None:
            if hasattr(cause, "getSQLState"):
                try:
                    return cause.getSQLState() in ("42S02", "42P01", "42X05")
                except Exception:  # noqa: BLE001 - no SQL error
                    pass
            cause = cause.getCause()
        return False

    def write(self, df, table, batch_size, mode="append"):
        write_table(df, JdbcTable(self.url, table, self.properties), batch_size, mode)

    def write_once(self, df, table, batch_size, stage) -> int:
        """Append what is not there yet; older equal rows count as there."""
        rows = df.count()
        self.write(_missing_rows(df, self.read(table)), table, batch_size)
        return rows


def key_bounds(df: DataFrame, key: str, ranges: int) -> list[int]:
    """Upper ends of about equal key ranges (``ranges`` values, last one the maximum)."""
    shares = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.max(key).alias("top"),
                 F.percentile_approx(key, shares or [0.5], 10000).alias("cuts")).first()
    cuts = sorted(set(row.cuts or [])) if shares else []
    return [c for c in cuts if c < row.top] + [row.top] if row.top is not None else []


def _ledger_row(spark, **values) -> DataFrame:
    shape = T.StructType([f for f in PROGRESS_LOG if f.name not in
                          ("start_time", "last_update_time", "complete_time", "deleted", "version")])
    row = spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in shape])
    done = values.get("status") == "COMPLETED"
    return row.withColumns({
        "start_time": F.current_timestamp(), "last_update_time": F.current_timestamp(),
        "complete_time": F.current_timestamp() if done else F.lit(None).cast("timestamp")})


def _write_counted(target, df, table, cfg, mode="append") -> int:
    """Write and count in one pass."""
    seen = Observation()
    target.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), table, cfg.batch_size, mode)
    return seen.get.get("rows") or 0


def _copy_range(part, step, target, cfg, stored, keys, low):
    """Copy the range after ``low``: ``(rows now in the target, rows refused)``.

    A range that is copied again has the same ``low``, whatever its other end, and replaces
    the quarantine of the attempt that was not committed.
    """
    table, there, refused, spark = step.table_name, 0, 0, part.sparkSession
    if not keys:
        return target.write_once(part, table, cfg.batch_size, f"{cfg.ledger_path}-stage/{table}"), refused
    resumed = stored is not None and step.decision == "resume"
    folder = None
    if cfg.quarantine_path:
        folder = f"{cfg.quarantine_path}/{table}/range_id=r{hashlib.sha256(json.dumps(low).encode()).hexdigest()[:16]}"
        if step.decision == "resume":
            delete_path(spark, folder)
    apart = f"{cfg.ledger_path}-apart/{table}"

    def keep(rows, label):
        rows.write.mode("overwrite").parquet(f"{apart}/{label}")
        return spark.read.schema(rows.schema).parquet(f"{apart}/{label}")

    split = has_bad_rows(part, keys, None if resumed else stored)
    if split:
        part, quarantine = split_bad_rows(part, keys, None if resumed else stored,
                                          "continue" if cfg.continue_on_error else "fail", keep)
        if folder:
            quarantine.write.mode("overwrite").parquet(folder)
            quarantine = spark.read.schema(quarantine.schema).parquet(folder)
        refused = quarantine.agg(F.sum("copies")).first()[0] or 0
    if resumed and not stored.limit(1).isEmpty():
        # Rows written just before a crash are already there; they are not errors.
        there = part.join(stored.select(*keys), keys, "left_semi").count()
        part = part.join(stored.select(*keys), keys, "left_anti").select(*part.columns)
    copied = there + _write_counted(target, part, table, cfg)
    if split:
        delete_path(spark, apart)
    return copied, refused


def _number_ranges(rest, key, last, ranges):
    """``(filter of the rows, filter of the stored rows, id, key bound)`` of ranges of one whole-number key.

    Rows without a key belong to the first range of a new copy, where they are refused.
    """
    for bound in key_bounds(rest, key, ranges) or [None]:
        if bound is None:
            yield None, None, last, None
            continue
        at, fresh = F.col(key), last is None
        inside = (at <= F.lit(bound)) if fresh else (at > F.lit(last)) & (at <= F.lit(bound))
        yield (inside | at.isNull() if fresh else inside), inside, bound, None
        last = bound


def _key_ranges(rest, keys, mark, last, ranges, rows, descending):
    """The same for keys of any columns; the last range is open, so its bound is the one before."""
    low = mark
    for high in [*key_cuts(rest, keys, ranges, rows, descending), None]:
        inside = between(rest, keys, low, high, descending)
        low = high or low
        whole = low and low[0] is not None and isinstance(rest.schema[keys[0]].dataType, T.IntegralType)
        yield inside, inside, int(low[0]) if whole else last, low


def _copy_table(spark, source, target, cfg, step, columns, key, keys):
    """Copy one table range by range; each committed range moves the ledger's bound.

    Ranges hold all rows of a key, so a resume can neither skip nor repeat a row. One
    whole-number key has its own bound (``last_migrated_id``), other keys have all of their
    columns in ``last_migrated_key``.
    """
    table, done, bad = step.table_name, step.migrated_rows, 0
    rows = project_columns(source.read(table), columns)
    numeric = key is not None and isinstance(rows.schema[key].dataType, T.IntegralType)
    descending = tuple(cfg.descending_keys.get(table, ()))
    by_number = numeric and len(keys) == 1 and not descending
    by_key = bool(keys) and not by_number and all(orderable(rows.schema[k].dataType) for k in keys)
    mark = json.loads(step.last_migrated_key) if by_key and step.last_migrated_key else None
    # Nothing copied, no bound. A number that stands alone for a wider key is an older ledger's.
    last = step.last_migrated_id if numeric and step.migrated_rows and not descending else None
    split = source.key_range(table, key, cfg.read_partitions) if numeric else None
    if split is not None:
        rows = project_columns(source.read(table, split), columns)

    def note(status):
        append_progress(_ledger_row(spark, table_name=table, total_rows=step.total_rows, migrated_rows=done,
                                    last_migrated_id=last, status=status,
                                    last_migrated_key=None if mark is None else json.dumps(mark)), cfg.ledger_path, one=True)

    note(step.status)
    if step.decision == "resume" and last is None and mark is None:
        done = 0  # no bound to resume from: the whole table again, stored keys skipped
    if mark is not None:
        rest = rows.where(between(rows, keys, mark, None, descending))
    else:
        rest = resume_filter(rows, key if numeric else None, last, ordered=False)
    if by_number:
        parts = list(_number_ranges(rest, key, last, cfg.ranges))
    elif by_key:
        parts = list(_key_ranges(rest, keys, mark, last, cfg.ranges, step.total_rows, descending))
    else:
        parts = [(None, None, last, None)]
    for i, (inside, there, next_id, next_mark) in enumerate(parts, 1):
        part, stored = rest, target.read(table) if keys else None
        if inside is not None:
            part, stored = part.where(inside), None if stored is None else stored.where(there)
        copied, refused = _copy_range(part, step, target, cfg, stored, keys, [last, mark])
        done, bad, last, mark = done + copied, bad + refused, next_id, next_mark
        note("COMPLETED" if i == len(parts) else step.status)
    if not keys:
        for suffix in ("", "-count"):
            delete_path(spark, f"{cfg.ledger_path}-stage/{table}{suffix}")
    return done, bad


_RESULT = "table_name string, copied bigint, refused bigint, error string"


def full_copy(spark: SparkSession, source, target, cfg: CopyConfig,
              snapshot: Optional[Position] = None) -> DataFrame:
    """Copy every table; returns copied and refused rows per table.

    The log position is recorded first, so a later replay starts before the copy.
    The loop is over tables and key ranges; rows never leave the executors.
    """
    if cfg.checkpoint_path:
        save_checkpoint(spark, cfg.checkpoint_path, "copy", snapshot)
    columns = attach_keys(column_catalog(source, cfg.included_tables), primary_keys(source))
    catalog = {}
    for r in sorted(columns.collect(), key=lambda r: (r.table_name, r.ordinal)):  # one per column
        entry = catalog.setdefault(r.table_name, ([], []))
        entry[0].append(r.column_name)
        if r.is_primary_key:
            entry[1].append(r.column_name)
    if cfg.create_tables:
        for name, created, error in target.create(columns, sorted(catalog), cfg.drop_tables):
            if not created and not cfg.continue_on_error:
                raise RuntimeError(f"{name}: {error}")
    if not cfg.migrate_data:
        return spark.createDataFrame([], _RESULT)
    counts = skip_empty_tables(row_counts(source, sorted(catalog)))
    ledger = read_progress(spark, cfg.ledger_path)
    if not cfg.enable_resume:
        ledger = ledger.limit(0)
    failed = threading.Event()

    def copy_one(step):
        if failed.is_set() and not cfg.continue_on_error:
            return None
        names, keys = catalog[step.table_name]
        try:
            done, bad = _copy_table(spark, source, target, cfg, step, names,
                                    keys[0] if keys else None, keys)
            return step.table_name, done, bad, None
        except Exception as e:  # noqa: BLE001 - policy decides
            failed.set()
            error = first_line(e)
            now = read_progress(spark, cfg.ledger_path).where(
                F.col("table_name") == step.table_name).first() or step
            append_progress(_ledger_row(
                spark, table_name=step.table_name, total_rows=now.total_rows,
                migrated_rows=now.migrated_rows, last_migrated_id=now.last_migrated_id,
                last_migrated_key=now.last_migrated_key, status="FAILED", error_message=error), cfg.ledger_path, one=True)
            if not cfg.continue_on_error:
                raise
            return step.table_name, -1, 0, error

    steps = sorted(plan_copy(counts, ledger).collect(), key=lambda r: r.table_name)  # one per table
    with ThreadPoolExecutor(cfg.parallel_tables) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(copy_one), step) for step in steps]
    results = [r.result() for r in runs]
    return spark.createDataFrame([r for r in results if r is not None], _RESULT)


def copy_new_rows(spark: SparkSession, source, target, keys, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One round of a periodic copy: per table, rows whose key is past all that the target has.

    ``keys`` has one ascending key column by table. Returns the rows added.
    """
    added = []
    for table, key in keys.items():
        rows, stored = source.read(table), target.read(table)
        new = rows if stored is None else append_new_rows(rows, stored, key)
        seen = Observation()
        target.write(new.observe(seen, F.count(F.lit(1)).alias("rows")), table, batch_size)
        added.append((table, seen.get.get("rows") or 0))
    return spark.createDataFrame(added, "table_name string, added bigint")
