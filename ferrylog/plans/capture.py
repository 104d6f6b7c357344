"""Capture row changes to export files, and read them back into a table."""

from __future__ import annotations

from typing import NamedTuple, Optional

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ferrylog.functions.position import Position, after_checkpoint, entry_id, start_from
from ferrylog.operators.events import filter_tables, last_position
from ferrylog.operators.fold import ORDER, apply_changes
from ferrylog.operators.numbering import roll_files
from ferrylog.operators.statements import parse_statements
from ferrylog.schema import DELETE, INSERT, UPDATE
from ferrylog.session import materialize
from ferrylog.sinks.exports import export_numbered, render_changes
from ferrylog.sources.exports import dedup_entries, number_repeats, read_sql_export


def capture_to_files(changes: DataFrame, schema: T.StructType, folder: str, stamp: str,
                     generated: str, databases=None, tables=None,
                     start: Optional[Position] = None, size=10000) -> DataFrame:
    """Filter typed row changes, render them and write rolling export files."""
    kept = filter_tables(start_from(changes, start), databases, tables)
    # Number first: the range sort reads its input twice, and changes are cheaper to
    # read again than statements are to render again.
    numbered = roll_files(kept.where(F.col("op").isin(INSERT, UPDATE, DELETE)), size=size)
    return export_numbered(render_changes(numbered, schema), folder, stamp, generated)


class Parsed(NamedTuple):
    changes: DataFrame   # typed row changes, ready for apply_changes
    rejected: DataFrame  # statements that could not be read, with the reason


def changes_of_entries(entries: DataFrame, schema: T.StructType, table: Optional[str] = None,
                       checkpoint=None) -> Parsed:
    """Entries past the checkpoint as typed changes of one table.

    Statements of one event share its position and keep their order by entry
    number. A statement exported twice, in two files, counts once; the n-th equal
    statement inside one event is a change of its own.
    """
    fresh = number_repeats(after_checkpoint(entries, checkpoint))
    fresh = dedup_entries(fresh.withColumn("entry_id", entry_id(row_no="repeat_no")))
    parsed = parse_statements(fresh, schema).withColumn("row_no", F.col("entry_no"))
    if table is not None:
        parsed = parsed.where(F.col("error").isNotNull()
                              | (F.concat_ws(".", "database", "table") == table)
                              | (F.col("table") == table))
    # Written once: the rejected rows and each pass of the apply read it again.
    parsed = materialize(parsed, "parsed")
    good = parsed.where("error IS NULL").select(
        "source_file", "entry_no", "row_no", "file", "pos", "gtid", "database", "table", "op",
        "before", "after")
    return Parsed(good, parsed.where("error IS NOT NULL").select(
        "source_file", "entry_no", "file", "pos", "gtid", "sql", "error"))


# Entries of one event may continue in the next export file.
ENTRY_ORDER = ("file", "pos", "source_file", "row_no")


def incremental_replay(spark: SparkSession, folder: str, target: DataFrame, keys,
                       table: Optional[str] = None, checkpoint=None, null_match="safe"):
    """Replay export files onto a table: ``(new table, reached position, rejected)``."""
    entries = materialize(read_sql_export(spark, folder), "entries")  # for the changes and the position
    parsed = changes_of_entries(entries, target.schema, table, checkpoint)
    out = apply_changes(target, parsed.changes, keys, null_match, ENTRY_ORDER)
    return out, last_position(after_checkpoint(entries, checkpoint)), parsed.rejected


def capture_and_apply(changes: DataFrame, target: DataFrame, keys, databases=None, tables=None,
                      start: Optional[Position] = None, null_match="safe") -> DataFrame:
    """Direct mode: filtered changes go to the table without files in between."""
    kept = filter_tables(start_from(changes, start), databases, tables)
    return apply_changes(target, kept, keys, null_match, ORDER)
