"""Change statements to rolling export files."""

from __future__ import annotations

import posixpath
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ferrylog.functions.render import render_change, statement_terminator
from ferrylog.functions.text import qualified_name
from ferrylog.operators.once import compute_once
from ferrylog.operators.numbering import STATEMENTS_PER_FILE, roll_files
from ferrylog.session import materialize
from ferrylog.sources.files import make_folder

# Header lines of an export file and marks of an entry.
HEADER = ("-- Binlog SQL Export\n"
          "-- Generated at: {generated}\n"
          "-- File: {name}\n"
          "-- Format: [POSITION] filename:position, [GTID] gtid_value, SQL statement\n"
          "\n")
FILE_STEM = "binlog_sql_{stamp}_{number:04d}.sql"


def render_changes(changes: DataFrame, schema) -> DataFrame:
    """Row changes to terminated statements; blank ones are dropped."""
    named = compute_once(changes, __name=qualified_name("database", "table"))
    rendered = compute_once(named, __sql=render_change(schema, table="__name"))
    return (compute_once(rendered, sql=statement_terminator("__sql"))
            .where("sql IS NOT NULL").drop("__name", "__sql"))


def entry_text(file="file", pos="pos", gtid="gtid", sql="sql") -> Column:
    """Text of one entry; a missing position leaves the two header lines out."""
    head = F.concat(F.lit("[POSITION] "), F.col(file), F.lit(":"), F.col(pos).cast("string"),
                    F.lit("\n[GTID] "), F.coalesce(F.col(gtid), F.lit("")), F.lit("\n"))
    return F.concat(F.coalesce(head, F.lit("")), F.col(sql), F.lit("\n\n"))


def _writer(folder, stamp, generated):
    """Write each file number of a sorted partition under a temporary name, then
    move it, so a reader never sees half a file and a retried task repeats itself."""
    from pyarrow import fs as arrow_fs

    def write(batches):
        target, root = arrow_fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        number, stream, temp, done = None, None, None, []

        def close():
            if stream is not None:
                stream.close()
                target.move(temp, posixpath.join(root, done[-1][1]))

        for batch in batches:
            for n, part in batch.groupby("file_no", sort=True):
                if n != number:
                    close()
                    number, name = n, FILE_STEM.format(stamp=stamp, number=n)
                    temp = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
                    stream = target.open_output_stream(temp)
                    stream.write(HEADER.format(generated=generated, name=name).encode())
                    done.append([int(n), name, 0])
                stream.write("".join(part["text"]).encode())
                done[-1][2] += len(part)
        close()
        if done:
            yield pd.DataFrame(done, columns=["file_no", "file_name", "statements"])

    return write


def export_numbered(numbered: DataFrame, folder: str, stamp: str, generated: str) -> DataFrame:
    """Write statements that already have ``file_no`` and ``statement_no``.

    ``folder`` is a URI or absolute path all executors reach. A file is one task's
    work and holds a bounded number of statements. Returns one row per file:
    ``(file_no, file_name, statements)``.
    """
    make_folder(numbered.sparkSession, folder)  # there even if nothing is exported
    placed = (numbered.select("file_no", "statement_no", entry_text().alias("text"))
                      .repartition("file_no").sortWithinPartitions("file_no", "statement_no")
                      .select("file_no", "text"))
    written = placed.mapInPandas(_writer(folder, stamp, generated),
                                 "file_no long, file_name string, statements long")
    return materialize(written, "export-files")


def export_sql(statements: DataFrame, folder: str, stamp: str, generated: str,
               order_by=("file", "pos", "row_no"), size=STATEMENTS_PER_FILE) -> DataFrame:
    """Write ``sql`` statements in log order, a new file after ``size`` of them."""
    return export_numbered(roll_files(statements, order_by, size), folder, stamp, generated)


def export_stats(statements: DataFrame) -> DataFrame:
    """Statements per file, with a total line (NULL file number) and the file count."""
    per_file = statements.groupBy("file_no").agg(F.count(F.lit(1)).alias("statements"))
    return per_file.rollup("file_no").agg(F.sum("statements").alias("statements"),
                                          F.count(F.lit(1)).alias("files"))
