"""Log positions as columns: text form, order and checkpoint tests.

A position is ``(file, pos)`` with an optional transaction id. File names are
compared as text, then offsets as numbers.
"""

from __future__ import annotations

from typing import NamedTuple, Optional

from pyspark.sql import Column, DataFrame, functions as F

from ferrylog.functions.text import col, colon_parts, part, to_bigint


class Position(NamedTuple):
    """One position held on the driver (a control value, never data)."""

    file: str
    pos: int
    gtid: Optional[str] = None


def format_position(file, pos) -> Column:
    return F.concat(col(file), F.lit(":"), col(pos).cast("string"))


def parse_position(text) -> Column:
    """``file:offset`` to a struct; NULL unless it has two parts and an integer offset."""
    parts = colon_parts(text)
    pos = to_bigint(part(parts, 1))
    return F.when((F.size(parts) == 2) & pos.isNotNull(),
                  F.struct(part(parts, 0).alias("file"), pos.alias("pos")))


def position_key(file="file", pos="pos", numeric_suffix=False) -> Column:
    """Sortable struct. ``numeric_suffix`` orders log.1000000 after log.999999."""
    file = col(file)
    if not numeric_suffix:
        return F.struct(file.alias("file"), col(pos).alias("pos"))
    number = F.regexp_extract(file, r"([0-9]+)$", 1).try_cast("bigint")
    return F.struct(F.regexp_replace(file, r"[0-9]+$", "").alias("stem"),
                    number.alias("number"), col(pos).alias("pos"))


def gtid_interval_end(text) -> Column:
    """``5`` is 5 and ``1-5`` is 5; NULL when there is no such number."""
    text = col(text)
    return to_bigint(F.when(text.contains("-"), part(F.split(text, "-", -1), 1)).otherwise(text))


def gtid_after(a, b) -> Column:
    """Is transaction ``a`` later than ``b``? Another server counts as later."""
    left, right = colon_parts(a), colon_parts(b)
    later = gtid_interval_end(part(left, 1)) > gtid_interval_end(part(right, 1))
    return (F.when((F.size(left) != 2) | (F.size(right) != 2), F.lit(False))
             .when(part(left, 0) != part(right, 0), F.lit(True))
             .otherwise(F.coalesce(later, F.lit(False))))


def file_pos_after(file, pos, other_file, other_pos) -> Column:
    file, other_file = col(file), col(other_file)
    return (file > other_file) | ((file == other_file) & (col(pos) > col(other_pos)))


def is_after(file, pos, gtid, c_file, c_pos, c_gtid) -> Column:
    """Transaction ids decide when both sides have one, else file and offset."""
    gtid, c_gtid = col(gtid), col(c_gtid)
    both = (F.coalesce(gtid, F.lit("")) != "") & (F.coalesce(c_gtid, F.lit("")) != "")
    return (F.when(F.isnull(c_file), F.lit(True))
             .when(both, gtid_after(gtid, c_gtid))
             .otherwise(file_pos_after(file, pos, c_file, c_pos)))


def after_checkpoint(entries: DataFrame, checkpoint) -> DataFrame:
    """Keep entries past the checkpoint: a Position, a one-row DataFrame or None.

    A DataFrame is used through scalar subqueries, so it may stay lazy.
    """
    if checkpoint is None:
        return entries
    if isinstance(checkpoint, DataFrame):
        c = [checkpoint.select(name).scalar() for name in ("file", "pos", "gtid")]
    else:
        c = [F.lit(checkpoint.file), F.lit(checkpoint.pos),
             F.lit(checkpoint.gtid).cast("string")]
    return entries.where(is_after("file", "pos", "gtid", *c))


def start_from(events: DataFrame, position: Optional[Position]) -> DataFrame:
    """Begin reading at a position: events at it or later, in log order."""
    if position is None:
        return events
    file, pos = F.col("file"), F.col("pos")
    return events.where((file > position.file) | ((file == position.file) & (pos >= position.pos)))


def entry_id(file="file", pos="pos", sql="sql", row_no=None) -> Column:
    """Identity of an executed entry. With ``row_no`` equal statements of one event differ."""
    parts = [col(file), col(pos).cast("string"), F.sha2(col(sql), 256)]
    if row_no is not None:
        parts.append(col(row_no).cast("string"))
    return F.concat_ws(":", *parts)
