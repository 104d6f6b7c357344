"""Small text helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Control characters and the blank count as white space.
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every character up to U+0020, not only blanks."""
    return F.regexp_replace(col(c), _EDGE_BLANKS, "")


def to_bigint(c) -> Column:
    """Whole-text integer, else NULL (no inner or outer blanks accepted)."""
    c = col(c)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))


def colon_parts(c) -> Column:
    """Split at colons; empty parts at the end do not count."""
    return F.split(F.regexp_replace(col(c), ":+$", ""), ":", -1)


def part(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def name_list(c) -> Column:
    """Comma list to distinct trimmed names, blanks dropped, in first-seen order."""
    names = F.transform(F.split(F.coalesce(col(c), F.lit("")), ","), strip)
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def quote_ident(c) -> Column:
    return F.concat(F.lit("`"), col(c), F.lit("`"))


def qualified_name(database, table) -> Column:
    return F.concat(col(database), F.lit("."), col(table))


def export_file_name(ts, n) -> Column:
    """``binlog_sql_<yyyyMMdd_HHmmss>_<4-digit number>.sql``."""
    return F.format_string("binlog_sql_%s_%04d.sql",
                           F.date_format(col(ts), "yyyyMMdd_HHmmss"), col(n))
