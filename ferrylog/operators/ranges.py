"""Ranges of a table by any key: cuts from a sample, predicates that reach the scan.

The order is the one Spark sorts by: column by column, NULL below every value, so first in
ascending columns and last in descending ones. A bound is a list of texts, one per key
column, so that a ledger can keep it; ``None`` stands for NULL.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Sampled rows for each range; ranges then differ by some 7 % in size.
SAMPLE = 200

Bound = Sequence[Optional[str]]


def orderable(kind: T.DataType) -> bool:
    """Can values of this type be kept as texts and come back the same?"""
    return isinstance(kind, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType,
                             T.TimestampType, T.TimestampNTZType))


def _text(name: str, kind: T.DataType) -> Column:
    at = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):  # an hour that a clock shows twice has two texts this way
        return F.unix_micros(at).cast("string")
    return F.hex(at) if isinstance(kind, T.BinaryType) else at.cast("string")


def _value(text: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    return F.unhex(F.lit(text)) if isinstance(kind, T.BinaryType) else F.lit(text).cast(kind)


def key_texts(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The key columns as a bound keeps them."""
    return [_text(k, df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)]


def bound_values(df: DataFrame, keys: Sequence[str], bound: Bound) -> list[Optional[Column]]:
    """A bound as literals of the columns' types."""
    return [None if t is None else _value(t, df.schema[k].dataType) for k, t in zip(keys, bound)]


def _side(keys, values, descending, after) -> tuple[Column, Column]:
    """Rows strictly on one side of the values, and rows equal to them.

    Plain comparisons of columns and literals, so they push down.
    """
    out, same = F.lit(False), F.lit(True)
    for key, value in zip(keys, values):
        at, greater = F.col(f"`{key}`"), after != (key in descending)
        if value is None:
            step, equal = (at.isNotNull() if greater else F.lit(False)), at.isNull()
        else:
            step, equal = (at > value if greater else (at < value) | at.isNull()), at == value
        out, same = out | (same & step), same & equal
    return out, same


def past(keys: Sequence[str], values: Sequence[Optional[Column]], descending: Sequence[str] = ()) -> Column:
    """Filter: rows after the values in key order."""
    return _side(keys, values, descending, True)[0]


def up_to(keys: Sequence[str], values: Sequence[Optional[Column]], descending: Sequence[str] = ()) -> Column:
    """Filter: rows at or before the values in key order."""
    before, same = _side(keys, values, descending, False)
    return before | same


def between(df: DataFrame, keys: Sequence[str], low: Optional[Bound], high: Optional[Bound],
            descending: Sequence[str] = ()) -> Column:
    """Filter: rows after ``low`` and at or before ``high``; ``None`` leaves an end open."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & past(keys, bound_values(df, keys, low), descending)
    if high is not None:
        inside = inside & up_to(keys, bound_values(df, keys, high), descending)
    return inside


def key_order(keys: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    return [F.col(f"`{k}`").desc() if k in descending else F.col(f"`{k}`").asc() for k in keys]


def key_cuts(df: DataFrame, keys: Sequence[str], ranges: int, rows: int,
             descending: Sequence[str] = ()) -> list[list[Optional[str]]]:
    """Bounds between about equal ranges, at most ``ranges - 1``, in key order.

    They come from a sample of the keys of about ``SAMPLE * ranges`` rows, which is what the
    driver sees. Rows of one key are never cut apart; a hot key makes its range larger.
    """
    if ranges < 2 or not rows:
        return []
    only = df.select(*[f"`{k}`" for k in keys])
    share = SAMPLE * ranges / rows
    sampled = only if share >= 1 else only.sample(share, 17)
    seen = [list(r) for r in sampled.orderBy(*key_order(keys, descending)).select(*key_texts(df, keys)).collect()]
    cuts = [seen[len(seen) * i // ranges] for i in range(1, ranges)] if seen else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def ordered_page(df: DataFrame, keys: Sequence[str], page: int, size: int, descending: Sequence[str] = (),
                 range_rows: int = 100_000, fan: int = 64) -> DataFrame:
    """One page of the rows in key order, with ``total``; only the range that holds it is sorted.

    Exact counts of ``fan`` ranges tell where the page lies, again within that range until it
    has at most ``range_rows`` rows. No earlier page is sorted or moved, however deep the page.
    Where one key has more rows than that, they are sorted together.
    """
    total = rows = df.count()
    first, before, scope = (page - 1) * size, 0, df
    while rows > range_rows and first < total:
        cuts = key_cuts(scope, keys, fan, rows, descending)
        if not cuts:
            break
        ends = list(scope.agg(*[
            F.count_if(up_to(keys, bound_values(df, keys, c), descending)).alias(f"n{i}")
            for i, c in enumerate(cuts)]).first())
        low = max((i for i, n in enumerate(ends) if n <= first - before), default=None)
        high = min((i for i, n in enumerate(ends) if n >= first + size - before), default=None)
        start = 0 if low is None else ends[low]
        left = (rows if high is None else ends[high]) - start
        if left >= rows:
            break
        scope = scope.where(between(df, keys, None if low is None else cuts[low],
                                    None if high is None else cuts[high], descending))
        before, rows = before + start, left
    return (scope.orderBy(*key_order(keys, descending)).offset(first - before).limit(size)
                 .withColumn("total", F.lit(total).cast("bigint")))
