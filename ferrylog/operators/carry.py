"""Carry the last known value forward in log order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Events per chunk. A chunk spans that many sequence numbers, so with a unique
# sequence it can never hold more rows, whatever the key distribution.
CHUNK = 1_000_000


def _last_before(df, value, by, order, out):
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def carry_forward(df: DataFrame, value: str, seq="seq", by=(), out=None, chunk=CHUNK,
                  fan=1000) -> DataFrame:
    """``out`` = the latest non-null ``value`` at or before each row, per ``by`` key.

    One window per key would put a hot key, or with no key the whole log, into
    one task. Here rows are windowed inside (key, chunk); the last value of each
    chunk is carried over chunks, and over groups of ``fan`` chunks, on tables
    that shrink by the chunk size and by ``fan``. ``seq`` must be unique, and keys
    not NULL.
    """
    by, out = list(by), out or value
    s, c, g = "__seq", "__chunk", "__group"
    rows = (df.withColumn(s, F.col(seq))
              .withColumn(c, F.floor(F.col(s) / F.lit(chunk)).cast("bigint")))
    inside = Window.partitionBy(*by, c).orderBy(s).rowsBetween(Window.unboundedPreceding, 0)

    # One row per key and chunk: all of them by a plain distinct, and the last value of
    # those that have one. Only rows with a value are sorted for that; carried marks are
    # rare, and the filter on them reaches the scan.
    last = (rows.where(F.col(value).isNotNull()).groupBy(*by, c)
                .agg(F.max_by(value, s).alias("__end")))
    ends = (rows.select(*by, c).distinct().join(last, [*by, c], "left")
                .withColumn(g, F.floor(F.col(c) / F.lit(fan)).cast("bigint")))
    groups = (ends.groupBy(*by, g)
                  .agg(F.max_by("__end", F.when(F.col("__end").isNotNull(), F.col(c)))
                        .alias("__gend")))
    groups = _last_before(groups, "__gend", by, g, "__gin").drop("__gend")
    ends = (_last_before(ends, "__end", [*by, g], c, "__cin")
            .join(groups, [*by, g], "left")
            .select(*by, c, F.coalesce("__cin", "__gin").alias("__in")))

    local = F.last(value, ignorenulls=True).over(inside)
    return (rows.withColumn("__local", local)
                .join(ends, [*by, c], "left")
                .withColumn(out, F.coalesce("__local", "__in"))
                .drop("__local", "__in", s, c))
