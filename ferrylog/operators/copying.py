"""Copy operators: column lists, resume bounds, bad rows."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, functions as F

from ferrylog.functions.status import copy_decision
from ferrylog.functions.text import col
from ferrylog.operators.ranges import past


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Explicit, quoted column list in catalog order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def resume_filter(df: DataFrame, key: Optional[str], last_id, ordered=True) -> DataFrame:
    """Rows past the last copied key in key order; without key or id, the whole table. 0 is an id."""
    if not key or last_id is None:
        return df
    rest = df.where(F.col(key) > F.lit(last_id))
    return rest.orderBy(key) if ordered else rest


def resume_after(df: DataFrame, keys: Sequence[str], last: Sequence, descending: Sequence[str] = ()) -> DataFrame:
    """Rows past a composite key, column by column (plain comparisons, so they push down)."""
    return df.where(past(keys, [None if v is None else F.lit(v) for v in last], descending))


def append_new_rows(src: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows newer than anything in the target. The bound is one value, sent
    down as a literal so that the source can filter by it."""
    last = target.agg(F.max(key)).first()[0]
    return src if last is None else src.where(F.col(key) > F.lit(last))


class BadRowsError(RuntimeError):
    pass


def has_bad_rows(df: DataFrame, keys: Sequence[str], target: Optional[DataFrame] = None) -> bool:
    """Cheap test on the key columns alone, so clean tables never shuffle whole rows."""
    only = df.select(*keys)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    repeated = only.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null_key)
    if not repeated.limit(1).isEmpty():
        return True
    return target is not None and not (
        only.join(target.select(*keys), list(keys), "left_semi").limit(1).isEmpty())


def split_bad_rows(df: DataFrame, keys: Sequence[str], target: Optional[DataFrame] = None,
                   on_error="continue", keep: Callable[[DataFrame, str], DataFrame] = lambda rows, label: rows):
    """Split rows a keyed target would refuse: ``(good, quarantine)``.

    Reasons: a NULL key, a key that is already stored, a key repeated in the
    batch (the least row stays). Equal rows are folded into one with ``copies``
    before anything is shuffled by key, so a hot key costs no more than its
    distinct rows; quarantine rows carry ``copies``. Only rows whose key is repeated
    are compared with each other. ``keep(rows, label)`` may write what both results
    are made of, so that it is made once.
    """
    if on_error not in ("continue", "fail"):
        raise ValueError("on_error is 'continue' or 'fail'")
    keys, names = list(keys), df.columns
    rows = keep(df.groupBy(*names).agg(F.count(F.lit(1)).alias("copies")), "rows")
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nulls = rows.where(null_key).withColumn("reason", F.lit("null key"))
    keyed = rows.where(~null_key)
    parts = [nulls]
    if target is not None:
        stored = target.select(*keys).distinct()
        parts.append(keyed.join(stored, keys, "left_semi").select(*names, "copies")
                          .withColumn("reason", F.lit("key exists")))
        keyed = keyed.join(stored, keys, "left_anti").select(*names, "copies")
    repeated = keep(keyed.groupBy(*keys).agg(F.sum("copies").alias("__n")).where("__n > 1").select(*keys), "repeated")
    several = keyed.join(repeated, keys, "left_semi").select(*names, "copies")
    firsts = several.groupBy(*keys).agg(F.min(F.struct(*names)).alias("__first"))
    good = (keyed.join(repeated, keys, "left_anti").select(*names)
                 .unionByName(firsts.select("__first.*").select(*names)))
    again = (several.join(firsts, keys)
                  .withColumn("copies", F.col("copies") - F.when(
                      F.struct(*names) == F.col("__first"), 1).otherwise(0))
                  .where("copies > 0").select(*names, "copies")
                  .withColumn("reason", F.lit("duplicate key")))
    quarantine = reduce(DataFrame.unionByName, [*parts, again])
    if on_error == "fail":
        first = quarantine.select("reason").first()
        if first is not None:
            raise BadRowsError(first.reason)
    return good, quarantine


def plan_copy(tables: DataFrame, ledger: DataFrame) -> DataFrame:
    """New, restart or resume per table, with the counters to start from.

    A restart takes the new total and zero counters; a resume keeps the old total.
    """
    bounds = [c for c in ("last_migrated_id", "last_migrated_key") if c in ledger.columns]
    known = ledger.select("table_name", "status", "migrated_rows", *bounds,
                          F.col("total_rows").alias("old_total"))
    joined = tables.join(known, "table_name", "left")
    decision = copy_decision("status")
    resume = decision == "resume"
    return joined.select(
        "table_name", decision.alias("decision"),
        F.when(resume, F.col("old_total")).otherwise(col("row_count")).alias("total_rows"),
        F.when(resume, F.col("migrated_rows")).otherwise(F.lit(0)).alias("migrated_rows"),
        F.when(resume, F.col("last_migrated_id"))
         .when(decision == "restart", F.lit(0)).alias("last_migrated_id"),
        *[F.when(resume, F.col(c)).alias(c) for c in bounds[1:]],
        F.when(resume, F.lit("IN_PROGRESS")).otherwise(F.lit("PENDING")).alias("status"))
