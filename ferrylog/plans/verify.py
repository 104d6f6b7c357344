"""Verify a copy: counts, fingerprints and, where they differ, the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ferrylog.operators.verify import diff_by_digest, table_checksum


def verify_copy(source, target, tables) -> DataFrame:
    """Counts and fingerprints of both sides, one row per table."""
    sides = []
    for t in tables:
        stored = source.read(t)
        for side, df in (("source", stored), ("target", target.read(t).select(*stored.columns))):
            sides.append(table_checksum(df).withColumns(
                {"table_name": F.lit(t), "side": F.lit(side)}))

    def of(side, name):
        return F.max(F.when(F.col("side") == side, F.col(name)))

    same = F.lit(True)
    for name in ("row_count", "hash_xor", "hash_sum"):
        same = same & (of("source", name) == of("target", name))
    return reduce(DataFrame.unionByName, sides).groupBy("table_name").agg(
        of("source", "row_count").alias("source_rows"),
        of("target", "row_count").alias("target_rows"), same.alias("same"))


_DIFFERENCES = "table_name string, key string, state string, left_rows bigint, right_rows bigint"


def differing_rows(source, target, report: DataFrame, keys) -> DataFrame:
    """Keys that are missing, extra or changed in the tables that ``report`` finds unequal.

    ``keys`` has the key columns by table; tables without a key are left to the report.
    A key is given as JSON text.
    """
    found = [r.table_name for r in report.where("NOT same").select("table_name").collect()]  # one per table
    parts = []
    for t in found:
        if keys.get(t):
            stored = source.read(t)
            diff = diff_by_digest(stored, target.read(t).select(*stored.columns), keys[t])
            parts.append(diff.select(F.lit(t).alias("table_name"), F.to_json(F.struct(*keys[t])).alias("key"),
                                     "state", "left_rows", "right_rows"))
    if not parts:
        return report.sparkSession.createDataFrame([], _DIFFERENCES)
    return reduce(DataFrame.unionByName, parts)
