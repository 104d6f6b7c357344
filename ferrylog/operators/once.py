"""Compute columns exactly once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def compute_once(df: DataFrame, **columns) -> DataFrame:
    """Add columns that later steps use many times.

    Projections are merged and filters pushed by copying expressions into every
    use; a costly text expression would then run once per use. A generator is not
    copied through, so each expression here runs once.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
