"""Whole rows through a decision on their text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


def keep_rows(docs: DataFrame, keep, *given: Column, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``keep`` marks, with all their columns as they are.

    ``keep(texts, *given)`` gets Arrow columns and gives ``(a, b, marks)`` for slices ``[a:b]``
    of them. A text goes to Python once, inside its row; only kept rows come back, slice by slice.
    """
    names = docs.columns
    at = names.index(text_col) if text_col in names else [c.lower() for c in names].index(text_col.lower())

    def run(batches):
        for batch in batches:
            row, *more = batch.columns
            for a, b, marks in keep(row.flatten()[at], *more):
                yield pa.RecordBatch.from_arrays([row.slice(a, b - a).filter(pa.array(marks, pa.bool_()))], names=["row"])

    rows = docs.select(F.struct("*").alias("row"), *(c.alias(f"given_{i}") for i, c in enumerate(given)))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"]])).select("row.*")
