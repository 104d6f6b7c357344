"""Positional values to named values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ferrylog.functions.text import col


def row_names(values, names) -> Column:
    """One name per value: the known name, else ``column_<i>`` from zero."""
    values, names = col(values), F.coalesce(col(names), F.array().cast("array<string>"))
    return F.transform(values, lambda _, i: F.coalesce(
        F.get(names, i), F.concat(F.lit("column_"), i.cast("string"))))


def row_to_map(values, names) -> Column:
    """Zip values with names by ordinal; names beyond the values are ignored."""
    return F.map_from_arrays(row_names(values, names), col(values))
