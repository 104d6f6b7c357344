"""Names for helper columns that no column of the input has."""

from __future__ import annotations


def free_name(columns, base: str) -> str:
    """``base`` or a longer name that differs from all ``columns``, whatever their case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base
