"""Registry of checked queries: a Spark callable and, where SQL can say it, a twin."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict = {}


def check(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add
