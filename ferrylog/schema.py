"""Shapes of the tables the library exchanges."""

from __future__ import annotations

from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()
_IMAGE = T.MapType(T.StringType(), T.StringType())


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


COLUMN_CATALOG = _struct(
    ("table_name", _S), ("ordinal", T.IntegerType()), ("column_name", _S),
    ("data_type", _S), ("nullable", _B), ("default_value", _S),
    ("is_auto_increment", _B),
)
PRIMARY_KEYS = _struct(("table_name", _S), ("column_name", _S))

CHANGE_EVENTS = _struct(
    ("seq", _L), ("event_type", _S), ("file", _S), ("pos", _L), ("gtid", _S),
    ("ts_ms", _L), ("database", _S), ("table", _S), ("table_id", _L), ("op", _S),
    ("ddl_sql", _S), ("rows", T.ArrayType(_struct(("before", _IMAGE), ("after", _IMAGE)))),
)
SQL_ENTRIES = _struct(
    ("source_file", _S), ("entry_no", _L), ("file", _S), ("pos", _L), ("gtid", _S), ("sql", _S),
)
PROGRESS_LOG = _struct(
    ("table_name", _S), ("total_rows", _L), ("migrated_rows", _L), ("last_migrated_id", _L),
    ("status", _S), ("start_time", _TS), ("last_update_time", _TS), ("complete_time", _TS),
    ("error_message", _S), ("deleted", _B), ("version", _L), ("last_migrated_key", _S),
)
CHECKPOINTS = _struct(
    ("stream_id", _S), ("file", _S), ("pos", _L), ("gtid", _S), ("ts_ms", _L), ("version", _L),
)
TASKS = _struct(
    ("id", _S), ("name", _S), ("source_connection", _S), ("target_connection", _S),
    ("status", _S), ("progress", T.IntegerType()), ("created_at", _TS), ("updated_at", _TS),
    ("completed_at", _TS), ("error_message", _S), ("is_billing", _B), ("is_deleted", _B),
    ("version", _L),
)
TASK_LOGS = _struct(
    ("id", _L), ("task_id", _S), ("level", _S), ("message", _S), ("created_at", _TS),
)
