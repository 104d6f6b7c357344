"""The built-in handlers of a capture, and which of them run.

Captured events carry rows as maps of text; each handler turns those of its table into
typed changes first. A micro-batch that runs again replaces its own output.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, functions as F, types as T

from ferrylog.operators.events import explode_rows
from ferrylog.plans.capture import capture_to_files
from ferrylog.sinks.applied import AppliedTable
from ferrylog.streaming.capture import Handler, Handlers


def typed_image(image, schema: T.StructType):
    """A map of text as a row of the table; names that the map lacks, and texts that are no such value, are NULL."""
    image = F.col(image)
    return F.when(image.isNotNull(), F.struct(
        *[F.try_element_at(image, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema]))


def _misfits(image, schema: T.StructType):
    """Names of the columns whose text is no value of their type."""
    image = F.col(image)
    texts = [(f.name, F.try_element_at(image, F.lit(f.name)), f.dataType) for f in schema]
    return F.array_compact(F.array(*[F.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(name)) for name, text, kind in texts]))


def _changes(events: DataFrame, schema: T.StructType, table: Optional[str]) -> DataFrame:
    own = events.where("event_class = 'DML'")
    if table is not None:
        own = own.where(F.concat_ws(".", "database", "table") == table)
    none = F.array().cast("array<string>")
    return explode_rows(own).withColumn("misfits", F.array_distinct(F.concat(
        F.coalesce(_misfits("before", schema), none), F.coalesce(_misfits("after", schema), none))))


def typed_changes(events: DataFrame, schema: T.StructType, table: Optional[str] = None) -> DataFrame:
    """Row changes of one table from captured events; ``table`` is ``database.table``.

    A change with a text that is no value of its column's type is left to ``bad_changes``.
    """
    good = _changes(events, schema, table).where(F.size("misfits") == 0).drop("misfits")
    return good.withColumns({"before": typed_image("before", schema), "after": typed_image("after", schema)})


def bad_changes(events: DataFrame, schema: T.StructType, table: Optional[str] = None) -> DataFrame:
    """Changes that have no typed form, their images as text, with the reason."""
    bad = _changes(events, schema, table).where(F.size("misfits") > 0)
    return bad.withColumn("error", F.concat(F.lit("no value of its type: "), F.array_join("misfits", ", "))).drop("misfits")


def _accepted(events, schema, table, rejected_path, batch_id) -> DataFrame:
    """Typed changes; the others go to quarantine, or fail the batch where there is none."""
    bad = bad_changes(events, schema, table)
    if rejected_path is not None:
        bad.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
    else:
        first = bad.select("error").first()
        if first is not None:
            raise ValueError(first.error)
    return typed_changes(events, schema, table)


def export_handler(folder: str, schema: T.StructType, generated: str, table: Optional[str] = None, size=10000,
                   rejected_path: Optional[str] = None) -> Handler:
    """Rolling statement files, named after the micro-batch."""

    def handle(events: DataFrame, batch_id: int):
        capture_to_files(_accepted(events, schema, table, rejected_path, batch_id), schema, folder, f"batch{batch_id:09d}", generated, size=size)

    return Handler("export", F.col("event_class") == "DML", handle)


def audit_handler(path: str) -> Handler:
    """The DDL that passed, one folder per micro-batch."""

    def handle(events: DataFrame, batch_id: int):
        events.select("seq", "file", "pos", "gtid", "database", "ddl_sql").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return Handler("audit", F.col("event_class") == "DDL", handle)


def apply_handler(table: AppliedTable, schema: T.StructType, stream_id: str, name: Optional[str] = None,
                  rejected_path: Optional[str] = None) -> Handler:
    """Changes straight to an applied table; a batch that was applied is not applied again.

    Changes with a bad value go to ``rejected_path``; without it they fail their batch.
    """

    def handle(events: DataFrame, batch_id: int):
        table.apply(_accepted(events, schema, name, rejected_path, batch_id), f"{stream_id}-{batch_id}")

    return Handler("apply", F.col("event_class") == "DML", handle)


def default_handlers(export: Optional[Handler] = None, audit: Optional[Handler] = None,
                     apply: Optional[Handler] = None, failed_path: Optional[str] = None) -> Handlers:
    """With an export handler only that one; else the DDL audit and direct apply."""
    chosen = [export] if export is not None else [h for h in (audit, apply) if h is not None]
    return Handlers(chosen, failed_path)


def retry_failed(spark, handlers: Handlers) -> bool:
    """Work off what handlers have missed, each in the order of the batches; True if nothing waits any more."""
    return handlers.recover(spark)
