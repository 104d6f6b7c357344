"""Change-event operators: class, include lists, transaction and table context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ferrylog.functions.ddl import is_skipped_ddl
from ferrylog.operators.carry import CHUNK, carry_forward
from ferrylog.schema import DELETE, INSERT, UPDATE

# Event types that carry DDL or row changes.
DDL_TYPES = ["QUERY"]
ROW_TYPES = {
    INSERT: ["WRITE_ROWS", "EXT_WRITE_ROWS"],
    UPDATE: ["UPDATE_ROWS", "EXT_UPDATE_ROWS"],
    DELETE: ["DELETE_ROWS", "EXT_DELETE_ROWS"],
}

# Include lists longer than this go through a semi join instead of IN.
_INLINE_NAMES = 1000


def row_operation(event_type="event_type") -> Column:
    kind, out = F.col(event_type), F.lit(None).cast("string")
    for op, types in ROW_TYPES.items():
        out = F.when(kind.isin(types), F.lit(op)).otherwise(out)
    return out


def classify_events(events: DataFrame) -> DataFrame:
    """Add ``event_class`` (DDL or DML) and ``op``; other events are dropped."""
    op = row_operation()
    cls = F.when(F.col("event_type").isin(DDL_TYPES), F.lit("DDL")).when(op.isNotNull(), F.lit("DML"))
    return (events.where(cls.isNotNull())
                  .withColumn("event_class", cls).withColumn("op", op))


def _named(c) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def filter_databases(events: DataFrame, databases=None) -> DataFrame:
    """Named databases only; an empty include list means all of them."""
    kept = events.where(_named("database"))
    names = list(databases or [])
    return kept.where(F.col("database").isin(names)) if names else kept


def filter_tables(events: DataFrame, databases=None, tables=None) -> DataFrame:
    """Named tables, listed bare or as ``database.table``, in included databases."""
    kept = filter_databases(events, databases).where(_named("table"))
    names = list(tables or [])
    if not names:
        return kept
    full = F.concat_ws(".", "database", "table")
    if len(names) <= _INLINE_NAMES:
        return kept.where(full.isin(names) | F.col("table").isin(names))
    listed = kept.sparkSession.createDataFrame([(n,) for n in names], "name string").distinct()
    by_table = kept.join(listed, kept["table"] == listed["name"], "left_semi")
    rest = kept.join(listed, kept["table"] == listed["name"], "left_anti")
    return by_table.unionByName(rest.join(listed, full == listed["name"], "left_semi"))


def skip_ddl(events: DataFrame, sql="ddl_sql") -> DataFrame:
    return events.where(~is_skipped_ddl(sql))


def valid_rows(events: DataFrame, rows="rows") -> DataFrame:
    """Row events without rows produce nothing and are no error."""
    return events.where(F.coalesce(F.size(rows), F.lit(0)) > 0)


def fill_gtid(events: DataFrame, seq="seq", chunk=CHUNK) -> DataFrame:
    """Each event takes the transaction id of the latest GTID event."""
    own = F.when(F.col("event_type") == "GTID", F.col("gtid"))
    return (carry_forward(events.withColumn("__gtid", own), "__gtid", seq, chunk=chunk,
                          out="__carried")
            .withColumn("gtid", F.col("__carried")).drop("__gtid", "__carried"))


def resolve_table_map(events: DataFrame, context=("map_database", "map_table"),
                      seq="seq", chunk=CHUNK) -> DataFrame:
    """As-of lookup: a row event takes the table context of the latest map event
    with its table id. Events before any map are dropped, map events consumed. Other
    events leave before anything is shuffled.
    """
    events = events.where(row_operation().isNotNull() | (F.col("event_type") == "TABLE_MAP"))
    own = F.when(F.col("event_type") == "TABLE_MAP", F.struct(*context))
    mapped = carry_forward(events.withColumn("__map", own), "__map", seq, ["table_id"],
                           out="__at", chunk=chunk)
    kept = mapped.where(row_operation().isNotNull() & F.col("__at").isNotNull())
    for name in context:
        kept = kept.withColumn(name, F.col("__at").getField(name))
    return kept.drop("__map", "__at")


def explode_rows(events: DataFrame) -> DataFrame:
    """One row per changed row, numbered inside its event."""
    return (valid_rows(events)
            .select("*", F.posexplode("rows").alias("row_no", "__row"))
            .withColumns({"before": F.col("__row.before"), "after": F.col("__row.after")})
            .drop("rows", "__row"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("database", "table", "op").agg(F.count(F.lit(1)).alias("changes"))


def last_position(entries: DataFrame) -> DataFrame:
    """The greatest (file, pos) and its transaction id: one row."""
    at = F.struct("file", "pos")
    return (entries.agg(F.max_by(F.struct("file", "pos", "gtid"), at).alias("p"))
                   .select("p.*"))


def order_by_position(entries: DataFrame, tie="entry_no") -> DataFrame:
    return entries.orderBy("file", "pos", tie)
