"""Sources S1-S11, catalog joins and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import (FEED_SQL, KEYS, LEDGER_SQL, STATEMENT_SQL, TABLES, changes_sql,
                           entries_sql, feed, ledger_log, money_changes, row_changes, table,
                           union_sql)
from checks.registry import check
from ferrylog.functions.ddl import mysql_type_to_spark
from ferrylog.operators import events as ev
from ferrylog.plans.capture import capture_to_files
from ferrylog.schema import PROGRESS_LOG
from ferrylog.session import materialize, scratch_path
from ferrylog.sinks import ledger
from ferrylog.sinks.ledger import append_progress, read_progress, save_checkpoint
from ferrylog.sources import tables as src
from ferrylog.sources.changes import read_change_events, snapshot_position
from ferrylog.sources.exports import carry_headers, entries_of_blocks, read_export_blocks, read_export_files, read_sql_export

STAMP, GENERATED = "20260302_104733", "2026-03-02T10:47:33"


def source(spark, sf):
    return src.DirectorySource(spark, sf, keys=KEYS)


# Column type names of the two engines.
_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE column_type END"""
_COLUMNS_SQL = union_sql(f"SELECT '{{t}}' AS table_name, cast(row_number() OVER () AS INTEGER) AS ordinal, "
                         f"column_name, {_TYPE} AS data_type FROM (DESCRIBE {{t}})")
_KEYS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name" for t, cs in KEYS.items() for c in cs)
_DDL_SQL = f"""SELECT table_name, 'CREATE TABLE `' || table_name || '` (' ||
  string_agg('`' || column_name || '` ' || data_type, ', ' ORDER BY ordinal) || ')' AS create_sql
  FROM columns_ GROUP BY table_name"""


@check("s1_scan_table", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate, l_returnflag FROM lineitem")
def s1(spark, sf):
    return src.scan_table(source(spark, sf), "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag"])


@check("s2_list_tables", f"SELECT DISTINCT table_name FROM ({_COLUMNS_SQL})")
def s2(spark, sf):
    return src.list_tables(source(spark, sf))


@check("s3_column_catalog", _COLUMNS_SQL)
def s3(spark, sf):
    return src.column_catalog(source(spark, sf)).select("table_name", "ordinal", "column_name", "data_type")


# A declared key must be one: no value twice, none missing.
_TRUE_KEYS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name FROM {t} HAVING count(*) = count(DISTINCT {c})" for t, cs in KEYS.items() for c in cs)


@check("s4_primary_keys", _TRUE_KEYS_SQL)
def s4(spark, sf):
    s = source(spark, sf)
    return src.primary_keys(s).join(src.column_catalog(s), ["table_name", "column_name"], "left_semi")


@check("s5_create_ddl", f"WITH columns_ AS ({_COLUMNS_SQL}) {_DDL_SQL}")
def s5(spark, sf):
    return src.create_ddl(src.column_catalog(source(spark, sf)))


@check("s6_describe_source", f"""WITH columns_ AS ({_COLUMNS_SQL}), k AS ({_KEYS_SQL}), d AS ({_DDL_SQL})
  SELECT columns_.*, k.column_name IS NOT NULL AS is_primary_key, create_sql FROM columns_
  LEFT JOIN k USING (table_name, column_name) JOIN d USING (table_name)""")
def s6(spark, sf):
    return src.describe_source(source(spark, sf)).select("table_name", "ordinal", "column_name", "data_type", "is_primary_key", "create_sql")


def _as_events(changes):
    """Typed row changes as heterogeneous change events, one row each."""
    def image(c):
        return F.when(F.col(c).isNotNull(), F.create_map(*[x for n in ("k", "status", "price", "note") for x in (F.lit(n), F.col(f"{c}.{n}").cast("string"))]))
    kind = F.expr("CASE op WHEN 'INSERT' THEN 'EXT_WRITE_ROWS' WHEN 'UPDATE' THEN 'EXT_UPDATE_ROWS' ELSE 'EXT_DELETE_ROWS' END")
    return changes.select(
        F.expr("cast(substr(gtid, 3) as bigint)").alias("seq"), kind.alias("event_type"), "file", "pos", "gtid",
        F.lit(0).cast("long").alias("ts_ms"), "database", "table", F.lit(1).cast("long").alias("table_id"), "op",
        F.lit(None).cast("string").alias("ddl_sql"),
        F.array(F.struct(image("before").alias("before"), image("after").alias("after"))).alias("rows"))


@check("s7_read_change_events", f"""WITH {changes_sql()} SELECT file, pos, gtid, op, cast(0 AS INTEGER) AS row_no,
  coalesce(b_status, 'none') AS old_status, cast(a_k AS VARCHAR) AS new_key, a_note AS new_note FROM row_changes""")
def s7(spark, sf):
    path = scratch_path(spark, "events")
    _as_events(money_changes(spark, sf)).write.parquet(path)
    rows = ev.explode_rows(ev.classify_events(read_change_events(spark, path)))
    return rows.select("file", "pos", "gtid", "op", "row_no",
                       F.coalesce(F.col("before")["status"], F.lit("none")).alias("old_status"),
                       F.col("after")["k"].alias("new_key"), F.col("after")["note"].alias("new_note"))


def exported(spark, sf, size=10000, changes=None):
    folder = scratch_path(spark, "export")
    changes = money_changes(spark, sf) if changes is None else changes
    return folder, capture_to_files(changes, changes.schema["after"].dataType, folder, STAMP, GENERATED, size=size)


@check("s8_read_sql_export", f"WITH {entries_sql()} SELECT * FROM entries")
def s8(spark, sf):
    folder, _ = exported(spark, sf, 1000)
    return read_sql_export(spark, folder).select("file", "pos", "gtid", "sql")


@check("s8_split_export", f"WITH {entries_sql()}, n AS (SELECT *, (row_number() OVER (ORDER BY file, pos) - 1) % 10000 + 1 AS entry_no FROM entries) SELECT * FROM n")
def s8_split(spark, sf):
    """Files in ranges of 64 KB: every entry with its number in the file (0 is the text before the first)."""
    folder, _ = exported(spark, sf)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
    try:
        blocks = read_export_blocks(spark, folder)  # reads and parses the file
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return entries_of_blocks(blocks).where("NOT orphan").select("file", "pos", "gtid", "sql", "entry_no")


@check("s9_stream_sql_export", f"WITH {entries_sql()} SELECT * FROM entries")
def s9(spark, sf):
    folder, _ = exported(spark, sf, 1000)
    out = scratch_path(spark, "streamed")
    files = read_export_files(spark, folder, stream=True)
    query = (files.writeStream.foreachBatch(
        lambda df, i: carry_headers(df).select("file", "pos", "gtid", "sql").write.mode("overwrite").parquet(f"{out}/batch={i}"))
        .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out).select("file", "pos", "gtid", "sql")


@check("s10_snapshot_position", f"""WITH {FEED_SQL} SELECT (SELECT max(file) FROM feed) AS file,
  (SELECT max(pos) FROM feed WHERE file = (SELECT max(file) FROM feed)) AS pos,
  (SELECT arg_max(gtid, seq) FROM feed WHERE gtid IS NOT NULL) AS gtid""")
def s10(spark, sf):
    return snapshot_position(feed(spark, sf))


@check("s11_read_progress", f"WITH {LEDGER_SQL} SELECT table_name, total_rows, migrated_rows, last_migrated_id, status, error_message FROM ledger")
def s11(spark, sf):
    from ferrylog.sinks.ledger import read_progress
    path = scratch_path(spark, "ledger")
    ledger_log(spark, sf).write.parquet(path)
    return read_progress(spark, path).select("table_name", "total_rows", "migrated_rows", "last_migrated_id", "status", "error_message")


@check("s11_read_compacted", f"WITH {LEDGER_SQL} SELECT table_name, total_rows, migrated_rows, last_migrated_id, status, error_message FROM ledger")
def s11_compacted(spark, sf):
    """The ledger's log in eighty writes: a snapshot and a short tail are read."""
    path, log = scratch_path(spark, "ledger"), ledger_log(spark, sf)
    # Any order of the writes gives the same state.
    written = materialize(log.withColumn("part", F.pmod("version", F.lit(80))), "ledger-log")
    for part in range(80):
        ledger._append(written.where(F.col("part") == part).drop("part"), path, PROGRESS_LOG, ledger._latest_progress)
    assert len(ledger._parts(spark, path)[1]) < ledger.TAIL
    return read_progress(spark, path).select("table_name", "total_rows", "migrated_rows", "last_migrated_id", "status", "error_message")


@check("j1_attach_keys", f"""WITH columns_ AS ({_COLUMNS_SQL}), k AS ({_KEYS_SQL})
  SELECT table_name, column_name, ordinal, k.column_name IS NOT NULL AS is_primary_key FROM columns_ LEFT JOIN k USING (table_name, column_name)""")
def j1(spark, sf):
    s = source(spark, sf)
    return src.attach_keys(src.column_catalog(s), src.primary_keys(s)).select("table_name", "column_name", "ordinal", "is_primary_key")


@check("p3_resume_key", f"SELECT table_name, column_name AS resume_key FROM ({_KEYS_SQL})")
def p3(spark, sf):
    s = source(spark, sf)
    return src.resume_key(src.attach_keys(src.column_catalog(s), src.primary_keys(s)))


_COUNTS_SQL = union_sql("SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}")


@check("a1_row_counts", _COUNTS_SQL)
def a1(spark, sf):
    return src.row_counts(source(spark, sf))


@check("p13_table_exists", union_sql("SELECT DISTINCT '{t}' AS table_name, true AS found, false AS like_found FROM (DESCRIBE {t})"))
def p13(spark, sf):
    s = source(spark, sf)
    rows = [(t, src.table_exists(s, t), src.table_exists(s, t[:-1] + "_")) for t in s.table_names()]
    return spark.createDataFrame(rows, "table_name string, found boolean, like_found boolean")


@check("p14_skip_empty_tables", """WITH c AS (SELECT event_type AS table_name, count(*) FILTER (WHERE value > 1000000) AS n1, count(*) AS n2 FROM events GROUP BY 1)
  SELECT table_name, row_count FROM (SELECT table_name || '_all' AS table_name, n2 AS row_count FROM c UNION ALL SELECT table_name || '_none', n1 FROM c) WHERE row_count > 0""")
def p14(spark, sf):
    c = table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 1000000).alias("n1"), F.count(F.lit(1)).alias("n2"))
    both = c.select(F.concat("event_type", F.lit("_all")).alias("table_name"), F.col("n2").alias("row_count")).unionByName(
        c.select(F.concat("event_type", F.lit("_none")).alias("table_name"), F.col("n1").alias("row_count")))
    return src.skip_empty_tables(both)


@check("w5_carry_headers", f"""WITH {entries_sql()}, n AS (SELECT *, row_number() OVER (ORDER BY file, pos) AS i FROM entries)
  SELECT printf('binlog_sql_{STAMP}_%04d.sql', cast((i - 1) // 700 + 1 AS INTEGER)) AS source_file, cast((i - 1) % 700 + 1 AS BIGINT) AS entry_no, file, pos, gtid, sql, false AS orphan FROM n""")
def w5(spark, sf):
    folder, _ = exported(spark, sf, 700)
    return carry_headers(read_export_files(spark, folder))
