"""Event filters, context, counts and positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import FEED_SQL, changes_sql, feed, mapped_sql, row_changes, table
from checks.registry import check
from ferrylog.functions.position import Position, start_from
from ferrylog.operators import events as ev
from ferrylog.operators.numbering import checkpoint_marks
from ferrylog.session import materialize, scratch_path
from ferrylog.sinks.ledger import read_checkpoints, save_checkpoints
from ferrylog.sources.exports import dedup_entries, drop_processed, union_entries, order_files

# Small chunks, so that the carry over chunks is exercised on the small tables too.
CHUNK = 700


def mapped(spark, sf):
    out = ev.resolve_table_map(ev.fill_gtid(feed(spark, sf), chunk=CHUNK), ("map_database", "map_table"), chunk=CHUNK)
    return (ev.classify_events(out).withColumnsRenamed({"map_database": "database", "map_table": "table"}))


def _named(spark, sf):
    """Feed with odd names: empty and NULL databases and tables, and upper case."""
    return feed(spark, sf).selectExpr(
        "seq", "CASE seq % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN upper(map_database) ELSE map_database END AS database",
        "CASE seq % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE map_table END AS table")


_NAMED_SQL = f"""WITH {FEED_SQL}, named AS (SELECT seq,
  CASE seq % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN upper(map_database) ELSE map_database END AS "database",
  CASE seq % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE map_table END AS "table" FROM feed)"""


@check("p4_filter_databases", f"""{_NAMED_SQL} SELECT * FROM named WHERE "database" IN ('db0', 'db2')""")
def p4(spark, sf):
    return ev.filter_databases(_named(spark, sf), ["db0", "db2"])


@check("p4_filter_databases_all", f"""{_NAMED_SQL} SELECT * FROM named WHERE coalesce("database", '') <> ''""")
def p4_all(spark, sf):
    return ev.filter_databases(_named(spark, sf))


_P5_SQL = f"""{_NAMED_SQL} SELECT * FROM named WHERE coalesce("database", '') <> '' AND
  ("table" IN ('t3', 't7') OR "database" || '.' || "table" IN ('db1.t4', 'db2.t5'))"""


@check("p5_filter_tables", _P5_SQL)
def p5(spark, sf):
    return ev.filter_tables(_named(spark, sf), None, ["t3", "t7", "db1.t4", "db2.t5"])


@check("p5_filter_tables_long_list", _P5_SQL)
def p5_long(spark, sf):
    return ev.filter_tables(_named(spark, sf), None, ["t3", "t7", "db1.t4", "db2.t5"] + [f"x{i}" for i in range(1500)])


@check("p6_classify_events", f"""WITH {FEED_SQL} SELECT seq, CASE WHEN event_type = 'QUERY' THEN 'DDL' ELSE 'DML' END AS event_class,
  CASE event_type WHEN 'EXT_WRITE_ROWS' THEN 'INSERT' WHEN 'EXT_UPDATE_ROWS' THEN 'UPDATE' WHEN 'EXT_DELETE_ROWS' THEN 'DELETE' END AS op
  FROM feed WHERE event_type NOT IN ('TABLE_MAP', 'GTID')""")
def p6(spark, sf):
    return ev.classify_events(feed(spark, sf)).select("seq", "event_class", "op")


_DDL = """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN concat('  begin', chr(10)) WHEN 1 THEN 'COMMIT' WHEN 2 THEN concat(' ', chr(9))
  WHEN 3 THEN concat('DROP TABLE my_mysql.t', cast(o_custkey AS string)) WHEN 4 THEN concat('ALTER TABLE performance_schema.', o_orderpriority)
  WHEN 5 THEN 'Rollback' WHEN 6 THEN 'ROLLBACK TO x' WHEN 7 THEN NULL ELSE concat('CREATE TABLE t', cast(o_orderkey AS string), ' (mysql int)') END AS ddl_sql FROM {orders}"""


@check("p7_skip_ddl", f"SELECT * FROM ({_DDL.format(orders='orders')}) WHERE o_orderkey % 9 IN (6, 8)")
def p7(spark, sf):
    return ev.skip_ddl(spark.sql(_DDL.format(orders="{o}"), o=table(spark, sf, "orders")))


@check("p15_valid_rows", "SELECT o_orderkey, cast(o_orderkey % 3 AS INTEGER) AS n FROM orders WHERE o_orderkey % 3 > 0")
def p15(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE slice(array(o_custkey, o_orderkey), 1, cast(o_orderkey % 3 AS int)) END AS rows")
    return ev.valid_rows(rows).select("o_orderkey", F.size("rows").alias("n"))


@check("w1_fill_gtid", f"WITH {mapped_sql()} SELECT seq, event_type, gtid FROM carried")
def w1(spark, sf):
    return ev.fill_gtid(feed(spark, sf), chunk=CHUNK).select("seq", "event_type", "gtid")


@check("j2_resolve_table_map", f"""WITH {mapped_sql()} SELECT seq, event_type, table_id, "database", "table" FROM mapped""")
def j2(spark, sf):
    return mapped(spark, sf).select("seq", "event_type", "table_id", "database", "table")


@check("a4_change_counts", f"""WITH {mapped_sql()} SELECT "database", "table", op, count(*) AS changes FROM mapped GROUP BY ALL""")
def a4(spark, sf):
    return ev.change_counts(mapped(spark, sf))


@check("a6_last_position", f"WITH {mapped_sql()} SELECT file, pos, gtid FROM carried ORDER BY file DESC, pos DESC LIMIT 1")
def a6(spark, sf):
    return ev.last_position(ev.fill_gtid(feed(spark, sf), chunk=CHUNK))


@check("o1_order_by_position", f"WITH {changes_sql()} SELECT file, pos, gtid, row_number() OVER (ORDER BY file, pos) AS place FROM row_changes")
def o1(spark, sf):
    """The place of a row is where the operator put it: in partition order, then within."""
    from ferrylog.operators.numbering import number_rows
    ordered = ev.order_by_position(row_changes(spark, sf).select("file", "pos", "gtid", "row_no"), "row_no")
    placed = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    return number_rows(placed, "at", "place").drop("row_no", "at")


@check("t6_start_from", f"WITH {FEED_SQL} SELECT seq, file, pos FROM feed WHERE file > 'binlog.000013' OR (file = 'binlog.000013' AND pos >= 150004)")
def t6(spark, sf):
    return start_from(feed(spark, sf), Position("binlog.000013", 150004)).select("seq", "file", "pos")


@check("w6_checkpoint_marks", f"""WITH {changes_sql()}, n AS (SELECT file, pos, gtid, row_number() OVER (ORDER BY file, pos) AS executed FROM row_changes)
  SELECT * FROM n WHERE executed % 100 = 0 OR executed = (SELECT max(executed) FROM n)""")
def w6(spark, sf):
    return checkpoint_marks(row_changes(spark, sf).select("file", "pos", "gtid"), ("file", "pos"))


def _entries(spark, sf):
    return feed(spark, sf).selectExpr("concat('f', seq % 3) AS source_file", "seq AS entry_no", "file", "pos - pos % 1000 AS pos",
                                      "concat(event_type, table_id) AS sql", "concat_ws(':', file, pos - pos % 1000, event_type, table_id) AS entry_id")


_ENTRIES_SQL = f"""WITH {FEED_SQL}, entries AS (SELECT 'f' || cast(seq % 3 AS VARCHAR) AS source_file, seq AS entry_no, file, pos - pos % 1000 AS pos,
  event_type || cast(table_id AS VARCHAR) AS sql, file || ':' || cast(pos - pos % 1000 AS VARCHAR) || ':' || event_type || ':' || cast(table_id AS VARCHAR) AS entry_id FROM feed)"""


@check("u1_union_entries", f"{_ENTRIES_SQL} SELECT source_file, entry_no, file, pos, sql, entry_id FROM entries UNION ALL SELECT 'again', entry_no, file, pos, sql, entry_id FROM entries")
def u1(spark, sf):
    e = _entries(spark, sf)
    return union_entries(e, e.withColumn("source_file", F.lit("again")))


@check("u2_dedup_entries", f"{_ENTRIES_SQL} SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY file, pos, source_file, entry_no) = 1")
def u2(spark, sf):
    return dedup_entries(_entries(spark, sf))


@check("j4_drop_processed", f"{_ENTRIES_SQL} SELECT * FROM entries WHERE entry_id NOT IN (SELECT entry_id FROM entries WHERE sql LIKE 'QUERY%' OR sql LIKE 'GTID%')")
def j4(spark, sf):
    e = _entries(spark, sf)
    return drop_processed(e, e.where("sql LIKE 'QUERY%' OR sql LIKE 'GTID%'"))


@check("o2_order_files", f"{_ENTRIES_SQL} SELECT source_file, count(*) AS entries FROM entries GROUP BY source_file ORDER BY source_file")
def o2(spark, sf):
    return order_files(_entries(spark, sf).groupBy("source_file").agg(F.count(F.lit(1)).alias("entries")))


_CHECKPOINT_LOG = """SELECT concat('s', cast(event_id % 7 AS string)) AS stream_id, concat('binlog.', lpad(cast(user_id % 20 AS string), 6, '0')) AS file,
  event_id * 13 % 9973 * 100000 + event_id AS pos, concat('u:', cast(event_id AS string)) AS gtid, event_id AS version FROM {events}"""


@check("k6_save_checkpoint", f"""SELECT stream_id, file, pos, gtid FROM ({_CHECKPOINT_LOG.format(events='events')})
  QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY file DESC, pos DESC) = 1""")
def k6(spark, sf):
    """All positions of the log are saved; what the checkpoint table then holds."""
    log, path = spark.sql(_CHECKPOINT_LOG.format(events="{e}"), e=table(spark, sf, "events")), scratch_path(spark, "checkpoints")
    save_checkpoints(spark, path, log)
    return read_checkpoints(spark, path)
