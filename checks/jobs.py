"""Export files, streams, handlers and whole jobs."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from checks.inputs import (FEED_SQL, FINAL_SAFE_SQL, KEYS, LOGS_SQL, TABLES, TASKS_SQL, base, changes_sql,
                           entries_sql, feed, mapped_sql, money_base, money_changes, row_changes,
                           table, task_logs, tasks, union_sql)
from checks.copying import COPY_SQL, copied_orders
from checks.registry import check
from checks.scans import GENERATED, STAMP, exported, source
from checks.taskviews import _PAYLOAD
from ferrylog.functions.position import Position, entry_id
from ferrylog.operators.fold import apply_changes
from ferrylog.operators.numbering import number_rows, roll_files
from ferrylog.operators.statements import parse_statements
from ferrylog.operators.verify import diff_tables
from ferrylog.plans.capture import capture_and_apply, capture_to_files, incremental_replay
from ferrylog.plans.copy import CopyConfig, FolderTarget, copy_new_rows, full_copy
from ferrylog.plans.dashboard import task_dashboard
from ferrylog.plans.verify import differing_rows, verify_copy
from ferrylog.session import materialize, scratch_path
from ferrylog.sinks.applied import AppliedTable
from ferrylog.sinks.exports import entry_text, export_stats, render_changes
from ferrylog.sinks.ledger import read_checkpoint, read_progress
from ferrylog.sources.changes import read_change_events
from ferrylog.sources.exports import read_sql_export
from ferrylog.sources.tables import DirectorySource
from ferrylog.streaming.capture import CallbackListener, Capture, Handler, Handlers, capture
from ferrylog.streaming.handlers import apply_handler, audit_handler, default_handlers, export_handler, retry_failed
from ferrylog.streaming.watch import Replay, bounded_run, dedup_by_frontier, stream_dedup, watch_exports

# Prices travel through statements as decimals.
FINAL_MONEY_SQL = f"SELECT k, status, cast(price AS DECIMAL(18,2)) AS price, note FROM ({FINAL_SAFE_SQL})"
_NUMBERED = f"{entries_sql()}, n AS (SELECT *, row_number() OVER (ORDER BY file, pos) AS i FROM entries)"


def _schema(spark, sf):
    return money_base(spark, sf).schema


# --- export -----------------------------------------------------------------

@check("k3_export_sql", f"WITH {_NUMBERED} SELECT (i - 1) // 1000 + 1 AS file_no, printf('binlog_sql_{STAMP}_%04d.sql', cast((i - 1) // 1000 + 1 AS INTEGER)) AS file_name, count(*) AS statements FROM n GROUP BY ALL")
def k3(spark, sf):
    return exported(spark, sf, 1000)[1]


@check("k3_export_text", f"""WITH {_NUMBERED}, f AS (SELECT printf('binlog_sql_{STAMP}_%04d.sql', cast((i - 1) // 1000 + 1 AS INTEGER)) AS source_file, i,
    '[POSITION] ' || file || ':' || cast(pos AS VARCHAR) || chr(10) || '[GTID] ' || gtid || chr(10) || sql || chr(10) || chr(10) AS entry FROM n)
  SELECT source_file, sha256('-- Binlog SQL Export' || chr(10) || '-- Generated at: {GENERATED}' || chr(10) || '-- File: ' || source_file || chr(10) ||
    '-- Format: [POSITION] filename:position, [GTID] gtid_value, SQL statement' || chr(10) || chr(10) || string_agg(entry, '' ORDER BY i)) AS digest FROM f GROUP BY source_file""")
def k3_text(spark, sf):
    """Whole file texts, byte for byte."""
    from ferrylog.sources.exports import read_export_files
    folder, _ = exported(spark, sf, 1000)
    return read_export_files(spark, folder).select("source_file", F.sha2("text", 256).alias("digest"))


@check("w4_roll_files", f"WITH {changes_sql()} SELECT file, pos, row_number() OVER (ORDER BY file, pos) AS statement_no, (row_number() OVER (ORDER BY file, pos) - 1) // 2500 + 1 AS file_no FROM row_changes")
def w4(spark, sf):
    return roll_files(row_changes(spark, sf).select("file", "pos"), ("file", "pos"), 2500)


@check("a5_export_stats", f"WITH {changes_sql()}, n AS (SELECT (row_number() OVER (ORDER BY file, pos) - 1) // 2500 + 1 AS file_no FROM row_changes), c AS (SELECT file_no, count(*) AS s FROM n GROUP BY 1) SELECT file_no, cast(sum(s) AS BIGINT) AS statements, count(*) AS files FROM c GROUP BY ROLLUP (file_no)")
def a5(spark, sf):
    return export_stats(roll_files(row_changes(spark, sf).select("file", "pos"), ("file", "pos"), 2500))


# Texts with quotes, backslashes and line breaks, written as statements and read back.
@check("e2_statement_round_trip", "SELECT doc_id, text, lang, source, n_chars, cast(NULL AS VARCHAR) AS error FROM documents")
def e2_round_trip(spark, sf):
    docs = table(spark, sf, "documents")
    changes = docs.select(F.lit("f").alias("file"), F.col("doc_id").alias("pos"), F.lit(0).alias("row_no"), F.lit("u:1").alias("gtid"),
                          F.lit("db").alias("database"), F.lit("docs").alias("table"), F.lit("INSERT").alias("op"),
                          F.lit(None).cast(docs.schema.simpleString()).alias("before"), F.struct(*docs.columns).alias("after"))
    folder, _ = exported(spark, sf, 300, changes)
    return parse_statements(read_sql_export(spark, folder), docs.schema).select("after.*", "error")


@check("e2_capture_to_files", f"WITH {entries_sql()} SELECT * FROM entries WHERE file >= 'binlog.000013'")
def e2(spark, sf):
    folder = scratch_path(spark, "export")
    changes = money_changes(spark, sf)
    capture_to_files(changes, _schema(spark, sf), folder, STAMP, GENERATED, ["shop"], ["shop.orders"], Position("binlog.000013", 0))
    return read_sql_export(spark, folder).select("file", "pos", "gtid", "sql")


# --- replay -----------------------------------------------------------------

@check("e3_incremental_replay", FINAL_MONEY_SQL)
def e3(spark, sf):
    folder, _ = exported(spark, sf, 1000)
    return incremental_replay(spark, folder, money_base(spark, sf), ["k"], "shop.orders")[0]


@check("e4_capture_and_apply", FINAL_SAFE_SQL)
def e4(spark, sf):
    return capture_and_apply(row_changes(spark, sf), base(spark, sf), ["k"], ["shop"], ["orders"])


def _replay(spark, sf, folder, applied, home):
    job = Replay(spark, applied, _schema(spark, sf), "orders", f"{home}/checkpoints", f"{home}/rejected", "shop.orders")
    return watch_exports(spark, folder, job, f"{home}/state", interval=None)


def _replayed(spark, sf):
    """Two drains of one folder with a restart between them."""
    home = scratch_path(spark, "replay")
    applied = AppliedTable(spark, f"{home}/table", ["k"], buckets=4)
    applied.create(money_base(spark, sf))
    changes = money_changes(spark, sf)
    for stamp, part in (("a", changes.where("file <= 'binlog.000013'")), ("b", changes.where("file > 'binlog.000013'"))):
        capture_to_files(part, _schema(spark, sf), f"{home}/export", stamp, GENERATED)
        bounded_run(_replay(spark, sf, f"{home}/export", applied, home))
    return home, applied


@check("t2_replay", FINAL_MONEY_SQL)
def t2(spark, sf):
    return _replayed(spark, sf)[1].read()


def _grow(spark, source, folder, share):
    """``folder`` as a writer would have left it: a share of the files of ``source``, the last of them in part."""
    from pyarrow import fs as arrow_fs

    def copy(batches):
        store, root = arrow_fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for path, size, part in zip(batch["path"], batch["length"], batch["part"]):
                name = path.rpartition("/")[2]
                with store.open_input_file(f"{source.removeprefix('file://')}/{name}") as old, store.open_output_stream(f"{root}/{name}") as new:
                    for at in range(0, int(size * part), 1 << 20):
                        new.write(old.read(min(1 << 20, int(size * part) - at)))
            yield batch

    listed = spark.read.format("binaryFile").load(source).select("path", "length")
    files = listed.count()
    listed = number_rows(listed, ["path"], "n").withColumn("part", F.least(F.lit(1.0), F.lit(float(share * files)) - F.col("n") + 1)).where("part > 0")
    # A number of parts of its own: by their size alone the few listed rows would all be one task's.
    listed.repartition(max(spark.sparkContext.defaultParallelism, files // 16), "path").mapInPandas(copy, listed.schema).write.format("noop").mode("overwrite").save()


@check("t1_growing_exports", FINAL_MONEY_SQL)
def t1_growing(spark, sf):
    """The folder grows twice between drains; cuts fall anywhere in a file."""
    home = scratch_path(spark, "growing")
    applied = AppliedTable(spark, f"{home}/table", ["k"], buckets=4)
    applied.create(money_base(spark, sf))
    capture_to_files(money_changes(spark, sf), _schema(spark, sf), f"{home}/export", "a", GENERATED)
    job = Replay(spark, applied, _schema(spark, sf), "orders", f"{home}/checkpoints", f"{home}/rejected", "shop.orders")
    for share in (0.4, 0.75, 1):
        _grow(spark, f"{home}/export", f"{home}/grown", share)
        bounded_run(watch_exports(spark, f"{home}/grown", job, f"{home}/state", interval=None, range_bytes=1 << 16))
    return applied.read()


@check("t1_watch_exports", f"WITH {changes_sql()} SELECT file, pos, gtid FROM row_changes ORDER BY file DESC, pos DESC LIMIT 1")
def t1(spark, sf):
    """Position reached by the watch; what it did to the table is t2."""
    home, _ = _replayed(spark, sf)
    return spark.createDataFrame([read_checkpoint(spark, f"{home}/checkpoints", "orders")], "file string, pos bigint, gtid string")


@check("t3_stream_dedup", """SELECT DISTINCT event_type || ':' || cast(user_id AS VARCHAR) AS entry_id FROM events""")
def t3(spark, sf):
    e = table(spark, sf, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{sf}/events.parquet*").selectExpr("concat(event_type, ':', user_id) AS entry_id")
    out = scratch_path(spark, "dedup")
    query = (stream_dedup(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)


def _repeated_entries(spark, sf, batches=4, files=4):
    """Entries in log order, a part of the log in each micro-batch: all of them twice, and those of the part before again."""
    path = scratch_path(spark, "entries")
    log = number_rows(row_changes(spark, sf).select("file", "pos", "row_no"), ["file", "pos", "row_no"], "n")
    log = materialize(log.withColumn("entry_id", F.concat_ws(":", "file", "pos", "row_no")), "entries")
    size = -(-log.count() // batches)
    for i in range(batches):
        own, before = (log.where(F.ceil(F.col("n") / F.lit(size)) == k) for k in (i + 1, i))
        own.union(own).union(before).drop("n").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(log.drop("n").schema).option("maxFilesPerTrigger", files).parquet(path)


@check("t3_dedup_by_frontier", f"WITH {changes_sql()} SELECT file, pos, row_no FROM row_changes")
def t3_frontier(spark, sf):
    """Entries that come again, in the same batch or the next one; the state holds the last batch only."""
    out = scratch_path(spark, "dedup")
    query = (dedup_by_frontier(_repeated_entries(spark, sf)).select("file", "pos", "row_no").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)


def _feed_stream(spark, sf, files=3):
    """The feed as change-event files, written in log order and read as a stream one by one."""
    path = scratch_path(spark, "feed")
    f = feed(spark, sf).withColumnsRenamed({"map_database": "database", "map_table": "table", "props": "ddl_sql"})
    f = f.withColumns({"database": F.expr("CASE WHEN event_type IN ('TABLE_MAP', 'QUERY') THEN database END"),
                       "table": F.expr("CASE WHEN event_type = 'TABLE_MAP' THEN table END"),
                       "ddl_sql": F.expr("CASE WHEN event_type = 'QUERY' THEN concat('ALTER TABLE x ', ddl_sql) END")})
    size = f.agg(F.max("seq")).first()[0] // files + 1
    for i in range(files):
        f.where(F.col("seq").between(i * size, (i + 1) * size - 1)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _captured(spark, sf):
    home, out = scratch_path(spark, "capture"), scratch_path(spark, "captured")

    def save(name):
        return lambda df, i: df.write.mode("overwrite").parquet(f"{out}/{name}/batch={i}")

    def broken(df, i):
        raise ValueError("a handler that always fails")

    handlers = Handlers([Handler("broken", F.lit(True), broken),
                         Handler("rows", F.col("event_class") == "DML", save("rows")),
                         Handler("audit", F.col("event_class") == "DDL", save("audit"))])
    query = capture(_feed_stream(spark, sf), Capture(f"{home}/context", handlers, ["db0", "db2"]), f"{home}/state", interval=None)
    bounded_run(query)
    return out, handlers


@check("t5_capture", f"""WITH {mapped_sql()} SELECT seq, op, "database", "table", gtid FROM mapped WHERE "database" IN ('db0', 'db2')""")
def t5(spark, sf):
    out, _ = _captured(spark, sf)
    return spark.read.parquet(f"{out}/rows").select("seq", "op", "database", "table", "gtid")


@check("x1_register_handler", f"""WITH {FEED_SQL} SELECT seq, 'ALTER TABLE x ' || props AS ddl_sql FROM feed WHERE event_type = 'QUERY' AND map_database IN ('db0', 'db2')""")
def x1(spark, sf):
    """The audit handler's output; a failing handler ran before it in every batch."""
    out, handlers = _captured(spark, sf)
    assert handlers.errors and all(name == "broken" for _, name, _ in handlers.errors)
    return spark.read.parquet(f"{out}/audit").select("seq", "ddl_sql")


@check("x2_register_listener", """SELECT 'connect' AS callback, CAST(0 AS BIGINT) AS input_rows
  UNION ALL SELECT 'disconnect', 0 UNION ALL SELECT 'event', count(*) FROM events""")
def x2(spark, sf):
    """Rows read, as a listener's callbacks saw them."""
    seen = []
    listener = CallbackListener(on_connect=lambda e: seen.append(("connect", 0)),
                                on_event=lambda p: seen.append(("event", p.numInputRows)),
                                on_disconnect=lambda e: seen.append(("disconnect", 0)))
    spark.streams.addListener(listener)
    try:
        query = (_feed_stream(spark, sf).writeStream.format("noop")
                 .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start())
        query.awaitTermination()
        for _ in range(100):  # callbacks arrive on their own thread
            if any(kind == "disconnect" for kind, _ in seen):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    rows = sum(n for kind, n in seen if kind == "event")
    return spark.createDataFrame([(kind, rows if kind == "event" else 0) for kind in sorted({k for k, _ in seen})],
                                 "callback string, input_rows bigint")


@check("t7_bounded_run", f"WITH {FEED_SQL} SELECT event_type, count(*) AS events, false AS ended FROM feed GROUP BY event_type")
def t7(spark, sf):
    """A watch that never ends by itself is stopped when its time is up."""
    home = scratch_path(spark, "bounded")
    query = (_feed_stream(spark, sf).writeStream.format("parquet").option("path", f"{home}/out")
             .option("checkpointLocation", f"{home}/state").trigger(processingTime="1 second").start())
    query.processAllAvailable()
    ended = bounded_run(query, 1)
    return spark.read.parquet(f"{home}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).withColumn("ended", F.lit(ended))


# --- whole jobs -------------------------------------------------------------

def _copy(spark, sf, **switches):
    home = scratch_path(spark, "copy")
    target = FolderTarget(spark, f"{home}/target")
    cfg = CopyConfig(f"{home}/ledger", f"{home}/checkpoints", continue_on_error=True, ranges=2, **switches)
    result = full_copy(spark, source(spark, sf), target, cfg, Position("binlog.000012", 4))
    return home, target, result


@check("e1_full_copy", union_sql("SELECT '{t}' AS table_name, count(*) AS copied, 0::BIGINT AS refused, cast(NULL AS VARCHAR) AS error, 'COMPLETED' AS status, count(*) AS total_rows, count(*) AS migrated_rows FROM {t}"))
def e1(spark, sf):
    home, _, result = _copy(spark, sf)
    ledger = read_progress(spark, f"{home}/ledger").select("table_name", "status", "total_rows", "migrated_rows")
    return result.join(ledger, "table_name", "left")


@check("e1_full_copy_rows", "SELECT * FROM lineitem")
def e1_rows(spark, sf):
    return _copy(spark, sf, included_tables=["lineitem"])[1].read("lineitem")


@check("e1_full_copy_keyed_rows", "SELECT * FROM orders")
def e1_keyed_rows(spark, sf):
    return _copy(spark, sf, included_tables=["orders"])[1].read("orders")


@check("e5_task_dashboard", f"""WITH {TASKS_SQL}, {LOGS_SQL}, page AS (SELECT id, status, {_PAYLOAD} AS payload FROM tasks WHERE NOT is_deleted ORDER BY created_at DESC, id LIMIT 10)
  SELECT p.*, level, message, l.created_at AS logged_at FROM page p LEFT JOIN task_logs l ON p.id = l.task_id""")
def e5(spark, sf):
    return task_dashboard(tasks(spark, sf), task_logs(spark, sf), 1, 10)


@check("e6_verify_copy", union_sql("SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS same FROM {t}"))
def e6(spark, sf):
    s = source(spark, sf)
    _, target, _ = _copy(spark, sf)
    return verify_copy(s, target, s.table_names())


@check("e6_differing_rows", f"""WITH {COPY_SQL} SELECT 'orders' AS table_name, '{{"o_orderkey":' || o_orderkey || '}}' AS key,
  CASE WHEN c.o_custkey IS NULL THEN 'missing' WHEN o.o_custkey IS NULL THEN 'extra' ELSE 'changed' END AS state,
  CASE WHEN o.o_custkey IS NULL THEN 0 ELSE 1 END::BIGINT AS left_rows, CASE WHEN c.o_custkey IS NULL THEN 0 ELSE 1 END::BIGINT AS right_rows
  FROM orders o FULL JOIN copied c USING (o_orderkey) WHERE c.o_totalprice IS DISTINCT FROM o.o_totalprice""")
def e6_rows(spark, sf):
    """Counts and fingerprints first, then the rows of the one table that differs."""
    s, target = source(spark, sf), FolderTarget(spark, f"{scratch_path(spark, 'copy')}/target")
    target.write(copied_orders(spark, sf)[1], "orders", 1000)
    target.write(s.read("customer"), "customer", 1000)
    return differing_rows(s, target, verify_copy(s, target, ["orders", "customer"]), KEYS)


@check("e1_copy_new_rows", "SELECT * FROM orders")
def e1_new(spark, sf):
    """Two rounds of a periodic copy onto a target that has a part of the rows."""
    s, target = source(spark, sf), FolderTarget(spark, f"{scratch_path(spark, 'copy')}/target")
    orders = s.read("orders")
    target.write(orders.where(F.col("o_orderkey") <= orders.agg(F.expr("median(o_orderkey)")).scalar()), "orders", 1000)
    for _ in range(2):
        copy_new_rows(spark, s, target, {"orders": "o_orderkey"})
    return target.read("orders")


@check("e1_full_copy_signed_keys", "SELECT o_orderkey - (SELECT max(o_orderkey) // 2 FROM orders) AS k FROM orders")
def e1_signed(spark, sf):
    """Keys on both sides of 0 in several ranges, one of whose bounds may be 0."""
    home = scratch_path(spark, "copy")
    orders = table(spark, sf, "orders")
    half = orders.agg(F.expr("max(o_orderkey) div 2")).first()[0]
    orders.select((F.col("o_orderkey") - F.lit(half)).alias("k")).write.parquet(f"{home}/source/signed.parquet")
    target = FolderTarget(spark, f"{home}/target")
    full_copy(spark, DirectorySource(spark, f"{home}/source", keys={"signed": ["k"]}), target, CopyConfig(f"{home}/ledger", ranges=2))
    return target.read("signed")


# Keys of text in falling order, a whole number and a number, some of them NULL, some repeated.
_LINES = """SELECT CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag || l_linestatus END AS flag, l_orderkey AS k,
  l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, l_shipdate AS shipped FROM {lineitem}"""


class _StopsOnce(FolderTarget):
    """A target that goes away at its third write."""
    writes = 0

    def write(self, df, table, batch_size, mode="append"):
        self.writes += 1
        if self.writes == 3:
            raise OSError("target went away")
        super().write(df, table, batch_size, mode)


@check("e1_full_copy_composite_keys", f"""WITH lines AS ({_LINES.format(lineitem='lineitem')}),
  g AS (SELECT flag, k, line, part, supp, shipped, count(*) AS n FROM lines GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY flag, k, line ORDER BY part, supp, shipped) AS i FROM g WHERE flag IS NOT NULL)
  SELECT flag, k, line, part, supp, shipped, 1::BIGINT AS copies, NULL::VARCHAR AS reason FROM r WHERE i = 1
  UNION ALL SELECT flag, k, line, part, supp, shipped, n, 'null key' FROM g WHERE flag IS NULL
  UNION ALL SELECT flag, k, line, part, supp, shipped, CASE WHEN i = 1 THEN n - 1 ELSE n END, 'duplicate key' FROM r WHERE i > 1 OR n > 1""")
def e1_composite(spark, sf):
    """A copy that stops inside the table and goes on: rows that arrived, and rows that were refused."""
    home = scratch_path(spark, "copy")
    spark.sql(_LINES.format(lineitem="{l}"), l=table(spark, sf, "lineitem")).write.parquet(f"{home}/source/lines.parquet")
    lines = DirectorySource(spark, f"{home}/source", keys={"lines": ["flag", "k", "line"]})
    cfg = CopyConfig(f"{home}/ledger", ranges=6, continue_on_error=True, quarantine_path=f"{home}/refused",
                     descending_keys={"lines": ["flag"]})
    target = _StopsOnce(spark, f"{home}/target")
    stopped = full_copy(spark, lines, target, cfg).first()
    assert stopped.error is not None and read_progress(spark, cfg.ledger_path).first().last_migrated_key
    full_copy(spark, lines, target, cfg)
    refused = spark.read.parquet(f"{home}/refused/lines").drop("range_id")
    return (target.read("lines").withColumns({"copies": F.lit(1).cast("bigint"), "reason": F.lit(None).cast("string")})
            .unionByName(refused))


# --- capture with the built-in handlers ---------------------------------------

def _change_feed(spark, sf):
    """The row changes as a stream of events whose rows are maps of text, every one behind its table map.

    Each half of the log is a micro-batch of several files.
    """
    text = lambda image: F.when(F.col(image).isNotNull(), F.map_from_arrays(
        F.array(*[F.lit(c) for c in ("k", "status", "price", "note")]), F.array(*[F.col(image)[c].cast("string") for c in ("k", "status", "price", "note")])))
    log = number_rows(row_changes(spark, sf), ["file", "pos", "row_no"], "n")
    kind = F.create_map(*[F.lit(x) for x in ("INSERT", "EXT_WRITE_ROWS", "UPDATE", "EXT_UPDATE_ROWS", "DELETE", "EXT_DELETE_ROWS")])
    rows = log.select((F.col("n") + 1).alias("seq"), kind[F.col("op")].alias("event_type"), "file", "pos", "gtid",
                      F.lit(None).cast("bigint").alias("ts_ms"), F.lit(None).cast("string").alias("database"), F.lit(None).cast("string").alias("table"),
                      F.lit(7).cast("bigint").alias("table_id"), F.lit(None).cast("string").alias("op"), F.lit(None).cast("string").alias("ddl_sql"),
                      F.array(F.struct(text("before").alias("before"), text("after").alias("after"))).alias("rows"))
    first = spark.sql("""SELECT 1L AS seq, 'TABLE_MAP' AS event_type, 'binlog.000000' AS file, 4L AS pos, cast(NULL AS string) AS gtid, cast(NULL AS bigint) AS ts_ms,
      'shop' AS database, 'orders' AS table, 7L AS table_id, cast(NULL AS string) AS op, cast(NULL AS string) AS ddl_sql,
      cast(NULL AS array<struct<before:map<string,string>,after:map<string,string>>>) AS rows""")
    feed = materialize(first.unionByName(rows), "feed")
    path, most = scratch_path(spark, "feed"), log.count() + 1
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for a, b in ((0, most // 2), (most // 2, most)):
        # Files are read by their age, so the first half's must fill its micro-batch and the second's may not be more.
        half = feed.where(F.col("seq").between(a + 1, b)).repartitionByRange(files, "seq").coalesce(files)
        half.write.mode("append").parquet(path)
        files = files if a else len(spark.read.parquet(path).inputFiles())
    return read_change_events(spark, path, stream=True, maxFilesPerTrigger=files)


def _drained(spark, sf, handlers):
    """The feed through ``handlers``. One that failed has left its output in part, so that is no result."""
    home = scratch_path(spark, "capture")
    bounded_run(capture(_change_feed(spark, sf), Capture(f"{home}/context", handlers, ["shop"]), f"{home}/state", interval=None))
    if handlers.errors:
        raise RuntimeError("; ".join(f"handler {name} failed in batch {batch}: {error}" for batch, name, error in handlers.errors))


@check("e4_stream_capture_and_apply", FINAL_SAFE_SQL)
def e4_stream(spark, sf):
    """The feed through the default handlers onto a table, in two micro-batches."""
    applied = AppliedTable(spark, scratch_path(spark, "applied"), ["k"], buckets=4)
    applied.create(base(spark, sf))
    schema = base(spark, sf).schema
    _drained(spark, sf, default_handlers(audit=audit_handler(scratch_path(spark, "audit")), apply=apply_handler(applied, schema, "s", "shop.orders")))
    return applied.read()


@check("e2_stream_capture_to_files", f"WITH {changes_sql()} SELECT file, pos FROM row_changes")
def e2_stream(spark, sf):
    """The feed through the export handler; what the files hold."""
    folder = scratch_path(spark, "export")
    _drained(spark, sf, default_handlers(export=export_handler(folder, base(spark, sf).schema, GENERATED, "shop.orders", 1000)))
    return read_sql_export(spark, folder).select("file", "pos")


@check("x1_default_handlers", f"""WITH {changes_sql()}, final AS ({FINAL_SAFE_SQL})
  SELECT 'export' AS choice, 'entries' AS what, count(*) AS rows FROM row_changes
  UNION ALL SELECT 'both', 'table', count(*) FROM final UNION ALL SELECT 'both', 'audit', 0""")
def x1_default(spark, sf):
    """What the default handlers leave: files if there is an export handler, else the table and the audit."""
    home, schema = scratch_path(spark, "defaults"), base(spark, sf).schema
    applied = AppliedTable(spark, f"{home}/table", ["k"], buckets=4)
    applied.create(base(spark, sf))
    export, audit = export_handler(f"{home}/export", schema, GENERATED, "shop.orders"), audit_handler(f"{home}/audit")
    apply = apply_handler(applied, schema, "s", "shop.orders")
    for handlers in (default_handlers(export, audit, apply), default_handlers(audit=audit, apply=apply)):
        _drained(spark, sf, handlers)
    counts = [("export", "entries", read_sql_export(spark, f"{home}/export")), ("both", "table", applied.read()),
              ("both", "audit", spark.read.parquet(f"{home}/audit"))]
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(choice).alias("choice"), F.lit(what).alias("what"), "rows") for choice, what, df in counts]
    return parts[0].union(parts[1]).union(parts[2])


@check("x1_retry_in_order", FINAL_SAFE_SQL)
def x1_retry(spark, sf):
    """The target is away in the first of two micro-batches: the second one waits, and both are applied in order later."""
    home = scratch_path(spark, "retried")
    applied = AppliedTable(spark, f"{home}/table", ["k"], buckets=4)
    applied.create(base(spark, sf))
    inner, away = apply_handler(applied, base(spark, sf).schema, "s", "shop.orders"), [True]

    def handle(events, batch_id):
        if away[0]:
            raise OSError("target went away")
        inner.handle(events, batch_id)

    seen = Handler("seen", inner.supports, lambda events, batch_id: events.write.parquet(f"{home}/seen/batch={batch_id}"))
    own = Handlers([inner._replace(handle=handle), seen], f"{home}/failed")

    def recovered(events, batch_id):
        own.run(events, batch_id)
        away[0] = False  # back at once, but the first batch has still to come before the second

    _drained(spark, sf, Handlers([Handler("all", F.lit(True), recovered)]))
    assert [(b, n) for b, n, _ in own.failed(spark)] == [(0, "apply"), (1, "apply")] and retry_failed(spark, own)
    assert spark.read.parquet(f"{home}/seen").select("batch").distinct().count() == 2
    return applied.read()
