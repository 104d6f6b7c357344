"""Copy, apply, ledger and verification operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.inputs import (BASE_SQL, FINAL_NEVER_SQL, FINAL_SAFE_SQL, KEYS, LEDGER_SQL, TABLES, base, changes_sql,
                           ledger_log, row_changes, table, union_sql)
from checks.registry import check
from checks.scans import source
from ferrylog.operators import copying, numbering, verify
from ferrylog.operators.fold import apply_changes, match_before_image
from ferrylog.operators.numbering import number_rows
from ferrylog.session import materialize, scratch_path
from ferrylog.sinks import ledger, tables as sink
from ferrylog.sinks.applied import AppliedTable
from ferrylog.sources.tables import column_catalog

ORDERS_ALL = "SELECT * FROM orders"


# --- projections, resume, bad rows ------------------------------------------

@check("p1_project_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p1(spark, sf):
    names = [r.column_name for r in column_catalog(source(spark, sf)).where("table_name = 'customer'").orderBy("ordinal").collect()]
    return copying.project_columns(table(spark, sf, "customer"), names)


@check("p2_resume_filter", "SELECT * FROM orders WHERE o_orderkey > 7321")
def p2(spark, sf):
    return copying.resume_filter(table(spark, sf, "orders"), "o_orderkey", 7321)


@check("p2_resume_filter_no_bound", ORDERS_ALL)
def p2_none(spark, sf):
    return copying.resume_filter(table(spark, sf, "orders"), "o_orderkey", None)


@check("p2_resume_after_composite", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  WHERE l_orderkey > 7000 OR (l_orderkey = 7000 AND l_linenumber > 2)""")
def p2_composite(spark, sf):
    return copying.resume_after(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [7000, 2]).select(
        "l_orderkey", "l_linenumber", "l_partkey")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_BAD_ROWS_SQL = f"""WITH src AS (SELECT CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
  stored AS (SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber FROM orders WHERE o_custkey % 3 = 0),
  tagged AS (SELECT src.*, CASE WHEN src.l_orderkey IS NULL THEN 'null key' WHEN stored.l_orderkey IS NOT NULL THEN 'key exists' END AS reason
    FROM src LEFT JOIN stored USING (l_orderkey, l_linenumber)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, reason
    ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM tagged)"""


def _bad_rows(spark, sf):
    src = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    stored = table(spark, sf, "orders").where("o_custkey % 3 = 0").selectExpr("o_orderkey AS l_orderkey", "1 AS l_linenumber")
    return copying.split_bad_rows(src, ["l_orderkey", "l_linenumber"], stored)


@check("p16_split_bad_rows_good", f"{_BAD_ROWS_SQL} SELECT {_LINE} FROM ranked WHERE reason IS NULL AND rn = 1")
def p16(spark, sf):
    return _bad_rows(spark, sf)[0]


@check("p16_split_bad_rows_quarantine", f"""{_BAD_ROWS_SQL} SELECT {_LINE}, coalesce(reason, 'duplicate key') AS reason, count(*) AS copies
  FROM ranked WHERE reason IS NOT NULL OR rn > 1 GROUP BY ALL""")
def p16_quarantine(spark, sf):
    return _bad_rows(spark, sf)[1]


@check("p17_append_new_rows", "SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_custkey < o_orderkey // 20)")
def p17(spark, sf):
    orders = table(spark, sf, "orders")
    return copying.append_new_rows(orders, orders.where("o_orderdate < '1997-01-01' AND o_custkey < o_orderkey div 20"), "o_orderkey")


# --- batches ----------------------------------------------------------------

_BATCHES = "batches AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS row_no, (row_number() OVER (ORDER BY o_orderkey) - 1) // 700 AS batch_no FROM orders)"
_TRAIL = f"{_BATCHES}, trail AS (SELECT batch_no, count(*) AS batch_rows, max(row_no) AS migrated_rows, max(o_orderkey) AS last_migrated_id FROM batches GROUP BY 1)"


def _batches(spark, sf, columns="*"):
    """Numbering writes its rows once, so callers pass the columns they need."""
    return numbering.assign_batches(table(spark, sf, "orders").select(columns), "o_orderkey", 700)


@check("w2_assign_batches", f"WITH {_BATCHES} SELECT * FROM batches")
def w2(spark, sf):
    return _batches(spark, sf)


@check("w3_progress_trail", f"WITH {_TRAIL} SELECT batch_no, batch_rows, cast(sum(batch_rows) OVER (ORDER BY batch_no) AS BIGINT) AS migrated_rows, last_migrated_id FROM trail")
def w3(spark, sf):
    return numbering.progress_trail(_batches(spark, sf, "o_orderkey"), "o_orderkey")


@check("w7_progress_milestones", f"WITH {_TRAIL} SELECT * FROM trail WHERE migrated_rows % 1000 = 0 OR migrated_rows = (SELECT count(*) FROM orders)")
def w7(spark, sf):
    orders = table(spark, sf, "orders")
    return numbering.progress_milestones(numbering.progress_trail(_batches(spark, sf, "o_orderkey"), "o_orderkey"),
                                         orders.agg(F.count(F.lit(1))).scalar(), numbering.LEDGER_STEP)


# --- apply ------------------------------------------------------------------

@check("t4_fold_changes", FINAL_SAFE_SQL)
def t4(spark, sf):
    return apply_changes(base(spark, sf), row_changes(spark, sf), ["k"])


@check("t4_fold_changes_never_null", FINAL_NEVER_SQL)
def t4_never(spark, sf):
    return apply_changes(base(spark, sf), row_changes(spark, sf), ["k"], "never")


@check("t4_fold_changes_hot_keys", FINAL_SAFE_SQL)
def t4_hot(spark, sf):
    """The same log, with every key of more than two changes folded in pieces."""
    return apply_changes(base(spark, sf), row_changes(spark, sf), ["k"], hot_limit=2)


# Every third event updates key 0, always from the value the one before it set; every
# tenth of those also carries a stale image. All other events insert a key of their own.
_HOT = """SELECT 'f' AS file, event_id AS pos, 0 AS row_no, CASE WHEN event_id % 3 > 0 OR event_id = 0 THEN 'INSERT' ELSE 'UPDATE' END AS op,
  CASE WHEN event_id % 3 = 0 AND event_id > 0 THEN named_struct('k', 0L, 'v', event_id - 3) END AS before,
  named_struct('k', CASE WHEN event_id % 3 = 0 THEN 0L ELSE event_id END, 'v', event_id) AS after FROM {e}
UNION ALL SELECT 'f', event_id, 1, 'UPDATE', named_struct('k', 0L, 'v', -1L), named_struct('k', 0L, 'v', -2L) FROM {e} WHERE event_id % 30 = 0"""


@check("t4_fold_changes_one_hot_key", """SELECT event_id AS k, event_id AS v FROM events WHERE event_id % 3 > 0
  UNION ALL SELECT 0, max(event_id) FROM events WHERE event_id % 3 = 0""")
def t4_one_hot(spark, sf):
    e = table(spark, sf, "events")
    stored = e.selectExpr("event_id AS k", "event_id AS v").limit(0)
    return apply_changes(stored, spark.sql(_HOT, e=e), ["k"], hot_limit=500)


# Without a key every INSERT adds a row, also where the key is there already.
_BAG_SQL = f"""WITH {BASE_SQL}
SELECT k, CASE WHEN k % 10 = 0 THEN 'F' WHEN k % 5 = 0 THEN 'P' ELSE status END AS status,
  CASE WHEN k % 10 = 0 THEN price + 2 WHEN k % 5 = 0 THEN price + 1 ELSE price END AS price, note
FROM base WHERE k % 7 <> 0
UNION ALL SELECT k + 1000000, 'N', price, note FROM base WHERE k % 11 = 0
UNION ALL SELECT k, 'D', CAST(0 AS DOUBLE), note FROM base WHERE k % 13 = 0"""


@check("t4_fold_changes_no_key", _BAG_SQL)
def t4_bag(spark, sf):
    return apply_changes(base(spark, sf), row_changes(spark, sf))


# Each pair of keys moves to one new key, some of them back again: a move lands only
# where the new key is free, so the second of a pair depends on the first.
_MOVES = """SELECT file, pos, row_no, 'UPDATE' AS op, named_struct('k', kb, 'v', vb) AS before, named_struct('k', ka, 'v', va) AS after
FROM (SELECT 'f' AS file, o_orderkey * 10 AS pos, 0 AS row_no, o_orderkey AS kb, o_orderpriority AS vb,
        cast(o_orderkey div 2 + 2000000 AS bigint) AS ka, 'moved' AS va FROM {o}
      UNION ALL SELECT 'f', o_orderkey * 10 + 5, 0, cast(o_orderkey div 2 + 2000000 AS bigint), 'moved', o_orderkey, 'back' FROM {o} WHERE o_orderkey % 3 = 0)"""
_MOVES_SQL = """WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS v FROM orders),
  -- Pairs (2n, 2n + 1) share the new key n + 2000000; a move back follows its own move.
  e AS (SELECT k, v, k // 2 AS n, k % 2 = 0 AS even, k % 3 = 0 AS back, (k - 1) % 3 = 0 AS twin_back FROM o)
  SELECT CASE WHEN even AND NOT back THEN n + 2000000 WHEN even THEN k
              WHEN NOT even AND twin_back AND NOT back THEN n + 2000000 ELSE k END AS k,
         CASE WHEN even AND NOT back THEN 'moved' WHEN even THEN 'back'
              WHEN twin_back AND back THEN 'back' WHEN twin_back THEN 'moved' ELSE v END AS v FROM e"""


@check("t4_fold_changes_moved_keys", _MOVES_SQL)
def t4_moves(spark, sf):
    orders = table(spark, sf, "orders")
    return apply_changes(orders.selectExpr("o_orderkey AS k", "o_orderpriority AS v"), spark.sql(_MOVES, o=orders), ["k"])


_IMAGES = f"""WITH {changes_sql()}, images AS (SELECT b_k, b_status, b_price, b_note FROM row_changes WHERE op <> 'INSERT'),
  target AS (SELECT * FROM base UNION ALL SELECT * FROM base)"""


def _images(spark, sf):
    b = base(spark, sf)
    return b.unionByName(b), row_changes(spark, sf).where("op <> 'INSERT'").select("before.*")


@check("j3_match_before_image", f"""{_IMAGES} SELECT * FROM target WHERE EXISTS (SELECT 1 FROM images
  WHERE b_k = k AND b_status = status AND b_price = price AND b_note IS NOT DISTINCT FROM note)""")
def j3(spark, sf):
    return match_before_image(*_images(spark, sf))


@check("j3_match_before_image_never_null", f"""{_IMAGES} SELECT * FROM target WHERE EXISTS (SELECT 1 FROM images
  WHERE b_k = k AND b_status = status AND b_price = price AND b_note = note)""")
def j3_never(spark, sf):
    return match_before_image(*_images(spark, sf), "never")


@check("k4_apply_changes", FINAL_SAFE_SQL)
def k4(spark, sf):
    """Through the bucketed table, half of the log at a time and the first half twice."""
    applied = AppliedTable(spark, scratch_path(spark, "applied"), ["k"], buckets=8)
    applied.create(base(spark, sf))
    changes = row_changes(spark, sf)
    first, second = changes.where("file <= 'binlog.000012'"), changes.where("file > 'binlog.000012'")
    for part, name in ((first, "a"), (first, "a"), (second, "b")):
        applied.apply(part, name)
    return applied.read()


@check("k4_apply_many_batches", FINAL_SAFE_SQL)
def k4_many(spark, sf):
    """The log in a batch per hundredth of its events up to the tenth, then the rest: runs are merged, and folded in on reading."""
    applied = AppliedTable(spark, scratch_path(spark, "applied"), ["k"], buckets=8)
    applied.create(base(spark, sf))
    log = materialize(number_rows(row_changes(spark, sf), ["file", "pos", "row_no"], "n"), "log")
    most = log.count()
    cuts = [most * i // 100 for i in range(11)] + [most]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        applied.apply(log.where(F.col("n").between(a + 1, b)).drop("n"), f"s-{i}")
    return applied.read()


def _cast_keys(images, kind):
    """The images with keys of another type than the stored table's."""
    cast = lambda image: F.when(F.col(image).isNotNull(), F.col(image).withField("k", F.col(image)["k"].cast(kind)))
    return images.withColumns({"before": cast("before"), "after": cast("after")})


def _applied_with(spark, sf, kind):
    applied = AppliedTable(spark, scratch_path(spark, "applied"), ["k"], buckets=64)
    applied.create(base(spark, sf))
    changes = _cast_keys(row_changes(spark, sf), kind)
    for name, part in (("a", changes.where("file <= 'binlog.000012'")), ("b", changes.where("file > 'binlog.000012'"))):
        applied.apply(part, name)
    return applied.read()


@check("k4_apply_changes_int_keys", FINAL_SAFE_SQL)
def k4_int(spark, sf):
    return _applied_with(spark, sf, "int")


@check("k4_apply_changes_text_keys", FINAL_SAFE_SQL)
def k4_text(spark, sf):
    return _applied_with(spark, sf, "string")


# --- targets and outcomes ---------------------------------------------------

@check("k1_write_table", ORDERS_ALL)
def k1(spark, sf):
    path = scratch_path(spark, "k1")
    sink.write_table(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@check("k2_create_target", union_sql("SELECT '{t}' AS table_name, true AS created, cast(NULL AS VARCHAR) AS error, count(*) AS columns FROM (DESCRIBE {t})"))
def k2(spark, sf):
    folder = scratch_path(spark, "db")
    database = "ferry_" + folder[-8:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    columns = column_catalog(source(spark, sf))
    sink.create_target(spark, columns, database, drop=True)
    status = sink.create_target(spark, columns, database, drop=True)
    made = [(t.name, len(spark.table(f"{database}.{t.name}").columns)) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return status.join(spark.createDataFrame(made, "table_name string, columns bigint"), "table_name", "left")


# A MySQL description of the orders table: type, NULL allowed, default, counter.
_MYSQL_ORDERS = [("o_orderkey", "int(11) unsigned", False, None, True), ("o_custkey", "bigint(20)", False, None, False),
                 ("o_orderstatus", "varchar(12)", True, "it's \\new", False), ("o_totalprice", "decimal(15,2)", True, "-1.50", False),
                 ("o_orderdate", "datetime(6)", True, "1999-12-31 23:59:59", False), ("checked", "tinyint(1)", False, "1", False),
                 ("o_orderpriority", "enum('a','b')", True, None, False), ("rank", "mediumint unsigned", False, "7", False)]


@check("k2_create_target_mysql_types", """SELECT o_orderkey, o_custkey, true AS checked, 7 AS rank,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'it''s \\new' END AS o_orderstatus,
  cast(CASE WHEN o_orderkey % 3 = 0 THEN cast(o_totalprice AS DECIMAL(15,2)) ELSE -1.50 END AS DECIMAL(15,2)) AS o_totalprice,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate ELSE TIMESTAMP '1999-12-31 23:59:59' END AS o_orderdate,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def k2_mysql(spark, sf):
    """Orders inserted into a table made from a MySQL description; columns that are left out get their defaults."""
    folder = scratch_path(spark, "db")
    database = "ferry_" + folder[-8:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    columns = spark.createDataFrame(
        [("orders", i, name, kind, nullable, default, counted, counted) for i, (name, kind, nullable, default, counted) in enumerate(_MYSQL_ORDERS, 1)],
        "table_name string, ordinal int, column_name string, data_type string, nullable boolean, default_value string, is_auto_increment boolean, is_primary_key boolean")
    status = sink.create_target(spark, columns, database, drop=True, types="mysql").first()
    assert status.created, status.error
    orders, into = table(spark, sf, "orders"), f"INSERT INTO {database}.orders"
    spark.sql(f"{into} (o_orderkey, o_custkey) SELECT o_orderkey, o_custkey FROM {{o}} WHERE o_orderkey % 3 <> 0", o=orders)
    spark.sql(f"""{into} (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
        SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(15,2)), o_orderdate, o_orderpriority FROM {{o}} WHERE o_orderkey % 3 = 0""", o=orders)
    return spark.table(f"{database}.orders")


@check("a2_copy_outcome", """SELECT l_shipmode AS table_name, count(*) FILTER (WHERE result >= 0) AS success, count(*) FILTER (WHERE result < 0) AS failure
  FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, l_linenumber - 3 AS result FROM lineitem) GROUP BY ROLLUP (1)""")
def a2(spark, sf):
    return sink.copy_outcome(table(spark, sf, "lineitem").selectExpr("concat(l_returnflag, l_linestatus) AS table_name", "l_linenumber - 3 AS result"))


# --- ledger -----------------------------------------------------------------

_COLS = "table_name, total_rows, migrated_rows, last_migrated_id, status"


def current(spark, sf):
    return ledger.current_progress(ledger_log(spark, sf))


def _written(spark, sf):
    """``(path, state)`` of a ledger that is written as jobs do: rows, newer rows, deletions."""
    path, log = scratch_path(spark, "ledger"), ledger_log(spark, sf)
    first = log.groupBy("table_name").agg(F.min_by(F.struct(*log.columns), "version").alias("r")).select("r.*")
    last = ledger.latest_per_key(log, "table_name")
    ledger.append_progress(first, path)
    ledger.append_progress(last.where("NOT deleted"), path)
    ledger.delete_progress(last.where("deleted"), path)
    return path, ledger.read_progress(spark, path)


@check("k5_append_progress", f"WITH {LEDGER_SQL} SELECT {_COLS}, error_message FROM ledger")
def k5(spark, sf):
    """First versions, then the last ones, through the sink; the last ones count."""
    return _written(spark, sf)[1].select(*_COLS.split(", "), "error_message")


@check("w8_latest_per_key", f"WITH {LEDGER_SQL} SELECT table_name, version, status FROM latest")
def w8(spark, sf):
    return ledger.latest_per_key(ledger_log(spark, sf), "table_name").select("table_name", "version", "status")


@check("k8_clear_progress", f"WITH {LEDGER_SQL} SELECT {_COLS} FROM ledger WHERE table_name <> 't77'")
def k8(spark, sf):
    path, _ = _written(spark, sf)
    ledger.clear_progress(spark, path, "t77")
    return ledger.read_progress(spark, path).select(*_COLS.split(", "))


@check("k8_clear_progress_all", f"WITH {LEDGER_SQL} SELECT count(*) - count(*) AS rows_left, count(*) AS cleared FROM ledger")
def k8_all(spark, sf):
    path, before = _written(spark, sf)
    before = materialize(before, "before")
    ledger.clear_progress(spark, path)
    left = ledger.read_progress(spark, path).agg(F.count(F.lit(1))).scalar()
    return before.agg(F.count(F.lit(1)).alias("cleared")).withColumn("rows_left", left)


@check("a3_progress_summary", f"""WITH {LEDGER_SQL} SELECT count(*) AS tables, count(*) FILTER (WHERE status = 'COMPLETED') AS completed,
  count(*) FILTER (WHERE status = 'IN_PROGRESS') AS in_progress, count(*) FILTER (WHERE status = 'FAILED') AS failed, count(*) FILTER (WHERE status = 'PENDING') AS pending FROM ledger""")
def a3(spark, sf):
    return ledger.progress_summary(current(spark, sf))


@check("a3_progress_report", f"""WITH {LEDGER_SQL} SELECT table_name, status, migrated_rows, total_rows,
  CASE WHEN total_rows = 0 THEN 0.0::DOUBLE ELSE migrated_rows::DOUBLE / total_rows::DOUBLE * 100.0::DOUBLE END AS progress_pct FROM ledger""")
def a3_report(spark, sf):
    return ledger.progress_report(current(spark, sf))


@check("p11_incomplete_tables", f"WITH {LEDGER_SQL} SELECT {_COLS} FROM ledger WHERE status IN ('PENDING', 'IN_PROGRESS', 'FAILED')")
def p11(spark, sf):
    return ledger.incomplete_tables(current(spark, sf)).select(*_COLS.split(", "))


@check("o3_order_ledger", f"WITH {LEDGER_SQL} SELECT {_COLS} FROM ledger ORDER BY table_name")
def o3(spark, sf):
    return ledger.order_ledger(current(spark, sf)).select(*_COLS.split(", "))


@check("j5_plan_copy", f"""WITH {LEDGER_SQL}, t AS (SELECT 't' || cast(c_custkey AS VARCHAR) AS table_name, c_custkey * 10 AS row_count FROM customer),
  d AS (SELECT t.*, ledger.* EXCLUDE (table_name), CASE WHEN status IS NULL THEN 'new' WHEN status = 'COMPLETED' THEN 'restart' ELSE 'resume' END AS decision
        FROM t LEFT JOIN ledger USING (table_name))
  SELECT table_name, decision, CASE WHEN decision = 'resume' THEN total_rows ELSE row_count END AS total_rows,
    CASE WHEN decision = 'resume' THEN migrated_rows ELSE 0 END AS migrated_rows,
    CASE WHEN decision = 'resume' THEN last_migrated_id WHEN decision = 'restart' THEN 0 END AS last_migrated_id,
    CASE WHEN decision = 'resume' THEN 'IN_PROGRESS' ELSE 'PENDING' END AS status FROM d""")
def j5(spark, sf):
    t = table(spark, sf, "customer").selectExpr("concat('t', c_custkey) AS table_name", "c_custkey * 10 AS row_count")
    return copying.plan_copy(t, current(spark, sf))


# --- verification -----------------------------------------------------------

COPY_SQL = """copied AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 101 = 0)"""


def copied_orders(spark, sf):
    o = table(spark, sf, "orders")
    kept = o.where("o_orderkey % 97 <> 0").withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"))
    return o, kept.unionByName(o.where("o_orderkey % 101 = 0").withColumn("o_orderkey", F.expr("o_orderkey + 1000000")))


_DIFF_SQL = f"""WITH {COPY_SQL} SELECT o_orderkey, CASE WHEN c.o_custkey IS NULL THEN 'missing' WHEN o.o_custkey IS NULL THEN 'extra' ELSE 'changed' END AS state,
  CASE WHEN o.o_custkey IS NULL THEN 0 ELSE 1 END::BIGINT AS left_rows, CASE WHEN c.o_custkey IS NULL THEN 0 ELSE 1 END::BIGINT AS right_rows
  FROM orders o FULL JOIN copied c USING (o_orderkey) WHERE c.o_totalprice IS DISTINCT FROM o.o_totalprice"""


@check("j7_diff_tables", _DIFF_SQL)
def j7(spark, sf):
    return verify.diff_tables(*copied_orders(spark, sf), ["o_orderkey"])


@check("j7_diff_by_digest", _DIFF_SQL)
def j7_digest(spark, sf):
    """Through fingerprints of key ranges: rows in ranges that agree are not shuffled."""
    return verify.diff_by_digest(*copied_orders(spark, sf), ["o_orderkey"])


@check("a8_table_checksum", union_sql("SELECT '{t}' AS table_name, count(*) AS row_count, true AS same FROM {t}"))
def a8(spark, sf):
    """Fingerprint of each table against that of the same rows in another order and layout."""
    sides = []
    for t in TABLES:
        df = table(spark, sf, t)
        dealt = df.repartition(max(5, 2 * df.rdd.getNumPartitions()))  # as many more as the table is larger
        sides += [verify.table_checksum(x).withColumn("table_name", F.lit(t)) for x in (df, dealt)]
    return reduce(DataFrame.unionByName, sides).groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        ((F.min("row_count") == F.max("row_count")) & (F.min("hash_xor") == F.max("hash_xor"))
         & (F.min("hash_sum") == F.max("hash_sum"))).alias("same"))
