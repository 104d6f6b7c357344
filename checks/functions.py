"""Scalar functions F1-F19 and position predicates P8-P10."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import TABLES, quoted_sql, table, TASKS_SQL, tasks
from checks.registry import check
from ferrylog.functions import ddl, position, render, rowmap, status, text
from ferrylog.operators.tasks import task_transition

_DDL = """SELECT o_orderkey, CASE o_orderkey % 4
  WHEN 0 THEN concat('CREATE TABLE `shop`.`t', cast(o_custkey AS string), '` (`id` int, `a` varchar(9)) AUTO_INCREMENT=', cast(o_orderkey AS string), ' X')
  WHEN 1 THEN concat('ALTER TABLE `a`.`b` ADD FOREIGN KEY REFERENCES `c d`.`e` -- auto_increment=', cast(o_orderkey AS string))
  WHEN 2 THEN concat('CREATE VIEW `v', o_orderstatus, '` AS SELECT `x`.`y` FROM `s`.`', o_orderpriority, '`')
  ELSE concat('DROP TABLE t', cast(o_orderkey AS string)) END AS ddl
FROM {orders}"""


def _sql(spark, sf, body, **names):
    return spark.sql(body.format(**{k: "{" + k + "}" for k in names}),
                     **{k: table(spark, sf, v) for k, v in names.items()})


@check("f1_clean_ddl", f"""SELECT o_orderkey,
  regexp_replace(regexp_replace(ddl, '`[^`]+`\\.`', '`', 'g'), 'AUTO_INCREMENT=\\d+', 'AUTO_INCREMENT=1', 'g') AS clean
  FROM ({_DDL.format(orders='orders')})""")
def f1(spark, sf):
    return _sql(spark, sf, _DDL, orders="orders").select("o_orderkey", ddl.clean_ddl("ddl").alias("clean"))


_LITERALS = [("documents", "doc_id", "text"), ("pages", "page_id", "html"),
             ("conversations", "conv_id * 1000 + turn", "text"), ("orders", "o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END")]


@check("f2_sql_literal", " UNION ALL ".join(
    f"SELECT '{t}' AS src, {k} AS id, {quoted_sql(c)} AS literal FROM {t}" for t, k, c in _LITERALS)
    + """ UNION ALL SELECT 'number', l_orderkey, coalesce(cast(CASE WHEN l_partkey % 5 > 0 THEN l_partkey END AS VARCHAR), 'NULL') FROM lineitem
    UNION ALL SELECT 'flag', o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'NULL' WHEN o_custkey % 3 = 1 THEN '1' ELSE '0' END FROM orders
    UNION ALL SELECT 'bytes', o_orderkey, 'X''' || hex(encode(o_orderpriority)) || '''' FROM orders""")
def f2(spark, sf):
    parts = [table(spark, sf, t).selectExpr(f"'{t}' AS src", f"{k} AS id", f"{c} AS v") for t, k, c in _LITERALS]
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    parts += [lines.selectExpr("'number' AS src", "l_orderkey AS id", "CASE WHEN l_partkey % 5 > 0 THEN l_partkey END AS v"),
              orders.selectExpr("'flag' AS src", "o_orderkey AS id", "CASE o_custkey % 3 WHEN 1 THEN true WHEN 2 THEN false END AS v"),
              orders.selectExpr("'bytes' AS src", "o_orderkey AS id", "cast(o_orderpriority AS binary) AS v")]
    out = None
    for p in parts:
        line = p.select("src", "id", render.sql_literal("v", p.schema["v"].dataType).alias("literal"))
        out = line if out is None else out.unionByName(line)
    return out


_DOC = [("doc_id", "cast(doc_id AS VARCHAR)"), ("text", quoted_sql("text")), ("lang", quoted_sql("lang"))]
_DOC_PAIRS = [f"'{n} = ' || {v}" for n, v in _DOC]


def _doc(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text", "lang")
    image = F.struct("doc_id", "text", "lang")
    return df.select("doc_id", F.lit("db.docs").alias("t"), image.alias("i")), df.schema


@check("f3_render_insert", "SELECT doc_id, 'INSERT INTO db.docs (doc_id, text, lang) VALUES (' || "
       + " || ', ' || ".join(v for _, v in _DOC) + " || ')' AS sql FROM documents")
def f3(spark, sf):
    df, schema = _doc(spark, sf)
    return df.select("doc_id", render.render_insert("t", "i", schema).alias("sql"))


@check("f4_render_update", "SELECT page_id, 'UPDATE web.pages SET page_id = ' || cast(page_id AS VARCHAR) || ', url = '"
       f" || {quoted_sql('url')} || ', html = NULL WHERE page_id = ' || cast(page_id AS VARCHAR) || ' AND url = '"
       f" || {quoted_sql('url')} || ' AND html = ' || {quoted_sql('html')} AS sql FROM pages")
def f4(spark, sf):
    df = table(spark, sf, "pages").select("page_id", "url", "html")
    after = F.struct("page_id", "url", F.lit(None).cast("string").alias("html"))
    return df.select("page_id", render.render_update(F.lit("web.pages"), F.struct("page_id", "url", "html"), after, df.schema).alias("sql"))


@check("f5_render_delete", f"""SELECT conv_id, turn, 'DELETE FROM db.talk WHERE conv_id = ' || cast(conv_id AS VARCHAR) ||
  ' AND turn = ' || cast(turn AS VARCHAR) || ' AND role = ' || {quoted_sql('role')} || ' AND text = ' || {quoted_sql('text')} AS sql
  FROM conversations""")
def f5(spark, sf):
    df = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return df.select("conv_id", "turn", render.render_delete(F.lit("db.talk"), F.struct(*df.columns), df.schema).alias("sql"))


@check("f6_row_to_map", """SELECT o_orderkey,
  CASE o_orderkey % 3 WHEN 0 THEN 'status,prio,cust,extra' WHEN 1 THEN 'status,column_1,column_2' ELSE 'column_0,column_1,column_2' END AS names_text,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS prio,
  CASE WHEN o_orderkey % 3 > 0 THEN cast(o_custkey AS VARCHAR) END AS column_2
  FROM (SELECT *, 1 AS one FROM orders)""".replace("'status,prio,cust,extra'", "'status,prio,cust'"))
def f6(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "array(o_orderstatus, o_orderpriority, cast(o_custkey AS string)) AS v",
        "CASE o_orderkey % 3 WHEN 0 THEN array('status', 'prio', 'cust', 'extra') WHEN 1 THEN array('status') END AS n")
    m = rowmap.row_to_map("v", "n")
    return df.select("o_orderkey", F.array_join(F.map_keys(m), ",").alias("names_text"),
                     m["status"].alias("status"), m["prio"].alias("prio"), m["column_2"].alias("column_2"))


_POSITIONS = """SELECT o_orderkey, CASE o_orderkey % 8
  WHEN 0 THEN concat('binlog.', cast(o_custkey AS string), ':', cast(o_orderkey AS string))
  WHEN 1 THEN concat('a:b:', cast(o_orderkey AS string)) WHEN 2 THEN 'a:x' WHEN 3 THEN ''
  WHEN 4 THEN concat('b:', cast(o_orderkey AS string), '::') WHEN 5 THEN concat('b: ', cast(o_orderkey AS string))
  WHEN 6 THEN concat(':-', cast(o_orderkey AS string)) END AS t
FROM {orders}"""


@check("f7_positions", f"""SELECT o_orderkey,
  CASE WHEN ok THEN split_part(u, ':', 1) END AS file, CASE WHEN ok THEN cast(split_part(u, ':', 2) AS BIGINT) END AS pos,
  CASE WHEN ok THEN split_part(u, ':', 1) || ':' || cast(cast(split_part(u, ':', 2) AS BIGINT) AS VARCHAR) END AS again
  FROM (SELECT *, coalesce(regexp_full_match(u, '[^:]*:[+-]?[0-9]+'), false) AS ok
        FROM (SELECT *, regexp_replace(t, ':+$', '') AS u FROM ({_POSITIONS.format(orders='orders')})))""")
def f7(spark, sf):
    p = _sql(spark, sf, _POSITIONS, orders="orders").select("o_orderkey", position.parse_position("t").alias("p"))
    return p.select("o_orderkey", "p.file", "p.pos", position.format_position("p.file", "p.pos").alias("again"))


_GTIDS = """SELECT o_orderkey, CASE o_orderkey % 7
  WHEN 0 THEN concat('u:', cast(o_custkey AS string)) WHEN 1 THEN concat('u:1-', cast(o_custkey AS string))
  WHEN 2 THEN concat('v:', cast(o_custkey AS string)) WHEN 3 THEN concat('u:1-5:', cast(o_custkey AS string))
  WHEN 4 THEN concat('u:x', cast(o_custkey AS string)) WHEN 5 THEN 'u:5-' ELSE 'u' END AS gtid
FROM {orders}"""
_END = "try_cast(CASE WHEN contains(x, '-') THEN CASE WHEN regexp_full_match(split_part(x, '-', 2), '[0-9]+') THEN split_part(x, '-', 2) END WHEN regexp_full_match(x, '[0-9]+') THEN x END AS BIGINT)"


@check("f8_gtid_interval_end", f"SELECT o_orderkey, {_END} AS n FROM (SELECT o_orderkey, split_part(gtid, ':', 2) AS x FROM ({_GTIDS.format(orders='orders')}))")
def f8(spark, sf):
    g = _sql(spark, sf, _GTIDS, orders="orders")
    return g.select("o_orderkey", position.gtid_interval_end(
        F.coalesce(F.get(F.split("gtid", ":"), F.lit(1)), F.lit(""))).alias("n"))


_AFTER = f"""CASE WHEN len(string_split(gtid, ':')) <> 2 THEN false WHEN split_part(gtid, ':', 1) <> 'u' THEN true
  ELSE coalesce(({_END}) > 700, false) END"""


@check("p9_gtid_after", f"SELECT o_orderkey, {_AFTER} AS later FROM (SELECT *, split_part(gtid, ':', 2) AS x FROM ({_GTIDS.format(orders='orders')}))")
def p9(spark, sf):
    return _sql(spark, sf, _GTIDS, orders="orders").select(
        "o_orderkey", position.gtid_after("gtid", F.lit("u:1-700")).alias("later"))


_ENTRIES = f"""SELECT o_orderkey AS entry_no, concat('binlog.', lpad(cast(o_custkey % 40 AS string), 6, '0')) AS file,
  o_orderkey AS pos, CASE WHEN o_orderkey % 3 > 0 THEN gtid END AS gtid
  FROM (SELECT g.gtid, o.* FROM ({{orders}}) o JOIN ({_GTIDS.replace('{orders}', '{orders2}')}) g USING (o_orderkey))"""
_ENTRIES_SQL = _ENTRIES.format(orders="SELECT * FROM orders", orders2="orders")


def _entries(spark, sf):
    g = _sql(spark, sf, _GTIDS, orders="orders")
    return table(spark, sf, "orders").join(g, "o_orderkey").selectExpr(
        "o_orderkey AS entry_no", "concat('binlog.', lpad(cast(o_custkey % 40 AS string), 6, '0')) AS file",
        "o_orderkey AS pos", "CASE WHEN o_orderkey % 3 > 0 THEN gtid END AS gtid")


@check("p8_after_checkpoint", f"""WITH e AS ({_ENTRIES_SQL}), c AS (SELECT 'binlog.000017' AS cf, max(pos) // 2 AS cp FROM e)
  SELECT entry_no, file, pos, gtid FROM (SELECT e.*, split_part(gtid, ':', 2) AS x, cf, cp FROM e, c)
  WHERE CASE WHEN coalesce(gtid, '') <> '' THEN {_AFTER} ELSE file > cf OR (file = cf AND pos > cp) END""")
def p8(spark, sf):
    e = _entries(spark, sf)
    c = e.agg(F.lit("binlog.000017").alias("file"), F.floor(F.max("pos") / 2).alias("pos"), F.lit("u:1-700").alias("gtid"))
    return position.after_checkpoint(e, c)


@check("p10_file_pos_after", f"SELECT entry_no, file > 'binlog.000017' OR (file = 'binlog.000017' AND pos > 4321) AS later FROM ({_ENTRIES_SQL})")
def p10(spark, sf):
    return _entries(spark, sf).select("entry_no", position.file_pos_after("file", "pos", F.lit("binlog.000017"), F.lit(4321)).alias("later"))


@check("f9_progress_pct", """SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN 0.0::DOUBLE
  ELSE cast(o_orderkey AS DOUBLE) / cast(o_custkey % 50 AS DOUBLE) * 100.0::DOUBLE END AS pct FROM orders""")
def f9(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", status.progress_pct("o_orderkey", F.expr("o_custkey % 50")).alias("pct"))


_EVENTS = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'PENDING' WHEN 2 THEN 'IN_PROGRESS'
  WHEN 3 THEN 'COMPLETED' ELSE 'FAILED' END AS old, CASE o_custkey % 4 WHEN 0 THEN 'start' WHEN 1 THEN 'complete'
  WHEN 2 THEN 'fail' ELSE 'reset' END AS event FROM {orders}"""


@check("f10_next_status", f"""SELECT o_orderkey, CASE event WHEN 'complete' THEN 'COMPLETED' WHEN 'fail' THEN 'FAILED' WHEN 'reset' THEN 'PENDING'
  ELSE CASE WHEN old IS NULL OR old = 'COMPLETED' THEN 'PENDING' ELSE 'IN_PROGRESS' END END AS status,
  CASE WHEN old IS NULL THEN 'new' WHEN old = 'COMPLETED' THEN 'restart' ELSE 'resume' END AS decision
  FROM ({_EVENTS.format(orders='orders')})""")
def f10(spark, sf):
    return _sql(spark, sf, _EVENTS, orders="orders").select(
        "o_orderkey", status.next_status("event", "old").alias("status"), status.copy_decision("old").alias("decision"))


@check("f11_entry_id", "SELECT doc_id, 'f.' || lang || ':' || cast(n_chars AS VARCHAR) || ':' || sha256(text) AS entry_id FROM documents")
def f11(spark, sf):
    return table(spark, sf, "documents").select("doc_id", position.entry_id(F.concat(F.lit("f."), "lang"), "n_chars", "text").alias("entry_id"))


@check("f12_statement_terminator", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'DELETE ' || o_orderstatus || ';' WHEN 1 THEN 'DELETE ' || o_orderpriority || ';' WHEN 2 THEN 'a; ;' END AS sql FROM orders""")
def f12(spark, sf):
    raw = F.expr("CASE o_orderkey % 4 WHEN 0 THEN concat('DELETE ', o_orderstatus, ';') WHEN 1 THEN concat('DELETE ', o_orderpriority) WHEN 2 THEN 'a; ' ELSE concat(' ', char(9), char(10)) END")
    return table(spark, sf, "orders").select("o_orderkey", render.statement_terminator(raw).alias("sql"))


@check("f13_parse_name_list", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'a' || o_orderstatus || '|' || cast(o_custkey AS VARCHAR)
  ELSE o_orderpriority END AS names FROM orders""")
def f13(spark, sf):
    raw = F.expr("CASE o_orderkey % 3 WHEN 0 THEN ' , ,' WHEN 1 THEN concat(' a', o_orderstatus, ',', o_custkey, ' ,a', o_orderstatus) ELSE concat(o_orderpriority, ',', char(9), o_orderpriority) END")
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(text.name_list(raw), "|").alias("names"))


@check("f14_export_file_name", """SELECT event_id, 'binlog_sql_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' ||
  CASE WHEN event_id < 10000 THEN lpad(cast(event_id AS VARCHAR), 4, '0') ELSE cast(event_id AS VARCHAR) END || '.sql' AS name FROM events""")
def f14(spark, sf):
    return table(spark, sf, "events").select("event_id", text.export_file_name("ts", "event_id").alias("name"))


@check("f15_task_payload", f"""WITH {TASKS_SQL} SELECT id, '{{"taskName":"' || name || '","taskId":"' || id || '","sourceConnection":"' || source_connection ||
  '","targetConnection":"' || target_connection || '","createTime":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '","executionProgress":' ||
  cast(coalesce(progress, 0) AS VARCHAR) || ',"currentStatus":"' || status || '","updateTime":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '"}}' AS payload FROM tasks""")
def f15(spark, sf):
    return tasks(spark, sf).select("id", status.task_payload().alias("payload"))


_MOVES = """SELECT event_id AS seq, cast(user_id AS string) AS task_id,
  CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'paused' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 101 AS int) END AS progress,
  CASE WHEN event_type = 'error' THEN props WHEN event_id % 2 = 0 THEN '' END AS error_message, ts AS changed_at FROM {events}"""


@check("f16_task_transition", f"""WITH {TASKS_SQL}, moves AS ({_MOVES.format(events='events')}), m AS (
  SELECT task_id, arg_max(status, seq) AS s, arg_max(changed_at, seq) AS u,
    arg_max(progress, seq) FILTER (WHERE progress IS NOT NULL) AS p,
    arg_max(error_message, seq) FILTER (WHERE error_message <> '') AS e,
    arg_max(changed_at, seq) FILTER (WHERE status IN ('completed', 'failed')) AS d FROM moves GROUP BY task_id)
  SELECT id, coalesce(s, status) AS status, coalesce(p, progress) AS progress, coalesce(e, error_message) AS error_message,
    coalesce(u, updated_at) AS updated_at, coalesce(d, completed_at) AS completed_at,
    CASE WHEN d IS NOT NULL THEN false ELSE is_billing END AS is_billing FROM tasks LEFT JOIN m ON id = task_id""")
def f16(spark, sf):
    moves = _sql(spark, sf, _MOVES, events="events")
    return task_transition(tasks(spark, sf), moves).select(
        "id", "status", "progress", "error_message", "updated_at", "completed_at", "is_billing")


@check("f17_task_resume_stage", f"""WITH {TASKS_SQL} SELECT id, cast(coalesce(list_filter([10, 20, 30, 40, 50, 70, 90, 100],
  lambda m: m > coalesce(progress, 0))[1], 10) AS INTEGER) AS stage FROM tasks""")
def f17(spark, sf):
    return tasks(spark, sf).select("id", status.task_resume_stage("progress").alias("stage"))


_TYPES = [("tinyint(1)", "boolean"), ("bit(1)", "boolean"), ("bool", "boolean"), ("tinyint(4)", "tinyint"),
          ("tinyint(3) unsigned", "smallint"), ("SMALLINT", "smallint"), ("smallint unsigned", "int"),
          ("mediumint unsigned", "int"), ("int(11)", "int"), ("int unsigned", "bigint"), ("bigint(20)", "bigint"),
          ("bigint(20) unsigned", "decimal(20,0)"), ("decimal(12, 2)", "decimal(12,2)"), ("decimal(65,30)", "string"),
          ("numeric(8)", "decimal(8,0)"), ("float", "float"), ("double", "double"), ("char(3)", "string"),
          ("varchar(255)", "string"), ("longtext", "string"), ("enum('a','b')", "string"), ("json", "string"),
          ("varbinary(16)", "binary"), ("longblob", "binary"), ("date", "date"), ("datetime(6)", "timestamp_ntz"),
          ("timestamp", "timestamp"), ("time", "string"), ("year(4)", "smallint"), (" int ", "int")]


def _pick(values, key):
    arms = " ".join("WHEN {} THEN '{}'".format(i, v.replace("'", "''")) for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


@check("f18_mysql_type_to_spark", f"SELECT p_partkey, {_pick([s for _, s in _TYPES], 'p_partkey')} AS spark_type FROM part")
def f18(spark, sf):
    raw = F.expr(_pick([m for m, _ in _TYPES], "p_partkey"))
    return table(spark, sf, "part").select("p_partkey", ddl.mysql_type_to_spark(raw).alias("spark_type"))


@check("f19_qualified_name", "SELECT o_orderkey, 'db' || o_orderstatus || '.' || o_orderpriority AS full_name, '`' || o_orderpriority || '`' AS quoted FROM orders")
def f19(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text.qualified_name(F.concat(F.lit("db"), "o_orderstatus"), "o_orderpriority").alias("full_name"),
        text.quote_ident("o_orderpriority").alias("quoted"))
