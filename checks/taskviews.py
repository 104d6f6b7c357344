"""Task tables: state, pages, logs, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import LOGS_SQL, TASKS_SQL, table, task_logs, tasks
from checks.registry import check
from checks.functions import f15
from ferrylog.operators import tasks as op
from ferrylog.operators.ranges import ordered_page
from ferrylog.session import scratch_path

_T = "id, name, status, created_at"
_NAMES = _T.split(", ")
_PAYLOAD = """'{"taskName":"' || name || '","taskId":"' || id || '","sourceConnection":"' || source_connection ||
  '","targetConnection":"' || target_connection || '","createTime":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '","executionProgress":' ||
  cast(coalesce(progress, 0) AS VARCHAR) || ',"currentStatus":"' || status || '","updateTime":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '"}'"""


@check("p12_live_tasks", f"WITH {TASKS_SQL} SELECT {_T} FROM tasks WHERE NOT is_deleted")
def p12(spark, sf):
    return op.live_tasks(tasks(spark, sf)).select(*_NAMES)


@check("p12_task_by_id", f"WITH {TASKS_SQL} SELECT {_T} FROM tasks WHERE NOT is_deleted AND id = '123'")
def p12_id(spark, sf):
    return op.task_by_id(tasks(spark, sf), "123").select(*_NAMES)


@check("a7_task_total", f"WITH {TASKS_SQL} SELECT count(*) AS total FROM tasks WHERE NOT is_deleted")
def a7(spark, sf):
    return op.task_total(tasks(spark, sf))


@check("o4_page_tasks", f"""WITH {TASKS_SQL} SELECT {_T}, (SELECT count(*) FROM tasks WHERE NOT is_deleted) AS total FROM tasks WHERE NOT is_deleted
  ORDER BY created_at DESC, id LIMIT 10 OFFSET 20""")
def o4(spark, sf):
    return op.page_tasks(tasks(spark, sf), 3).select(*_NAMES, "total")


@check("o4_deep_page", f"""WITH {TASKS_SQL}, live AS (SELECT {_T}, row_number() OVER (ORDER BY created_at DESC, id) AS i, count(*) OVER () AS total FROM tasks WHERE NOT is_deleted)
  SELECT {_T}, total FROM live WHERE (i - 1) // 20 = total // 40""")
def o4_deep(spark, sf):
    """The page in the middle, found by counts of ranges."""
    live = op.live_tasks(tasks(spark, sf))
    middle = live.count() // 40 + 1
    return ordered_page(live, ["created_at", "id"], middle, 20, ["created_at"], range_rows=200, fan=8).select(*_NAMES, "total")


@check("o5_task_log_page", f"WITH {LOGS_SQL} SELECT * FROM task_logs WHERE task_id = '56' ORDER BY created_at DESC, id DESC")
def o5(spark, sf):
    return op.task_log_page(task_logs(spark, sf), "56")


@check("j6_task_with_logs", f"""WITH {TASKS_SQL}, {LOGS_SQL} SELECT t.id, t.status, l.id AS log_id, level, message, l.created_at AS logged_at
  FROM tasks t LEFT JOIN task_logs l ON t.id = l.task_id WHERE NOT is_deleted""")
def j6(spark, sf):
    return op.task_with_logs(tasks(spark, sf), task_logs(spark, sf)).select("id", "status", "log_id", "level", "message", "logged_at")


@check("k7_publish_task_status", f"WITH {TASKS_SQL} SELECT {_PAYLOAD} AS value FROM tasks WHERE NOT is_deleted")
def k7(spark, sf):
    """Messages through a file sink; a broker would take the same columns."""
    path = scratch_path(spark, "messages")
    assert op.publish_task_status(op.live_tasks(tasks(spark, sf)), "json", path=path)
    return spark.read.schema("topic string, partition int, key string, value string").json(path).select("value")


@check("k9_new_tasks", """SELECT 'c' || cast(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'default-source' ELSE c_mktsegment END AS source_connection,
  CASE WHEN c_custkey % 4 = 0 THEN 'default-target' ELSE 'n' || cast(c_nationkey AS VARCHAR) END AS target_connection, 'pending' AS status, 0 AS progress, true AS is_billing, false AS is_deleted FROM customer""")
def k9(spark, sf):
    asked = table(spark, sf, "customer").selectExpr("concat('c', c_custkey) AS id", "c_name AS name", "CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS source_connection",
                                                    "CASE WHEN c_custkey % 4 > 0 THEN concat('n', c_nationkey) END AS target_connection")
    return op.new_tasks(asked).select("id", "name", "source_connection", "target_connection", "status", "progress", "is_billing", "is_deleted")


@check("k9_soft_delete", f"""WITH {TASKS_SQL}, d AS (SELECT DISTINCT cast(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_returnflag = 'R')
  SELECT id, is_deleted OR id IN (SELECT id FROM d) AS is_deleted, version + CASE WHEN NOT is_deleted AND id IN (SELECT id FROM d) THEN 1 ELSE 0 END AS version FROM tasks""")
def k9_delete(spark, sf):
    t = tasks(spark, sf)
    ids = table(spark, sf, "lineitem").where("l_returnflag = 'R'").selectExpr("cast(l_orderkey AS string) AS id")
    gone = op.soft_delete(t, ids).select("id", "is_deleted", "version")
    return op.current_tasks(t.select("id", "is_deleted", "version").unionByName(gone))


@check("k9_append_logs", f"WITH {LOGS_SQL} SELECT level, count(*) AS lines FROM task_logs GROUP BY level")
def k9_logs(spark, sf):
    path = scratch_path(spark, "logs")
    op.new_logs(task_logs(spark, sf)).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("level").agg(F.count(F.lit(1)).alias("lines"))
