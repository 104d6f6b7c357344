"""Inputs derived from the driver's tables, in Spark and as SQL text.

The change log is a fixed arithmetic rule over every order; which changes an
order gets depends on its key, but no order is left out of the base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_orderstatus AS status", "o_totalprice AS price",
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS note")


BASE_SQL = """base AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS note
  FROM orders)"""

# step, condition, operation, before (k, status, price), after (k, status, price)
_CURRENT = ("CASE WHEN k % 10 = 0 THEN 'F' WHEN k % 5 = 0 THEN 'P' ELSE status END",
            "CASE WHEN k % 10 = 0 THEN price + 2 WHEN k % 5 = 0 THEN price + 1 ELSE price END")
_STEPS = [
    (1, "k % 5 = 0", "UPDATE", ("k", "status", "price"), ("k", "'P'", "price + 1")),
    (2, "k % 10 = 0", "UPDATE", ("k", "'P'", "price + 1"), ("k", "'F'", "price + 2")),
    (3, "k % 35 = 0", "UPDATE", ("k", "'X'", "price"), ("k", "'Z'", "price + 9")),
    (4, "k % 7 = 0", "DELETE", ("k", *_CURRENT), None),
    (5, "k % 11 = 0", "INSERT", None, ("k + 1000000", "'N'", "price")),
    (6, "k % 13 = 0", "INSERT", None, ("k", "'D'", "CAST(0 AS double)")),
]
_IMAGE = "struct<k:bigint,status:string,price:double,note:string>"


def row_changes(spark, sf_dir) -> DataFrame:
    """The §2.2 change log: one pass over orders, up to six changes per key."""
    def image(parts):
        if parts is None:
            return f"CAST(NULL AS {_IMAGE})"
        k, status, price = parts
        return f"named_struct('k', {k}, 'status', {status}, 'price', {price}, 'note', note)"

    steps = ", ".join(
        f"CASE WHEN {cond} THEN named_struct('step', {step}, 'op', '{op}', "
        f"'before', {image(b)}, 'after', {image(a)}) END"
        for step, cond, op, b, a in _STEPS)
    return (base(spark, sf_dir)
            .selectExpr("k", f"explode(array({steps})) AS c").where("c IS NOT NULL")
            .selectExpr(
                "concat('binlog.', lpad(cast(12 + floor(k / 5000) AS string), 6, '0')) AS file",
                "4 + (k % 5000) * 1000 + c.step * 100 AS pos", "0 AS row_no",
                "concat('u:', k * 10 + c.step) AS gtid",
                "'shop' AS database", "'orders' AS table", "c.op AS op",
                "c.before AS before", "c.after AS after"))


def changes_sql() -> str:
    """The same log in SQL, images spread over columns b_* and a_*."""
    def cols(prefix, parts):
        if parts is None:
            return (f"CAST(NULL AS BIGINT) AS {prefix}_k, CAST(NULL AS VARCHAR) AS {prefix}_status, "
                    f"CAST(NULL AS DOUBLE) AS {prefix}_price, CAST(NULL AS VARCHAR) AS {prefix}_note")
        k, status, price = parts
        return f"{k} AS {prefix}_k, {status} AS {prefix}_status, {price} AS {prefix}_price, note AS {prefix}_note"
    arms = " UNION ALL ".join(
        f"SELECT k, {step} AS step, '{op}' AS op, {cols('b', b)}, {cols('a', a)} FROM base WHERE {cond}"
        for step, cond, op, b, a in _STEPS)
    return f"""{BASE_SQL}, steps AS ({arms}),
row_changes AS (
  SELECT 'binlog.' || lpad(cast(cast(12 + floor(k / 5000) AS BIGINT) AS VARCHAR), 6, '0') AS file,
         4 + (k % 5000) * 1000 + step * 100 AS pos, 0 AS row_no,
         'u:' || cast(k * 10 + step AS VARCHAR) AS gtid,
         'shop' AS "database", 'orders' AS "table", steps.*
  FROM steps)"""


FINAL_SAFE_SQL = f"""WITH {BASE_SQL}
SELECT k,
  CASE WHEN k % 7 = 0 THEN 'D' WHEN k % 10 = 0 THEN 'F' WHEN k % 5 = 0 THEN 'P' ELSE status END AS status,
  CASE WHEN k % 7 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 10 = 0 THEN price + 2
       WHEN k % 5 = 0 THEN price + 1 ELSE price END AS price,
  note
FROM base WHERE NOT (k % 7 = 0 AND k % 13 <> 0)
UNION ALL
SELECT k + 1000000, 'N', price, note FROM base WHERE k % 11 = 0"""

FINAL_NEVER_SQL = f"""WITH {BASE_SQL}
SELECT k,
  CASE WHEN k % 4 = 0 THEN status WHEN k % 7 = 0 THEN 'D' WHEN k % 10 = 0 THEN 'F'
       WHEN k % 5 = 0 THEN 'P' ELSE status END AS status,
  CASE WHEN k % 4 = 0 THEN price WHEN k % 7 = 0 THEN CAST(0 AS DOUBLE)
       WHEN k % 10 = 0 THEN price + 2 WHEN k % 5 = 0 THEN price + 1 ELSE price END AS price,
  note
FROM base WHERE k % 4 = 0 OR NOT (k % 7 = 0 AND k % 13 <> 0)
UNION ALL
SELECT k + 1000000, 'N', price, note FROM base WHERE k % 11 = 0"""


_FEED = """SELECT event_id AS seq,
  concat('binlog.', lpad(cast(cast(12 + floor(event_id / 4000) AS bigint) AS string), 6, '0')) AS file,
  4 + (event_id % 4000) * 100 AS pos,
  CASE WHEN event_id % 50 < 10 THEN 'TABLE_MAP' WHEN event_type = 'signup' THEN 'GTID'
       WHEN event_type = 'error' THEN 'QUERY' WHEN event_type = 'view' THEN 'EXT_WRITE_ROWS'
       WHEN event_type = 'click' THEN 'EXT_UPDATE_ROWS' ELSE 'EXT_DELETE_ROWS' END AS event_type,
  CASE WHEN event_id % 50 < 10 THEN event_id % 10 ELSE user_id % 10 END AS table_id,
  concat('db', cast(event_id % 3 AS string)) AS map_database,
  concat('t', cast(event_id % 10 AS string)) AS map_table,
  CASE WHEN event_id % 50 >= 10 AND event_type = 'signup'
       THEN concat('u:', cast(event_id AS string)) END AS gtid,
  props, value
FROM {events}"""


def feed(spark, sf_dir) -> DataFrame:
    """A change-log feed made of the events table: maps, transactions, DDL, rows."""
    return spark.sql(_FEED.format(events="{e}"), e=table(spark, sf_dir, "events"))


FEED_SQL = f"feed AS ({_FEED.format(events='events')})"


def mapped_sql() -> str:
    """Feed with the as-of table context and the carried transaction id."""
    return f"""{FEED_SQL}, carried AS (
  SELECT feed.* EXCLUDE (gtid, map_database, map_table),
    last_value(CASE WHEN event_type = 'GTID' THEN gtid END IGNORE NULLS) OVER g AS gtid,
    last_value(CASE WHEN event_type = 'TABLE_MAP' THEN map_database END IGNORE NULLS) OVER m AS "database",
    last_value(CASE WHEN event_type = 'TABLE_MAP' THEN map_table END IGNORE NULLS) OVER m AS "table",
    CASE WHEN event_type = 'EXT_WRITE_ROWS' THEN 'INSERT' WHEN event_type = 'EXT_UPDATE_ROWS' THEN 'UPDATE'
         WHEN event_type = 'EXT_DELETE_ROWS' THEN 'DELETE' END AS op
  FROM feed
  WINDOW g AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         m AS (PARTITION BY table_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
mapped AS (SELECT * FROM carried WHERE op IS NOT NULL AND "database" IS NOT NULL)"""


KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"],
    "pages": ["page_id"], "benchmark": ["item_id"],
}


def union_sql(line, tables=TABLES) -> str:
    """One SELECT per table; ``{t}`` is the table name."""
    return " UNION ALL ".join(line.replace("{t}", t) for t in tables)


# Progress ledger: one version per order, one table name per customer.
_LEDGER = """SELECT concat('t', cast(o_custkey AS string)) AS table_name,
  cast(o_custkey % 50 * 100 AS bigint) AS total_rows,
  cast(o_orderkey % 100 * (o_custkey % 50) AS bigint) AS migrated_rows,
  o_orderkey * 3 AS last_migrated_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'IN_PROGRESS'
       WHEN 2 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
  o_orderdate AS start_time, o_orderdate AS last_update_time,
  CASE WHEN o_orderkey % 4 = 2 THEN o_orderdate END AS complete_time,
  CASE WHEN o_orderkey % 4 = 3 THEN concat('lost ', o_orderpriority) END AS error_message,
  o_orderkey % 9 = 0 AS deleted, o_orderkey AS version
FROM {orders}"""
LEDGER_SQL = f"""ledger_log AS ({_LEDGER.format(orders='orders')}),
latest AS (SELECT * FROM ledger_log
           QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY version DESC) = 1),
ledger AS (SELECT * FROM latest WHERE NOT deleted)"""


def ledger_log(spark, sf_dir) -> DataFrame:
    return spark.sql(_LEDGER.format(orders="{o}"), o=table(spark, sf_dir, "orders"))


_TASKS = """SELECT cast(o_orderkey AS string) AS id,
  concat('task ', cast(o_custkey AS string)) AS name,
  concat('src-', o_orderstatus) AS source_connection, o_orderpriority AS target_connection,
  CASE o_orderkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'completed'
       WHEN 3 THEN 'failed' ELSE 'paused' END AS status,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE cast(o_orderkey % 101 AS int) END AS progress,
  o_orderdate AS created_at, o_orderdate AS updated_at,
  CASE WHEN o_orderkey % 5 IN (2, 3) THEN o_orderdate END AS completed_at,
  CASE WHEN o_orderkey % 5 = 3 THEN 'broken' END AS error_message,
  o_orderkey % 5 NOT IN (2, 3) AS is_billing, o_custkey % 6 = 0 AS is_deleted,
  o_orderkey AS version
FROM {orders}"""
TASKS_SQL = f"tasks AS ({_TASKS.format(orders='orders')})"


def tasks(spark, sf_dir) -> DataFrame:
    return spark.sql(_TASKS.format(orders="{o}"), o=table(spark, sf_dir, "orders"))


_LOGS = """SELECT cast(l_linenumber AS bigint) AS id, cast(l_orderkey AS string) AS task_id,
  CASE l_returnflag WHEN 'A' THEN 'info' WHEN 'N' THEN 'warning' ELSE 'error' END AS level,
  concat('part ', cast(l_partkey AS string), ' from ', cast(l_suppkey AS string)) AS message,
  l_shipdate AS created_at
FROM {lineitem}"""
LOGS_SQL = f"task_logs AS ({_LOGS.format(lineitem='lineitem')})"


def task_logs(spark, sf_dir) -> DataFrame:
    return spark.sql(_LOGS.format(lineitem="{l}"), l=table(spark, sf_dir, "lineitem"))


# Statement text of the change log; prices as decimals, whose text both engines agree on.
_DECIMAL_IMAGE = "struct<k:bigint,status:string,price:decimal(18,2),note:string>"


def money_changes(spark, sf_dir) -> DataFrame:
    return row_changes(spark, sf_dir).withColumns({
        "before": F.col("before").cast(_DECIMAL_IMAGE),
        "after": F.col("after").cast(_DECIMAL_IMAGE)})


def money_base(spark, sf_dir) -> DataFrame:
    return base(spark, sf_dir).withColumn("price", F.col("price").cast("decimal(18,2)"))


def quoted_sql(c: str) -> str:
    """The escape chain of a text literal, NULL as a bare word."""
    out = c
    for raw, escaped in ((r"'\'", r"'\\'"), ("''''", r"'\'''"), ("chr(10)", r"'\n'"),
                         ("chr(13)", r"'\r'"), ("chr(9)", r"'\t'")):
        out = f"replace({out}, {raw}, {escaped})"
    return f"coalesce('''' || {out} || '''', 'NULL')"


def _image_sql(prefix: str, sep: str) -> str:
    parts = [("k", f"cast({prefix}_k AS VARCHAR)"), ("status", quoted_sql(f"{prefix}_status")),
             ("price", f"cast(cast({prefix}_price AS DECIMAL(18,2)) AS VARCHAR)"),
             ("note", quoted_sql(f"{prefix}_note"))]
    return f" || '{sep}' || ".join(f"'{n} = ' || {text}" for n, text in parts)


STATEMENT_SQL = f"""CASE op
  WHEN 'INSERT' THEN 'INSERT INTO shop.orders (k, status, price, note) VALUES (' ||
    cast(a_k AS VARCHAR) || ', ' || {quoted_sql('a_status')} || ', ' ||
    cast(cast(a_price AS DECIMAL(18,2)) AS VARCHAR) || ', ' || {quoted_sql('a_note')} || ')'
  WHEN 'UPDATE' THEN 'UPDATE shop.orders SET ' || {_image_sql('a', ', ')} ||
    ' WHERE ' || {_image_sql('b', ' AND ')}
  ELSE 'DELETE FROM shop.orders WHERE ' || {_image_sql('b', ' AND ')} END || ';'"""


def entries_sql() -> str:
    """The change log as export entries."""
    return f"""{changes_sql()}, entries AS (
  SELECT file, pos, gtid, {STATEMENT_SQL} AS sql FROM row_changes)"""
