"""Jobs: copy with failures and resume, JDBC, replay with restarts, capture, ledgers."""

import time

import pytest
from pyspark.sql import functions as F

from checks.inputs import KEYS, row_changes, table
from checks.jobs import _change_feed
from ferrylog.functions.position import Position
from ferrylog.operators import copying, tasks
from ferrylog.operators.fold import apply_changes
from ferrylog.operators.verify import diff_tables, table_checksum
from ferrylog.plans.capture import capture_to_files
from ferrylog.plans.copy import CatalogTarget, CopyConfig, FolderTarget, JdbcTarget, full_copy
from ferrylog.plans.verify import verify_copy
from ferrylog.sinks.applied import AppliedTable
from ferrylog.sinks.ledger import (append_progress, clear_progress, has_incomplete, incomplete_tables,
                                   progress_report, progress_summary, read_checkpoint, read_checkpoints,
                                   read_progress, save_checkpoint, save_checkpoints)
from ferrylog.sinks.tables import JdbcTable, create_target, write_table
from ferrylog.sources.tables import CatalogSource, DirectorySource, JdbcSource, KeyRange, mysql_ddl, scan_table
from ferrylog.streaming.capture import Handler, Handlers
from ferrylog.streaming.handlers import apply_handler, default_handlers, retry_failed
from ferrylog.streaming.watch import Replay, bounded_run, watch_exports


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- full copy --------------------------------------------------------------

class FailingTarget(FolderTarget):
    """Fails on one write, like a target that went away."""

    def __init__(self, spark, root, fail_on):
        super().__init__(spark, root)
        self.left = fail_on

    def write(self, df, table, batch_size, mode="append"):
        self.left -= 1
        if self.left == 0:
            raise OSError("target went away")
        super().write(df, table, batch_size, mode)


def config(tmp_path, **more):
    return CopyConfig(str(tmp_path / "ledger"), str(tmp_path / "checkpoints"), **more)


def test_copy_stops_and_resumes(spark, sf_dir, tmp_path):
    source = DirectorySource(spark, sf_dir, keys=KEYS)
    cfg = config(tmp_path, ranges=4, included_tables=["orders"])
    with pytest.raises(OSError):
        full_copy(spark, source, FailingTarget(spark, str(tmp_path / "t"), 3), cfg, Position("b.1", 4))
    state = read_progress(spark, cfg.ledger_path).first()
    assert state.status == "FAILED" and 0 < state.migrated_rows < state.total_rows
    assert has_incomplete(read_progress(spark, cfg.ledger_path))

    target = FolderTarget(spark, str(tmp_path / "t"))
    before = target.read("orders").count()
    assert before == state.migrated_rows
    result = full_copy(spark, source, target, cfg).first()
    assert (result.copied, result.refused, result.error) == (state.total_rows, 0, None)
    assert diff_tables(table(spark, sf_dir, "orders"), target.read("orders"), ["o_orderkey"]).count() == 0
    assert read_progress(spark, cfg.ledger_path).first().status == "COMPLETED"
    assert read_checkpoint(spark, cfg.checkpoint_path, "copy") == Position("b.1", 4)


def test_rows_written_before_a_crash_are_not_copied_twice(spark, sf_dir, tmp_path):
    """The crash comes between the write and the ledger."""
    source = DirectorySource(spark, sf_dir, keys=KEYS)
    target, cfg = FolderTarget(spark, str(tmp_path / "t")), config(tmp_path, included_tables=["customer"])
    customers = table(spark, sf_dir, "customer")
    target.write(customers.where("c_custkey <= 40"), "customer", 1000)
    append_progress(spark.createDataFrame(
        [("customer", customers.count(), 0, 0, "IN_PROGRESS", None)],
        "table_name string, total_rows long, migrated_rows long, last_migrated_id long, status string, error_message string"
    ).withColumns({c: F.current_timestamp() for c in ("start_time", "last_update_time", "complete_time")}), cfg.ledger_path)
    result = full_copy(spark, source, target, cfg).first()
    assert (result.copied, result.refused) == (customers.count(), 0)
    assert rows_of(target.read("customer")) == rows_of(customers)


def test_bad_rows_stop_or_go_to_quarantine(spark, sf_dir, tmp_path):
    source = DirectorySource(spark, sf_dir, keys={"lineitem": ["l_orderkey", "l_linenumber"], "region": ["r_regionkey"]})
    strict = config(tmp_path / "a", included_tables=["lineitem"])
    with pytest.raises(copying.BadRowsError):
        full_copy(spark, source, FolderTarget(spark, str(tmp_path / "a/t")), strict)
    cfg = config(tmp_path / "b", included_tables=["lineitem", "region"], continue_on_error=True,
                 quarantine_path=str(tmp_path / "b/quarantine"))
    target = FolderTarget(spark, str(tmp_path / "b/t"))
    result = {r.table_name: r for r in full_copy(spark, source, target, cfg).collect()}
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.select("l_orderkey", "l_linenumber").distinct().count()
    assert result["lineitem"].copied == keys and result["lineitem"].refused == lines.count() - keys
    refused = spark.read.parquet(str(tmp_path / "b/quarantine/lineitem"))
    assert refused.agg(F.sum("copies")).first()[0] == lines.count() - keys
    assert result["region"].copied == 5


def test_one_failing_table_does_not_stop_the_others(spark, sf_dir, tmp_path):
    source = DirectorySource(spark, sf_dir, keys=KEYS)
    cfg = config(tmp_path, included_tables=["nation", "region"], continue_on_error=True, parallel_tables=1)
    result = {r.table_name: r for r in full_copy(spark, source, FailingTarget(spark, str(tmp_path / "t"), 1), cfg).collect()}
    assert result["nation"].copied == -1 and "went away" in result["nation"].error
    assert result["region"].copied == 5
    failed = incomplete_tables(read_progress(spark, cfg.ledger_path)).first()
    assert (failed.table_name, failed.status) == ("nation", "FAILED")


def test_copy_into_a_catalog_and_verify(spark, sf_dir, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS copied")
    source, target = DirectorySource(spark, sf_dir, keys=KEYS), CatalogTarget(spark, "copied")
    cfg = config(tmp_path, included_tables=["nation", "part"], drop_tables=True)
    full_copy(spark, source, target, cfg)
    assert all(r.same for r in verify_copy(source, target, ["nation", "part"]).collect())
    back = CatalogSource(spark, "copied")
    assert back.table_names() == ["nation", "part"]
    spark.sql("INSERT INTO copied.nation SELECT * FROM copied.nation LIMIT 1")
    assert [r.same for r in verify_copy(source, target, ["nation"]).collect()] == [False]


def test_empty_tables_get_no_ledger_row(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "src/none.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "src/some.parquet"))
    cfg = config(tmp_path)
    full_copy(spark, DirectorySource(spark, str(tmp_path / "src")), FolderTarget(spark, str(tmp_path / "t")), cfg)
    assert [r.table_name for r in read_progress(spark, cfg.ledger_path).collect()] == ["some"]


def test_one_bad_table_does_not_stop_creation(spark):
    columns = spark.createDataFrame([("good", 1, "a", "int", True), ("bad", 1, "a", "no_such_type", True)],
                                    "table_name string, ordinal int, column_name string, data_type string, nullable boolean")
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    out = {r.table_name: r for r in create_target(spark, columns, "made", drop=True).collect()}
    assert out["good"].created and not out["bad"].created and out["bad"].error
    again = {r.table_name: r.created for r in create_target(spark, columns, "made").collect()}
    assert again == {"good": False, "bad": False}


_MYSQL = ("table_name string, ordinal int, column_name string, data_type string, nullable boolean, default_value string, "
          "is_auto_increment boolean, is_primary_key boolean")


def test_mysql_descriptions_keep_types_keys_and_defaults(spark):
    columns = spark.createDataFrame([
        ("t", 2, "line", "smallint(5) unsigned", False, "3", False, True), ("t", 1, "id", "bigint(20) unsigned", False, None, True, True),
        ("t", 3, "name", "varchar(40)", True, "o'neill", False, False), ("t", 4, "made", "datetime", True, "CURRENT_TIMESTAMP", False, False),
        ("t", 5, "day", "date", True, "0000-00-00", False, False), ("t", 6, "n", "int", True, "not a number", False, False),
        ("u", 1, "x", "json", True, None, False, False)], _MYSQL)
    spark.sql("CREATE DATABASE IF NOT EXISTS typed")
    assert all(r.created for r in create_target(spark, columns, "typed", drop=True, types="mysql").collect())
    made = spark.table("typed.t")
    assert dict(made.dtypes) == {"id": "decimal(20,0)", "line": "int", "name": "string", "made": "timestamp_ntz", "day": "date", "n": "int"}
    noted = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES typed.t").collect()}
    assert (noted["primary_key"], noted["auto_increment"]) == ("id,line", "id")
    spark.sql("INSERT INTO typed.t (id) VALUES (1)")
    row = spark.table("typed.t").first()
    assert (int(row.id), row.line, row.name, row.day, row.n) == (1, 3, "o'neill", None, None) and row.made is not None
    assert spark.table("typed.u").dtypes == [("x", "string")]
    with pytest.raises(ValueError):
        create_target(spark, columns, "typed", types="other")


def test_mysql_text_of_a_description_names_no_database(spark):
    columns = spark.createDataFrame([
        ("t", 1, "id", "int(11)", False, None, True, True), ("t", 2, "who", "varchar(9)", True, "o'x", False, False),
        ("t", 3, "at", "datetime", True, "CURRENT_TIMESTAMP", False, False)], _MYSQL)
    assert mysql_ddl(columns, "old").first().create_sql == (
        "CREATE TABLE `t` (`id` int(11) NOT NULL AUTO_INCREMENT, `who` varchar(9) DEFAULT 'o''x', "
        "`at` datetime DEFAULT CURRENT_TIMESTAMP, PRIMARY KEY (`id`)) AUTO_INCREMENT=1")


# --- JDBC (embedded, in memory, inside this process) --------------------------

DERBY = "jdbc:derby:memory:ferry;create=true"
DERBY_QUERIES = {
    "tables": "SELECT tablename AS table_name FROM sys.systables WHERE tabletype = 'T'",
    "columns": "SELECT t.tablename AS table_name, c.columnnumber AS ordinal, c.columnname AS column_name, "
               "CAST(CAST(c.columndatatype AS VARCHAR(60)) AS VARCHAR(60)) AS data_type, true AS nullable, "
               "CAST(NULL AS VARCHAR(10)) AS default_value, false AS is_auto_increment "
               "FROM sys.systables t JOIN sys.syscolumns c ON t.tableid = c.referenceid WHERE t.tabletype = 'T'",
    "keys": "SELECT 'ORDERS' AS table_name, 'O_ORDERKEY' AS column_name FROM sysibm.sysdummy1",
}


def test_jdbc_round_trip(spark, sf_dir, tmp_path):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    upper = orders.toDF(*[c.upper() for c in orders.columns])
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_table(upper, JdbcTable(DERBY, "ORDERS", props), 500)
    source = JdbcSource(spark, DERBY, props, DERBY_QUERIES)
    assert source.table_names() == ["ORDERS"]
    top = orders.agg(F.max("o_orderkey")).first()[0]
    back = scan_table(source, "ORDERS", ["O_ORDERKEY", "O_TOTALPRICE"], KeyRange("O_ORDERKEY", 0, top, 4))
    assert back.rdd.getNumPartitions() == 4
    assert rows_of(back) == rows_of(orders.select("o_orderkey", "o_totalprice"))
    rest = copying.resume_filter(scan_table(source, "ORDERS"), "O_ORDERKEY", top // 2)
    assert "PushedFilters: [*IsNotNull(O_ORDERKEY), *GreaterThan" in rest._jdf.queryExecution().toString()
    assert rest.count() == orders.where(F.col("o_orderkey") > top // 2).count()

    target = JdbcTarget(spark, "jdbc:derby:memory:ferrytarget;create=true", props)
    result = full_copy(spark, source, target, config(tmp_path, ranges=2)).first()
    assert result.copied == orders.count()
    assert rows_of(target.read("ORDERS").select("O_ORDERKEY")) == rows_of(orders.select("o_orderkey"))


# --- replay -----------------------------------------------------------------

SCHEMA = "k bigint, v string"
CHANGE = ("file string, pos bigint, row_no int, gtid string, database string, table string, op string, "
          "before struct<k:bigint,v:string>, after struct<k:bigint,v:string>")


def changes(spark, rows):
    return spark.createDataFrame([("b.1", pos, n, f"u:{pos}", "db", "t", *c) for pos, n, *c in rows], CHANGE)


def replay_parts(spark, tmp_path):
    applied = AppliedTable(spark, str(tmp_path / "table"), ["k"], buckets=4)
    schema = spark.createDataFrame([], SCHEMA).schema
    job = Replay(spark, applied, schema, "s", str(tmp_path / "cp"), str(tmp_path / "rejected"), "db.t")
    return applied, schema, job


def drain(spark, tmp_path, job):
    query = watch_exports(spark, str(tmp_path / "export"), job, str(tmp_path / "state"), interval=None)
    assert bounded_run(query)


def test_replay_survives_restarts(spark, tmp_path):
    applied, schema, job = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    first = changes(spark, [(10, 0, "UPDATE", (1, "a"), (1, "x")), (20, 0, "DELETE", (2, "b"), None),
                            (30, 0, "INSERT", None, (3, "c")), (30, 1, "INSERT", None, (4, None))])
    capture_to_files(first, schema, str(tmp_path / "export"), "1", "g")
    (tmp_path / "export/odd.sql").write_text("stray\n[POSITION] b.1:31\nCREATE TABLE q;\n")
    drain(spark, tmp_path, job)
    assert rows_of(applied.read()) == [(1, "x"), (3, "c"), (4, None)]
    assert read_checkpoint(spark, str(tmp_path / "cp"), "s") == Position("b.1", 31, None)
    assert sorted(r.error for r in spark.read.parquet(str(tmp_path / "rejected")).collect()) == [
        "not a row statement", "text before the first header"]
    # A late file at or before the checkpoint is skipped, a newer one is applied.
    late = changes(spark, [(5, 0, "UPDATE", (1, "x"), (1, "late"))])
    capture_to_files(late, schema, str(tmp_path / "export"), "2", "g")
    capture_to_files(changes(spark, [(40, 0, "UPDATE", (3, "c"), (3, "d"))]), schema, str(tmp_path / "export"), "3", "g")
    drain(spark, tmp_path, job)
    assert rows_of(applied.read()) == [(1, "x"), (3, "d"), (4, None)]


def test_a_repeated_batch_is_applied_once(spark, tmp_path):
    applied, _, _ = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(1, "a")], SCHEMA))
    # Not idempotent by itself: replayed, it would find (1, a) again.
    log = changes(spark, [(10, 0, "UPDATE", (1, "a"), (1, "b")), (20, 0, "UPDATE", (1, "b"), (1, "c")), (30, 0, "UPDATE", (1, "z"), (1, "y"))])
    applied.apply(log, "batch-0")
    applied.apply(changes(spark, [(40, 0, "UPDATE", (1, "c"), (1, "a"))]), "batch-1")
    applied.apply(log, "batch-0")
    assert rows_of(applied.read()) == [(1, "a")]


def test_a_crash_before_publishing_is_finished(spark, tmp_path, monkeypatch):
    applied, _, _ = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(i, "a") for i in range(20)], SCHEMA))
    log = changes(spark, [(i, 0, "DELETE", (i, "a"), None) for i in range(10)])
    with monkeypatch.context() as broken:
        broken.setattr(applied, "_publish", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            applied.apply(log, "b")
    assert not applied.is_applied("b") and applied.read().count() == 20
    applied.apply(log, "b")
    assert applied.is_applied("b") and [k for k, _ in rows_of(applied.read())] == sorted(range(10, 20), key=repr)


def test_buckets_without_changes_are_not_rewritten(spark, tmp_path):
    applied, _, _ = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(i, "a") for i in range(50)], SCHEMA))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table/data").rglob("*.parquet")}
    applied.apply(changes(spark, [(1, 0, "DELETE", (7, "a"), None)]), "one")
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table/data").rglob("*.parquet")}
    buckets = lambda names: {p.parent.name for p in (tmp_path / "table/data").rglob("*.parquet") if p.name in names}
    assert len(buckets(set(after) - set(before))) == 1
    assert applied.read().count() == 49


def test_two_equal_rows_of_one_event_both_arrive(spark, tmp_path):
    """Equal statements of one event are two changes where the table has no key."""
    from ferrylog.plans.capture import incremental_replay
    schema = spark.createDataFrame([], SCHEMA).schema
    log = changes(spark, [(10, 0, "INSERT", None, (1, "a")), (10, 1, "INSERT", None, (1, "a"))])
    capture_to_files(log, schema, str(tmp_path / "e"), "1", "g")
    target = spark.createDataFrame([], SCHEMA)
    assert rows_of(incremental_replay(spark, str(tmp_path / "e"), target, None)[0]) == [(1, "a"), (1, "a")]
    # The same entries exported again count once.
    capture_to_files(log, schema, str(tmp_path / "e"), "2", "g")
    assert rows_of(incremental_replay(spark, str(tmp_path / "e"), target, None)[0]) == [(1, "a"), (1, "a")]


# --- control tables ---------------------------------------------------------

def test_checkpoints_never_move_back(spark, tmp_path):
    path = str(tmp_path / "cp")
    assert read_checkpoint(spark, path, "a") is None
    assert save_checkpoint(spark, path, "a", Position("b.2", 5, "u:1"))
    assert not save_checkpoint(spark, path, "a", Position("b.1", 99))
    assert not save_checkpoint(spark, path, "a", None)
    assert save_checkpoint(spark, path, "other", Position("b.1", 1))
    assert read_checkpoint(spark, path, "a") == Position("b.2", 5, "u:1")


def test_ledger_report(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame(
        [("users", 10000, 5000, 5000, "IN_PROGRESS", None), ("orders", 20000, 0, 0, "PENDING", None), ("products", 1000, 1000, 1000, "COMPLETED", None)],
        "table_name string, total_rows long, migrated_rows long, last_migrated_id long, status string, error_message string")
    append_progress(rows.withColumns({c: F.current_timestamp() for c in ("start_time", "last_update_time", "complete_time")}), path)
    ledger = read_progress(spark, path)
    assert tuple(progress_summary(ledger).first()) == (3, 1, 1, 0, 1)
    assert {r.table_name: r.progress_pct for r in progress_report(ledger).collect()} == {"users": 50.0, "orders": 0.0, "products": 100.0}
    clear_progress(spark, path, "users")
    assert {r.table_name for r in read_progress(spark, path).collect()} == {"orders", "products"}
    clear_progress(spark, path)
    assert read_progress(spark, path).count() == 0


def test_unreachable_message_sink_is_reported(spark):
    messages = tasks.new_tasks(spark.createDataFrame([("n", None, None), ("", "a", "b")], "name string, source_connection string, target_connection string"))
    assert messages.count() == 1 and len(messages.first().id) == 36
    assert tasks.publish_task_status(messages, "no-such-format") is False


def test_checksum_sees_duplicates(spark):
    two, four = spark.range(2), spark.range(2).union(spark.range(2)).union(spark.range(2))
    assert table_checksum(two).first() != table_checksum(four).first()
    assert table_checksum(two.union(two)).first() != table_checksum(spark.createDataFrame([(5,)] * 4, "id long")).first()


def test_micro_batches_leave_no_scratch(spark, tmp_path):
    import pathlib
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "ferrylog"
    applied, schema, job = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(1, "a")], SCHEMA))
    capture_to_files(changes(spark, [(10, 0, "DELETE", (1, "a"), None)]), schema, str(tmp_path / "export"), "1", "g")
    before = set(shared.iterdir())
    drain(spark, tmp_path, job)
    assert applied.read().count() == 0
    assert set(shared.iterdir()) == before
    assert not (tmp_path / "table/stage/s-0").exists()


def test_scratch_folder_is_the_sessions(spark):
    from ferrylog.session import scratch_root
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


# --- applied tables ---------------------------------------------------------

def test_keys_of_another_type_reach_the_stored_buckets(spark, tmp_path):
    stored = spark.range(1000).selectExpr("id AS k", "'old' AS v")
    for kind in ("bigint", "int", "string"):
        applied = AppliedTable(spark, str(tmp_path / kind), ["k"], buckets=64)
        applied.create(stored)
        made = f"SELECT 'f' AS file, {{}}L AS pos, 0 AS row_no, '{{}}' AS op, {{}} AS before, {{}} AS after"
        image = lambda k, v: f"named_struct('k', cast({k} AS {kind}), 'v', '{v}')"
        none = f"cast(NULL AS struct<k:{kind},v:string>)"
        log = spark.sql(" UNION ALL ".join([made.format(1, "UPDATE", image(7, "old"), image(7, "new")),
                                            made.format(2, "INSERT", none, image(1000, "a")), made.format(3, "INSERT", none, image(1001, "b"))]))
        applied.apply(log, "one")
        rows = {r.k: r.v for r in applied.read().collect()}
        assert len(rows) == 1002 and rows[7] == "new" and rows[8] == "old" and rows[1001] == "b"


def test_versions_of_an_applied_table(spark, tmp_path):
    applied = AppliedTable(spark, str(tmp_path / "table"), ["k"], buckets=4)
    applied.create(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    old = applied.read()
    log = changes(spark, [(1, 0, "DELETE", (1, "a"), None), (2, 0, "DELETE", (2, "b"), None)])
    applied.apply(log, "gone")
    applied.apply(changes(spark, [(3, 0, "INSERT", None, (1, "again"))]), "gone")  # the name was applied
    assert applied.is_applied("gone") and not applied.is_applied("other")
    assert applied.read().count() == 0 and rows_of(old) == [(1, "a"), (2, "b")]  # a reader keeps its version
    # A batch that died before it published leaves a folder; the next one writes it anew.
    (tmp_path / "table/data/000000000002/__bucket=1").mkdir(parents=True)
    applied.apply(changes(spark, [(3, 0, "INSERT", None, (5, "e"))]), "more")
    applied.vacuum()
    assert rows_of(applied.read()) == [(5, "e")]
    assert not list((tmp_path / "table/data/000000000000").glob("__bucket=*"))


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        applied = AppliedTable(spark, str(tmp_path / "table"), ["k"], buckets=1)
        applied.create(spark.range(4000).selectExpr("id AS k", "'x' AS v"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "table/data").glob("*/__bucket=0/*.parquet"))) > 2


def test_buckets_follow_the_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ferrylog.sinks.applied.BUCKET_BYTES", 1000)
    applied = AppliedTable(spark, str(tmp_path / "table"), ["k"])
    applied.create(spark.range(20000).selectExpr("id AS k", "md5(cast(id AS string)) AS v"))
    assert applied._current().buckets > 100 and applied.read().count() == 20000


# --- keys and resumes of a copy ---------------------------------------------

def test_copy_of_signed_keys(spark, tmp_path):
    """The bound 0 is a bound: the second range starts after it."""
    spark.range(-100, 101).selectExpr("id AS k").write.parquet(str(tmp_path / "src/signed.parquet"))
    source, target = DirectorySource(spark, str(tmp_path / "src"), keys={"signed": ["k"]}), FolderTarget(spark, str(tmp_path / "t"))
    result = full_copy(spark, source, target, config(tmp_path, ranges=2)).first()
    assert (result.copied, result.refused, result.error) == (201, 0, None)
    assert target.read("signed").distinct().count() == target.read("signed").count() == 201


def test_keyless_resume_keeps_older_rows(spark, tmp_path):
    spark.range(5).selectExpr("id AS v").write.parquet(str(tmp_path / "src/loose.parquet"))
    source, target, cfg = DirectorySource(spark, str(tmp_path / "src")), FolderTarget(spark, str(tmp_path / "t")), config(tmp_path)
    spark.range(3).selectExpr("id + 100 AS v").write.parquet(str(tmp_path / "t/loose.parquet"))
    stage = f"{cfg.ledger_path}-stage/loose"
    target.write_stage(source.read("loose"), stage, 1000)  # a run that died while its files moved
    moved = sorted((tmp_path / "ledger-stage/loose").glob("*.parquet"))[0]
    moved.rename(tmp_path / "t/loose.parquet" / moved.name)
    append_progress(spark.createDataFrame(
        [("loose", 5, 0, None, "IN_PROGRESS", None)],
        "table_name string, total_rows long, migrated_rows long, last_migrated_id long, status string, error_message string"
    ).withColumns({c: F.current_timestamp() for c in ("start_time", "last_update_time", "complete_time")}), cfg.ledger_path)
    result = full_copy(spark, source, target, cfg).first()
    assert result.copied == 5 and sorted(r.v for r in target.read("loose").collect()) == [0, 1, 2, 3, 4, 100, 101, 102]
    assert not (tmp_path / "ledger-stage/loose").exists()


def test_an_unreachable_target_is_an_error(spark):
    with pytest.raises(Exception):
        JdbcTarget(spark, "jdbc:nothing:here").read("t")


def test_a_backlog_is_drained_in_bounded_batches(spark, tmp_path):
    applied, schema, job = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(0, "a")], SCHEMA))
    for i in range(1, 4):
        capture_to_files(changes(spark, [(i, 0, "INSERT", None, (i, "x"))]), schema, str(tmp_path / "export"), str(i), "g")
    query = watch_exports(spark, str(tmp_path / "export"), job, str(tmp_path / "state"), interval=None, max_files=1)
    assert bounded_run(query) and len(query.recentProgress) >= 3
    assert [r[0] for r in rows_of(applied.read())] == [0, 1, 2, 3]


# --- checkpoints of many positions -------------------------------------------

def test_checkpoints_of_many_positions(spark, tmp_path):
    path, shape = str(tmp_path / "many"), "stream_id string, file string, pos bigint, gtid string"
    log = [("a", "b.1", 9, "u:1"), ("a", "b.2", 5, "u:2"), ("a", "b.1", 99, "u:3"), ("c", "b.1", 1, None), ("n", None, 7, "u"), ("n", "b.1", None, "u")]
    save_checkpoints(spark, path, spark.createDataFrame(log, shape))
    assert rows_of(read_checkpoints(spark, path)) == [("a", "b.2", 5, "u:2"), ("c", "b.1", 1, None)]
    save_checkpoints(spark, path, spark.createDataFrame([("a", "b.2", 4, "u:4"), ("c", "b.1", 2, "u:5")], shape))
    assert rows_of(read_checkpoints(spark, path)) == [("a", "b.2", 5, "u:2"), ("c", "b.1", 2, "u:5")]
    assert save_checkpoint(spark, path, "a", Position("b.3", 1)) and not save_checkpoint(spark, path, "c", Position("b.1", 2))
    assert read_checkpoint(spark, path, "a") == Position("b.3", 1, None)


def test_saves_in_order(spark, tmp_path):
    """First, greatest and last position of a stream: the last is behind and doesn't count."""
    path = str(tmp_path / "order")
    saved = [save_checkpoint(spark, path, "s", Position(f, p)) for f, p in (("b.1", 4), ("b.3", 9), ("b.2", 50))]
    assert saved == [True, True, False] and read_checkpoint(spark, path, "s") == Position("b.3", 9, None)


def test_checkpoint_query_reads_the_table(spark, sf_dir):
    from checks.events import k6
    plan = k6(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "LocalRelation" not in plan and "LogicalRDD" not in plan


# --- the streamed change feed -------------------------------------------------

def test_change_feed_is_two_batches_of_several_files(spark, sf_dir, tmp_path):
    seen = {}

    def look(rows, batch_id):
        at = rows.select("seq", F.input_file_name().alias("file"))
        seen[batch_id] = tuple(at.agg(F.min("seq"), F.max("seq"), F.count("seq"), F.count_distinct("file")).first())

    bounded_run(_change_feed(spark, sf_dir).writeStream.foreachBatch(look).trigger(availableNow=True)
                .option("checkpointLocation", str(tmp_path / "state")).start())
    most = row_changes(spark, sf_dir).count() + 1
    assert [b[:3] for _, b in sorted(seen.items())] == [(1, most // 2, most // 2), (most // 2 + 1, most, most - most // 2)]
    assert all(files > 1 for *_, files in seen.values())


# --- handlers that fail --------------------------------------------------------

EVENT = ("seq long, event_class string, op string, file string, pos long, gtid string, database string, table string, "
         "rows array<struct<before:map<string,string>,after:map<string,string>>>, ddl_sql string")


def dml(spark, *rows):
    return spark.createDataFrame([(n, "DML", op, "b.1", n, None, "db", "t", [(before, after)], None) for n, op, before, after in rows], EVENT)


def test_a_failed_batch_holds_the_later_ones(spark, tmp_path):
    applied, schema, _ = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([], SCHEMA))
    inner, away, seen = apply_handler(applied, schema, "s", "db.t"), [True], []

    def handle(events, batch_id):
        if away[0]:
            raise OSError("target went away")
        inner.handle(events, batch_id)

    def handlers():  # a restart has the same queue
        return Handlers([inner._replace(handle=handle), Handler("other", F.lit(True), lambda e, i: seen.append((i, e.count())))], str(tmp_path / "failed"))

    first, second = dml(spark, (1, "INSERT", None, {"k": "1", "v": "a"})), dml(spark, (2, "UPDATE", {"k": "1", "v": "a"}, {"k": "1", "v": "b"}))
    own = handlers()
    own.run(first, 0)
    away[0] = False
    own = handlers()
    own.run(second, 1)
    assert own.queued(spark, "apply") == [0, 1] and rows_of(applied.read()) == [] and seen == [(0, 1), (1, 1)]
    away[0] = True
    assert not retry_failed(spark, own) and own.queued(spark, "apply") == [0, 1]
    own.run(first, 0)  # a batch that runs again after a crash
    assert own.queued(spark, "apply") == [0, 1]
    away[0] = False
    assert retry_failed(spark, own) and own.failed(spark) == [] and rows_of(applied.read()) == [(1, "b")]
    own.recover_first = True
    own.run(dml(spark, (3, "DELETE", {"k": "1", "v": "b"}, None)), 2)
    assert rows_of(applied.read()) == [] and [n for n, *_ in own.errors] == [0, 0]


def test_bad_values_go_to_quarantine(spark, tmp_path):
    applied, schema, _ = replay_parts(spark, tmp_path)
    applied.create(spark.createDataFrame([(5, "x")], SCHEMA))
    events = dml(spark, (1, "INSERT", None, {"k": "1", "v": "a"}), (2, "INSERT", None, {"k": "bad", "v": "b"}),
                 (3, "UPDATE", {"k": "5", "v": "x"}, {"k": "99999999999999999999", "v": "y"}), (4, "INSERT", None, {"k": None, "v": None}))
    strict = Handlers([apply_handler(applied, schema, "strict", "db.t")])
    strict.run(events, 0)
    assert "no value of its type: k" in strict.errors[0][2] and rows_of(applied.read()) == [(5, "x")]
    own = Handlers([apply_handler(applied, schema, "s", "db.t", str(tmp_path / "bad"))])
    own.run(events, 0)
    assert not own.errors and sorted(map(tuple, applied.read().collect()), key=repr) == [(1, "a"), (5, "x"), (None, None)]
    bad = spark.read.parquet(str(tmp_path / "bad")).orderBy("pos").collect()
    assert [(r.pos, r.after["k"], r.error) for r in bad] == [(2, "bad", "no value of its type: k"), (3, "99999999999999999999", "no value of its type: k")]


def test_default_handlers():
    export, audit, apply = (Handler(n, F.lit(True), None) for n in ("export", "audit", "apply"))
    names = lambda handlers: [h.name for h in handlers.handlers]
    assert names(default_handlers(export, audit, apply)) == ["export"] and names(default_handlers(audit=audit, apply=apply)) == ["audit", "apply"]
    assert names(default_handlers()) == []
