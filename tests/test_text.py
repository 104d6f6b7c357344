"""Golden texts: literals, statements, export files, parsing and its limits."""

import pathlib

import pytest
from pyspark.sql import Row, functions as F, types as T

from ferrylog.functions import ddl, position, render, text
from ferrylog.operators.statements import parse_statements
from ferrylog.plans.capture import capture_to_files, incremental_replay
from ferrylog.sinks.exports import export_sql, render_changes
from ferrylog.sources.exports import carry_headers, entries_of_blocks, read_export_blocks, read_export_files, read_sql_export

SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("ok", "boolean").add("raw", "binary")
NASTY = "a'b\\c\nd\re\tf\\'g   ﷐ ﷐1 x, y = 'z' WHERE q AND r;"


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


@pytest.mark.parametrize("value, expected", [
    ("cast(null as string)", "NULL"), ("7", "7"), ("true", "1"), ("false", "0"),
    (r"'it\'s'", r"'it\'s'"), (r"'a\\b'", r"'a\\b'"), (r"'a\nb\rc\td'", r"'a\nb\rc\td'"),
    ("X'01FF'", "X'01FF'"), ("date'2024-01-02'", "'2024-01-02'")])
def test_literal(spark, value, expected):
    df = spark.range(1).select(F.expr(value).alias("c"))
    assert df.select(render.sql_literal("c", df.schema["c"].dataType)).first()[0] == expected


def change(op, before, after, pos=4, row_no=0):
    return ("binlog.000001", pos, row_no, "u:1", "db", "t", op, before, after)


CHANGE = (T.StructType().add("file", "string").add("pos", "long").add("row_no", "integer").add("gtid", "string")
          .add("database", "string").add("table", "string").add("op", "string")
          .add("before", SCHEMA).add("after", SCHEMA))


def test_statements(spark):
    rows = [change("INSERT", None, (1, "x", True, None)), change("UPDATE", (1, "x", True, None), (1, None, False, b"\x0a")),
            change("DELETE", (1, None, False, b"\x0a"), None)]
    out = [r.sql for r in render_changes(spark.createDataFrame(rows, CHANGE), SCHEMA).collect()]
    assert out == ["INSERT INTO db.t (id, name, ok, raw) VALUES (1, 'x', 1, NULL);",
                   "UPDATE db.t SET id = 1, name = NULL, ok = 0, raw = X'0A' WHERE id = 1 AND name = 'x' AND ok = 1 AND raw = NULL;",
                   "DELETE FROM db.t WHERE id = 1 AND name = NULL AND ok = 0 AND raw = X'0A';"]


def test_map_statements(spark):
    names = F.array(F.lit("id"), F.lit("s"), F.lit("b"))
    image = F.create_map(F.lit("id"), F.lit("5"), F.lit("s"), F.lit("o'k"), F.lit("b"), F.lit("true"))
    kinds = F.create_map(F.lit("id"), F.lit("number"), F.lit("b"), F.lit("boolean"))
    for op, expected in [("INSERT", "INSERT INTO d.t (id, s, b) VALUES (5, 'o\\'k', 1)"),
                         ("UPDATE", "UPDATE d.t SET id = 5, s = 'o\\'k', b = 1 WHERE id = 5 AND s = 'o\\'k' AND b = 1"),
                         ("DELETE", "DELETE FROM d.t WHERE id = 5 AND s = 'o\\'k' AND b = 1")]:
        assert one(spark, render.render_map_change(F.lit(op), F.lit("d.t"), names, image, image, kinds)) == expected


def test_export_file_text(spark, tmp_path):
    rows = [Row(file="binlog.000012", pos=4994, row_no=0, gtid="u:16", sql="DELETE FROM a WHERE x = 1;"),
            Row(file="binlog.000012", pos=5314, row_no=0, gtid=None, sql="DELETE FROM a WHERE x = 2;")]
    stats = export_sql(spark.createDataFrame(rows, "file string, pos long, row_no int, gtid string, sql string"),
                       str(tmp_path), "20260302_104733", "2026-03-02T10:47:33").collect()
    assert [tuple(r) for r in stats] == [(1, "binlog_sql_20260302_104733_0001.sql", 2)]
    assert [p.name for p in tmp_path.iterdir()] == ["binlog_sql_20260302_104733_0001.sql"]
    assert (tmp_path / "binlog_sql_20260302_104733_0001.sql").read_text() == (
        "-- Binlog SQL Export\n-- Generated at: 2026-03-02T10:47:33\n-- File: binlog_sql_20260302_104733_0001.sql\n"
        "-- Format: [POSITION] filename:position, [GTID] gtid_value, SQL statement\n\n"
        "[POSITION] binlog.000012:4994\n[GTID] u:16\nDELETE FROM a WHERE x = 1;\n\n"
        "[POSITION] binlog.000012:5314\n[GTID] \nDELETE FROM a WHERE x = 2;\n\n")


# Header lines and marks are fixed values of the format.
CAPTURED = """-- Binlog SQL Export
-- Generated at: 2031-07-09T05:06:07.000008
-- File: binlog_sql_20310709_050607_0001.sql
-- Format: [POSITION] filename:position, [GTID] gtid_value, SQL statement

[POSITION] binlog.000301:7701
[GTID] 00000000-aaaa-bbbb-cccc-0123456789ab:5
UPDATE harbor.boats SET id = 3, name = 'Tern' WHERE id = 3 AND name = 'Gull';

[POSITION] binlog.000301:7912
[GTID] 00000000-aaaa-bbbb-cccc-0123456789ab:6
UPDATE harbor.boats SET id = 3, name = 'Auk' WHERE id = 3 AND name = 'Tern';
"""


def test_captured_file_replays_as_a_chain(spark, tmp_path):
    (tmp_path / "binlog_sql_20310709_050607_0001.sql").write_text(CAPTURED)
    target = spark.createDataFrame([(3, "Gull"), (4, "x")], "id int, name string")
    out, reached, rejected = incremental_replay(spark, str(tmp_path), target, ["id"], "harbor.boats")
    assert sorted(map(tuple, out.collect())) == [(3, "Auk"), (4, "x")]
    assert tuple(reached.first()) == ("binlog.000301", 7912, "00000000-aaaa-bbbb-cccc-0123456789ab:6")
    assert rejected.count() == 0


def entries(spark, tmp_path, body):
    (tmp_path / "a.sql").write_bytes(body.encode())
    rows = carry_headers(read_export_files(spark, str(tmp_path))).orderBy("entry_no").collect()
    whole = [(r.entry_no, r.file, r.pos, r.gtid, r.sql, r.orphan) for r in rows]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "11")  # the same in ranges of a few bytes
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = entries_of_blocks(read_export_blocks(spark, str(tmp_path))).orderBy("entry_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.entry_no, r.file, r.pos, r.gtid, r.sql, r.orphan) for r in split] == whole
    return [r[1:] for r in whole]


@pytest.mark.parametrize("body, expected", [
    # A missing id line keeps the id, an empty one resets it.
    ("[POSITION] a:1\n[GTID] u:1\nS1;\n\n[POSITION] a:2\nS2;\n\n[POSITION] a:3\n[GTID] \nS3;\n",
     [("a", 1, "u:1", "S1;", False), ("a", 2, "u:1", "S2;", False), ("a", 3, None, "S3;", False)]),
    # Malformed positions: three parts keep both, a bad number keeps the offset.
    ("[POSITION] a:1\nS1\n[POSITION] a:b:c\nS2\n[POSITION] b:x\nS3\n[POSITION] c:9:\nS4",
     [("a", 1, None, "S1", False), ("a", 1, None, "S2", False), ("b", 1, None, "S3", False), ("c", 9, None, "S4", False)]),
    # Text before the first header; statements on several lines; CR LF; comments.
    ("lost\r\n[POSITION] a:1\r\n  one\r\n-- no\r\n\ttwo \r\n\r\n[POSITION] a:2\r\n\r\n",
     [(None, -1, None, "lost", True), ("a", 1, None, "one two", False)]),
    # No number seen yet.
    ("[POSITION] a:x\nS1", [("a", -1, None, "S1", False)]),
    # The mark inside a line opens nothing.
    ("[POSITION] a:1\nX [POSITION] b:2\n", [("a", 1, None, "X [POSITION] b:2", False)]),
    ("x [POSITION] q:1\n \x01[POSITION] a:1\nS1 [POSITION][POSITION]\n[POSITION] a:2\r[GTID] u:9\nS2\n\t[POSITION] [POSITION]\nS3 [POSITION]\n",
     [(None, -1, None, "x [POSITION] q:1", True), ("a", 1, None, "S1 [POSITION][POSITION]", False), ("a", 2, "u:9", "S2", False),
      ("a", 2, "u:9", "S3 [POSITION]", False)]),
])
def test_headers(spark, tmp_path, body, expected):
    assert entries(spark, tmp_path, body) == expected


def test_round_trip_of_nasty_text(spark, tmp_path):
    rows = [change("INSERT", None, (1, NASTY, True, b"\x00\x27"), 10), change("UPDATE", (1, NASTY, True, b"\x00\x27"), (2, "", None, None), 20),
            change("DELETE", (2, "", None, None), None, 30), change("INSERT", None, (3, "'", False, b""), 40),
            change("INSERT", None, (4, "\\", False, b""), 50), change("INSERT", None, (5, "NULL", False, b""), 60)]
    df = spark.createDataFrame(rows, CHANGE)
    capture_to_files(df, SCHEMA, str(tmp_path), "s", "g", size=2)
    back = parse_statements(read_sql_export(spark, str(tmp_path)), SCHEMA).orderBy("pos").collect()
    assert all(r.error is None for r in back), back
    assert [(r.op, r.before, r.after) for r in back] == [(r.op, r.before, r.after) for r in df.orderBy("pos").collect()]
    assert {(r.database, r.table) for r in back} == {("db", "t")}


@pytest.mark.parametrize("sql, error", [
    ("CREATE TABLE x (id int);", "not a row statement"),
    ("DELETE FROM db.t WHERE id = 1 AND name = 'x' AND ok = 1 AND raw = NULL AND more = 1;", "columns or values"),
    ("DELETE FROM db.t WHERE id = 1 AND name = 'x' AND ok = 1;", "columns or values"),
    ("DELETE FROM db.t WHERE id = x AND name = 'x' AND ok = 1 AND raw = NULL;", "columns or values"),
    ("DELETE FROM db.t WHERE id = 1 OR name = 'x';", "statement shape"),
    ("UPDATE db.t SET id = 1, name = 'x', ok = 1, raw = NULL;", "statement shape"),
    ("INSERT INTO db.t (id, name, ok, raw) VALUES (1, 'x', 1, f(2));", "statement shape"),
    ("INSERT INTO db.t (id, name, ok, raw) VALUES (1, 'x', 1);", "columns or values"),
    ("INSERT INTO db.t SELECT 1;", "statement shape")])
def test_unreadable_statements_keep_a_reason(spark, sql, error):
    entries = spark.createDataFrame([("a", 1, sql)], "file string, pos long, sql string")
    assert parse_statements(entries, SCHEMA).first().error == error


def test_numeric_suffix_order(spark):
    rows = spark.createDataFrame([("b.999999", 5), ("b.1000000", 1)], "file string, pos long")
    plain = [r.file for r in rows.orderBy(position.position_key()).collect()]
    numeric = [r.file for r in rows.orderBy(position.position_key(numeric_suffix=True)).collect()]
    assert plain == ["b.1000000", "b.999999"] and numeric == ["b.999999", "b.1000000"]


@pytest.mark.parametrize("entry, checkpoint, later", [
    (("b", 5, None), None, True), (("b", 5, "u:6"), ("c", 9, "u:5"), True), (("b", 5, "u:5"), ("a", 1, "u:5"), False),
    (("b", 5, "v:1"), ("c", 9, "u:5"), True), (("b", 5, "u:1-5:7"), ("a", 1, "u:1"), False),
    (("b", 5, ""), ("b", 4, "u:5"), True), (("b", 5, None), ("b", 5, None), False), (("a", 99, "u:1"), ("b", 1, None), False)])
def test_after_checkpoint(spark, entry, checkpoint, later):
    rows = spark.createDataFrame([entry], "file string, pos long, gtid string")
    point = position.Position(*checkpoint) if checkpoint else None
    assert position.after_checkpoint(rows, point).count() == int(later)
    if checkpoint:
        lazy = spark.createDataFrame([checkpoint], "file string, pos long, gtid string")
        assert position.after_checkpoint(rows, lazy).count() == int(later)


def test_clean_ddl(spark):
    raw = "CREATE TABLE `a`.`b` (`x` int, KEY (`c d`.`e`)) AUTO_INCREMENT=17 auto_increment=3"
    assert one(spark, ddl.clean_ddl(F.lit(raw))) == "CREATE TABLE `b` (`x` int, KEY (`e`)) AUTO_INCREMENT=1 auto_increment=3"


def test_name_list(spark):
    assert one(spark, text.name_list(F.lit(" a, b ,,a"))) == ["a", "b"]


def test_small_ranges_share_tasks(spark, tmp_path):
    """Many small ranges are read by a few tasks, and what was parsed of them too."""
    (tmp_path / "a.sql").write_text("".join(f"[POSITION] f:{i}\n[GTID] g{i}\nDELETE FROM a.b WHERE n = {i};\n\n" for i in range(2000)))
    held = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        blocks = read_export_blocks(spark, str(tmp_path))
        tasks = blocks.rdd.getNumPartitions()
        found = entries_of_blocks(blocks).orderBy("entry_no").collect()
    finally:
        for k in held:
            spark.conf.unset(k)
    assert [(r.entry_no, r.pos, r.gtid, r.sql) for r in found] == [(i, i, f"g{i}", f"DELETE FROM a.b WHERE n = {i};") for i in range(2000)]
    assert len({r.span for r in blocks.select("span").collect()}) > 100 and tasks <= spark.sparkContext.defaultParallelism
