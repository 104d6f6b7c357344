"""Export files that are read while they grow, and in byte ranges."""

import io
import random

import pytest

from ferrylog.functions.position import Position
from ferrylog.plans.capture import capture_to_files, incremental_replay
from ferrylog.sinks.applied import AppliedTable
from ferrylog.sinks.ledger import read_checkpoint
from ferrylog.sources import growing
from ferrylog.sources.exports import carry_headers, entries_of_blocks, parse_ranges, read_export_blocks, read_export_files
from ferrylog.streaming.watch import Replay, bounded_run, watch_exports

SCHEMA = "k bigint, v string"


def statements(n, seed=1):
    """A log of entries over a few keys, some of them several to one event, one without an id line."""
    rng, rows, out = random.Random(seed), {}, []
    for i in range(n):
        k, new = rng.randrange(6), f"v{i}; it\\'s\\n[POSITION] x"
        old = rows.get(k)
        if old is None:
            sql, rows[k] = f"INSERT INTO db.t (k, v) VALUES ({k}, '{new}');", new
        elif rng.random() < 0.3:
            sql = f"DELETE FROM db.t WHERE k = {k} AND v = '{old}';"
            del rows[k]
        else:
            sql, rows[k] = f"UPDATE db.t SET k = {k}, v = '{new}' WHERE k = {k} AND v = '{old}';", new
        gtid = "" if i % 5 == 1 else f"[GTID] u:{i // 3}\n"
        out.append(f"[POSITION] b.{i // 40:04d}:{i % 40 // 3 + 4}\n{gtid}{sql}\n\n")
    return "-- Binlog SQL Export\n\n", out


def cut(text, file_range):
    data = text.encode()
    return [(a, b.decode()) for a, b in growing.blocks_of(io.BytesIO(data), ("f", *file_range))]


def test_blocks_of_ranges():
    head, entries = statements(30)
    text = head + "".join(entries) + "  \x02[POSITION] z:1\rlast [POSITION] no\n"
    whole = cut(text, (0, len(text.encode()), len(text.encode()), True))
    assert len(whole) == 32 and "".join(b for _, b in whole) == text
    for size in (1, 7, 64, 1000):
        parts = [x for a in range(0, len(text), size) for x in cut(text, (a, min(a + size, len(text)), len(text), a == 0))]
        assert parts == whole


@pytest.mark.parametrize("text, end", [
    ("[POSITION] a:1\nS;\n", 18), ("[POSITION] a:1\nS;", 0), ("[POSITION] a:1\nS\n", 0), ("[POSITION] a:1\nS;\n[POSITION] a:2\nT", 18),
    ("[POSITION] a:1\nS = ';\n", 0), ("[POSITION] a:1\nS = '\\';\n", 0), ("[POSITION] a:1\nS = ';';\n\n", 25), ("-- head\n", 0), ("", 0),
    ("[POSITION] a:1\nS;\n[POSIT", 0), ("[POSITION] a:1\nx [POSITION];\n", 29),
])
def test_an_open_block_waits(text, end, monkeypatch):
    for look in (4, 1 << 16):
        monkeypatch.setattr(growing, "LOOK", look)
        assert growing.closed_end(io.BytesIO(text.encode()), len(text)) == end


def parts(spark, tmp_path):
    applied = AppliedTable(spark, str(tmp_path / "table"), ["k"], buckets=2)
    shape = spark.createDataFrame([], SCHEMA)
    applied.create(shape)
    return applied, Replay(spark, applied, shape.schema, "s", str(tmp_path / "cp"), str(tmp_path / "rejected"), "db.t")


def drain(spark, tmp_path, job, **options):
    assert bounded_run(watch_exports(spark, str(tmp_path / "export"), job, str(tmp_path / "state"), interval=None, **options))


def test_growing_files_equal_the_whole_replay(spark, tmp_path):
    """Cuts fall between entries, inside statements and inside marks; two files, one of them later."""
    head, entries = statements(60)
    applied, job = parts(spark, tmp_path)
    folder = tmp_path / "export"
    folder.mkdir()
    a, b = head + "".join(entries[:38]), head + "".join(entries[38:])
    steps = [("a.sql", a[:7]), ("a.sql", a[:len(a) // 3]), ("a.sql", a), ("b.sql", b)]
    for name, text in steps:
        (folder / name).write_text(text)
        drain(spark, tmp_path, job, range_bytes=900)
    empty = spark.createDataFrame([], SCHEMA)
    whole, reached, rejected = incremental_replay(spark, str(folder), empty, ["k"], "db.t")
    assert sorted(map(tuple, applied.read().collect())) == sorted(map(tuple, whole.collect())) and rejected.count() == 0
    assert read_checkpoint(spark, str(tmp_path / "cp"), "s") == Position(*reached.first())
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 0


def test_an_event_goes_on_in_the_next_batch(spark, tmp_path):
    applied, job = parts(spark, tmp_path)
    (tmp_path / "export").mkdir()
    file = tmp_path / "export/a.sql"
    file.write_text("[POSITION] b:5\n[GTID] u:1\nINSERT INTO db.t (k, v) VALUES (1, 'a');\n\n")
    drain(spark, tmp_path, job)
    with file.open("a") as out:
        out.write("[POSITION] b:5\n[GTID] u:1\nINSERT INTO db.t (k, v) VALUES (2, 'b');\n\n[POSITION] broken\nINSERT INTO db.t (k, v) VALUES (3, 'c');\n")
    drain(spark, tmp_path, job)
    drain(spark, tmp_path, job)
    assert sorted(map(tuple, applied.read().collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert read_checkpoint(spark, str(tmp_path / "cp"), "s") == Position("b", 5, "u:1")


def test_a_rewritten_file_is_refused(spark, tmp_path):
    _, job = parts(spark, tmp_path)
    (tmp_path / "export").mkdir()
    file = tmp_path / "export/a.sql"
    file.write_text("[POSITION] b:5\nINSERT INTO db.t (k, v) VALUES (1, 'a');\n")
    drain(spark, tmp_path, job)
    file.write_text("[POSITION] b:6\n")
    with pytest.raises(Exception, match="written anew"):
        drain(spark, tmp_path, job)


def test_split_read_uses_several_tasks_and_parses_once(spark, tmp_path):
    head, entries = statements(400)
    (tmp_path / "a.sql").write_text(head + "".join(entries))
    (tmp_path / "b.sql").write_text("stray\n" + "".join(entries[:3]))
    columns = ["source_file", "entry_no", "file", "pos", "gtid", "sql", "orphan"]
    whole = carry_headers(read_export_files(spark, str(tmp_path))).select(columns).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        blocks = read_export_blocks(spark, str(tmp_path))
        assert blocks.select("path", "span").distinct().count() > 8
        split = entries_of_blocks(blocks).select(columns).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(split) == sorted(whole) and len(whole) == 404


def test_seeds_carry_headers(spark):
    shape = "path string, source_file string, span long, place long, block string"
    rows = [("/x/a", "a", 90, 90, "S1;\n"), ("/x/a", "a", 90, 99, "[POSITION] q:9:9\nS2;\n"), ("/x/b", "b", 0, 0, "S3;\n")]
    seed = spark.createDataFrame([("/x/a", "b.1", 7, "u:1", 4, -1)], "path string, file string, pos long, gtid string, blocks long, span long")
    out = entries_of_blocks(parse_ranges(spark.createDataFrame(rows, shape)), seed).orderBy("sql").collect()
    assert [(r.entry_no, r.file, r.pos, r.gtid, r.orphan) for r in out] == [(4, "b.1", 7, "u:1", False), (5, "b.1", 7, "u:1", False), (0, None, -1, None, True)]


def test_dedup_forgets_what_the_frontier_has_passed(spark, tmp_path):
    from ferrylog.streaming.watch import dedup_by_frontier

    shape, path = "entry_id string, file string, pos long", str(tmp_path / "in")
    batches = [[(f"{i}:{j}", "b.000009", i) for i in range(10) for j in range(2)] * 2, [(f"{i}:{j}", "b.000009", i) for i in range(5, 14) for j in range(3 if i == 9 else 2)],
               [(f"x{i}", "b.000010", i) for i in range(3)] + [("9:0", "b.000009", 9)], [("x2", "b.000010", 2), ("y", "b.000010", 3)]]
    for rows in batches:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(path)
    query = (dedup_by_frontier(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted(r.entry_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted([*(f"{i}:{j}" for i in range(14) for j in range(2)), "9:2", "x0", "x1", "x2", "y"])
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 3
