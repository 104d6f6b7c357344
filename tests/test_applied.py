"""Applied tables: runs, their merging, and what a batch writes."""

import random

from pyspark.sql import functions as F

from ferrylog.operators.fold import apply_changes
from ferrylog.sinks.applied import AppliedTable, BatchNames, Run, _merged

SCHEMA = "k bigint, v string"
CHANGE = "file string, pos bigint, row_no int, op string, before struct<k:bigint,v:string>, after struct<k:bigint,v:string>"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_batches_equal_one_log(spark, tmp_path):
    """Small batches, with moved keys, onto a large table: the runs stay few and are folded in when read."""
    stored = spark.range(3000).selectExpr("id AS k", "repeat(md5(cast(id AS string)), 20) AS v")
    rng, at, log = random.Random(3), {}, []
    for pos in range(40):
        k = rng.randrange(8)
        old = at.get(k)
        new = (k if rng.random() < 0.7 else 5000 + pos, f"v{pos}")
        if old is None:
            log.append(("f", pos, 0, "INSERT", None, (10_000 + k, f"v{pos}")))
            at[k] = (10_000 + k, f"v{pos}")
        else:
            log.append(("f", pos, 0, "UPDATE", old, new) if rng.random() < 0.8 else ("f", pos, 0, "DELETE", old, None))
            at[k] = new if log[-1][3] == "UPDATE" else None
    for merge_share in (0.25, 1000.0):
        table = AppliedTable(spark, str(tmp_path / f"t{merge_share}"), ["k"], buckets=4, merge_share=merge_share)
        table.create(stored)
        for i in range(8):
            table.apply(spark.createDataFrame(log[i * 5:i * 5 + 5], CHANGE), f"s-{i}")
            table.apply(spark.createDataFrame(log[:5], CHANGE), "s-0")
        now = table._current()
        assert 0 < len(now.runs) <= 4 and now.applied == {"ranges": {"s": [[0, 7]]}, "names": []}
        want = rows_of(apply_changes(stored, spark.createDataFrame(log, CHANGE), ["k"]))
        assert rows_of(table.read()) == want
    table.compact()
    table.vacuum()
    assert not table._current().runs and rows_of(table.read()) == want
    assert not list((tmp_path / f"t{merge_share}/data").glob("*/__log")) and table.is_applied("s-7") and not table.is_applied("s-8")


def test_a_batch_writes_no_more_than_itself(spark, tmp_path):
    table = AppliedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    table.create(spark.range(40_000).selectExpr("id AS k", "md5(cast(id AS string)) AS v"))
    size = lambda: sum(p.stat().st_size for p in (tmp_path / "t/data").rglob("*.parquet"))
    whole = size()
    table.apply(spark.createDataFrame([("f", 1, 0, "INSERT", None, (-1, "x"))], CHANGE), "one")
    assert size() - whole < whole / 100 and table.read().count() == 40_001
    for i in range(14):
        table.apply(spark.createDataFrame([("f", 1, 0, "INSERT", None, (-2 - i, "x"))], CHANGE), f"b-{i}")
    assert len(list((tmp_path / "t/versions").iterdir())) <= 10
    table.apply(spark.range(20_000).selectExpr("'f' AS file", "id AS pos", "0 AS row_no", "'DELETE' AS op",
                "named_struct('k', id, 'v', md5(cast(id AS string))) AS before", "cast(NULL AS struct<k:bigint,v:string>) AS after"), "many")
    assert not table._current().runs and table.read().count() == 20_015 and table.is_applied("one")


def test_runs_of_like_size_are_merged():
    runs = []
    for i in range(200):
        runs.append(Run(str(i), 10 + i % 3, i, i))
        taken = _merged(runs)
        if taken > 1:
            runs[-taken:] = [Run("m", sum(r.bytes for r in runs[-taken:]), runs[-taken].first, i)]
        assert len(runs) <= 9
    assert [r.first for r in runs[1:]] == [r.last + 1 for r in runs[:-1]] and sum(r.bytes for r in runs) > 2000


def test_names_of_batches():
    known = None
    for name in ("s-0", "s-1", "a", "s-3", "t-9-2", "s-2", "u-007", "v-", "7"):
        assert name not in BatchNames(known)
        known = BatchNames(known).plus(name)
    assert known["ranges"] == {"s": [[0, 3]], "t-9": [[2, 2]]} and all(n in BatchNames(known) for n in ("s-2", "a", "t-9-2", "u-007", "v-", "7"))
    assert all(n not in BatchNames(known) for n in ("s-4", "u-7", "t-9-1", "b", "s"))


# --- digest tree ----------------------------------------------------------------

def test_only_unequal_ranges_are_compared(spark):
    from ferrylog.operators.verify import diff_by_digest, diff_tables, rows_in_unequal_ranges

    left = spark.range(20_000).selectExpr("id AS k", "cast(id % 7 AS string) AS v", "id AS w")
    other = left.where("k NOT IN (5, 77)").selectExpr("cast(k AS string) AS k", "CASE WHEN k = 900 THEN NULL ELSE v END AS v", "w")
    other = other.union(spark.sql("SELECT '-3', 'x', 1L")).union(other.where("k = '12'"))
    got = rows_of(diff_by_digest(left, other, ["k"]))
    assert got == rows_of(diff_tables(left, other.selectExpr("cast(k AS bigint) AS k", "v", "w"), ["k"]))
    assert [(r[0], r[1]) for r in got] == [(-3, "extra"), (12, "changed"), (5, "missing"), (77, "missing"), (900, "changed")]
    rows = rows_in_unequal_ranges(left, other, ["k"])
    assert sum(df.count() for df in rows) < 40
    assert diff_by_digest(left, left, ["k"]).count() == 0 and rows_in_unequal_ranges(left, left.selectExpr("w", "v", "k"), ["k"]) is None
    assert diff_by_digest(left.limit(0), left, ["k"]).count() == 20_000 and diff_by_digest(left.limit(0), left.limit(0), ["k"]).count() == 0


# --- snapshots of a ledger --------------------------------------------------------

def test_many_writes_are_read_from_a_snapshot(spark, tmp_path, monkeypatch):
    from ferrylog.functions.position import Position
    from ferrylog.sinks import ledger

    monkeypatch.setattr(ledger, "TAIL", 5)
    path = str(tmp_path / "cp")
    for i in range(14):
        ledger.save_checkpoint(spark, path, f"s{i % 2}", Position("b", i, f"u:{i}"))
    snapshot, tail, _ = ledger._parts(spark, path)
    assert snapshot is not None and len(tail) <= 5 and len(list((tmp_path / "cp").iterdir())) <= 14
    assert ledger.read_checkpoint(spark, path, "s0") == Position("b", 12, "u:12") and ledger.read_checkpoint(spark, path, "s1") == Position("b", 13, "u:13")
    assert not ledger.save_checkpoint(spark, path, "s0", Position("b", 3))
    # A snapshot that died before its list was written does not count.
    (tmp_path / "cp/snapshot-99999999999999999999-x/states").mkdir(parents=True)
    assert ledger._parts(spark, path)[0] == snapshot and ledger.read_checkpoints(spark, path).count() == 2


def test_a_tombstone_in_a_snapshot_still_counts(spark, tmp_path):
    from ferrylog.schema import PROGRESS_LOG
    from ferrylog.sinks import ledger

    path, names = str(tmp_path / "log"), [f.name for f in PROGRESS_LOG]
    row = spark.createDataFrame([("t", 5, 5, 5, "COMPLETED", None)], "table_name string, total_rows long, migrated_rows long, last_migrated_id long, status string, error_message string")
    row = row.select("*", *[F.lit(None).alias(n) for n in names if n not in row.columns + ["deleted", "version"]])
    ledger._append(ledger.progress_versions(row, version=F.lit(10), deleted=True), path, PROGRESS_LOG, ledger._latest_progress)
    ledger.fold_tail(spark, path, PROGRESS_LOG, ledger._latest_progress, 0)
    ledger._append(ledger.progress_versions(row, version=F.lit(3)), path, PROGRESS_LOG, ledger._latest_progress)
    assert ledger.read_progress(spark, path).count() == 0
