"""Steps whose tasks must not read more as the tables grow."""

import re

import pytest
from pyspark.sql import functions as F

from checks import copying as checked
from checks.inputs import TABLES
from ferrylog.operators.copying import split_bad_rows
from ferrylog.schema import PROGRESS_LOG
from ferrylog.sinks import ledger


def _states(spark, n):
    given = {"table_name": "concat('t', id)", "status": "'PENDING'"}
    return spark.range(n).selectExpr(*[f"cast({given.get(f.name, 'id' if f.name.endswith(('_rows', '_id')) else 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
                                       for f in PROGRESS_LOG if f.name not in ("deleted", "version")])


@pytest.fixture
def small_shares(spark):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for key in keys:
        spark.conf.set(key, "64k")
    yield
    for key in keys:
        spark.conf.unset(key)


def _files(path, n=-1):
    return len(list(sorted(path.iterdir())[n].rglob("*.parquet")))


@pytest.mark.parametrize("table, left", [("t77", 39_999), (None, 0)])
def test_ledger_writes_of_many_rows_are_shared_out(spark, tmp_path, small_shares, table, left):
    path = tmp_path / "log"
    ledger.append_progress(_states(spark, 40_000), str(path))
    assert _files(path) > 1
    ledger.clear_progress(spark, str(path), table)
    assert _files(path) > 1 or table
    assert ledger.read_progress(spark, str(path)).count() == left
    ledger.append_progress(_states(spark, 3), str(path))
    assert _files(path) == 1


def test_snapshots_of_many_rows_are_shared_out(spark, tmp_path, small_shares):
    path = tmp_path / "log"
    for _ in range(2):
        ledger.append_progress(_states(spark, 40_000), str(path))
    ledger.fold_tail(spark, str(path), PROGRESS_LOG, ledger._latest_progress, 1)
    assert len(list(next(path.glob("snapshot-*")).glob("states/*.parquet"))) > 1
    assert ledger.read_progress(spark, str(path)).count() == 40_000


def test_another_layout_has_more_tasks_for_larger_tables(spark, tmp_path):
    for t in TABLES:
        spark.range(600).withColumn("name", F.lit(t)).repartition(24).write.parquet(str(tmp_path / f"{t}.parquet"))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        out = checked.a8(spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert min(map(int, re.findall(r"RoundRobinPartitioning\((\d+)\)", plan))) >= 24
        assert {tuple(r) for r in out.collect()} == {(t, 600, True) for t in TABLES}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_bad_rows_are_made_once(spark):
    """What good and refused rows share is kept, and no more than the repeated keys' rows are compared."""
    rows = [(1, "a", 1), (1, "a", 1), (2, "b", 2), (2, "a", 3), (2, "a", 3), (None, "n", 0), (None, "n", 0), (3, "c", 1), (4, "d", 1)]
    made = {}
    keep = lambda df, label: made.setdefault(label, spark.createDataFrame(df.collect(), df.schema))
    good, refused = split_bad_rows(spark.createDataFrame(rows, "k int, v string, n int"), ["k"], spark.createDataFrame([(4,)], "k int"), keep=keep)
    assert sorted(map(tuple, good.collect())) == [(1, "a", 1), (2, "a", 3), (3, "c", 1)]
    assert sorted(map(tuple, refused.collect()), key=repr) == sorted(
        [(1, "a", 1, 1, "duplicate key"), (2, "a", 3, 1, "duplicate key"), (2, "b", 2, 1, "duplicate key"),
         (None, "n", 0, 2, "null key"), (4, "d", 1, 1, "key exists")], key=repr)
    assert sorted(made) == ["repeated", "rows"] and sorted(r.k for r in made["repeated"].collect()) == [1, 2]
