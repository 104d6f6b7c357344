"""Key ranges and deep pages against plain sorting."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from checks.inputs import table
from ferrylog.operators import ranges
from ferrylog.operators.copying import resume_after
from ferrylog.plans.copy import CopyConfig, FolderTarget, full_copy
from ferrylog.sinks.ledger import append_progress, read_progress
from ferrylog.sources.tables import DirectorySource
from tests.test_jobs import FailingTarget, rows_of


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_returnflag END AS `a b`", "l_orderkey % 50 AS n",
        "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_shipdate END AS at", "monotonically_increasing_id() AS id").cache()


@pytest.mark.parametrize("descending", [(), ("a b",), ("n", "at")])
def test_ranges_cover_every_row_once_in_order(lines, descending):
    keys = ["a b", "n", "at"]
    cuts = ranges.key_cuts(lines, keys, 7, lines.count(), descending)
    assert 3 <= len(cuts) <= 6
    found = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = lines.where(ranges.between(lines, keys, low, high, descending))
        found += [r.id for r in part.orderBy(*ranges.key_order(keys, descending), "id").collect()]
    assert found == [r.id for r in lines.orderBy(*ranges.key_order(keys, descending), "id").collect()]


def test_bounds_of_all_types_come_back(spark):
    row = (True, 7, -2.5, decimal.Decimal("-1.20"), "a'\\\n\0", bytearray(b"\0\xff"), datetime.date(1, 2, 3),
           datetime.datetime(2024, 11, 3, 1, 30, 0, 5), datetime.datetime(1900, 1, 1))
    df = spark.createDataFrame([row, (None,) * 9], "a boolean, b smallint, c double, d decimal(10,2), e string, "
                                                   "f binary, g date, h timestamp, i timestamp_ntz")
    for key in df.columns:
        for text in df.select(*ranges.key_texts(df, [key])).collect():
            values = ranges.bound_values(df, [key], list(text))
            assert df.where(ranges.up_to([key], values) & ~F.coalesce(ranges.past([key], values), F.lit(False))).count() >= 1
            before = df.where(ranges.up_to([key], values)).count()
            assert before == (1 if text[0] is None else 2)
            assert before + df.where(ranges.past([key], values)).count() == 2


def test_comparisons_reach_the_scan(spark, sf_dir):
    df = resume_after(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [7000, 2])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThan(l_orderkey,7000)" in pushed and "GreaterThan(l_linenumber,2)" in pushed


@pytest.mark.parametrize("page", [1, 2, 40, 120, 10_000])
def test_deep_pages_equal_offset(lines, page):
    keys = ["n", "a b", "id"]
    got = ranges.ordered_page(lines, keys, page, 50, ["n"], range_rows=100, fan=5)
    plain = lines.orderBy(*ranges.key_order(keys, ["n"])).offset((page - 1) * 50).limit(50)
    assert [r.id for r in got.collect()] == [r.id for r in plain.collect()]


def test_deep_pages_of_one_hot_key_and_of_nothing(spark):
    hot = spark.range(500).select(F.lit(1).alias("k"), "id")
    assert ranges.ordered_page(hot, ["k"], 3, 100, range_rows=10).count() == 100
    assert ranges.ordered_page(hot.limit(0), ["k"], 1, 100, range_rows=10).count() == 0


def test_text_keys_stop_and_resume(spark, sf_dir, tmp_path):
    table(spark, sf_dir, "orders").selectExpr("concat(o_orderpriority, ':', o_orderkey) AS name", "o_totalprice").write.parquet(str(tmp_path / "src/t.parquet"))
    source = DirectorySource(spark, str(tmp_path / "src"), keys={"t": ["name"]})
    cfg = CopyConfig(str(tmp_path / "ledger"), ranges=5)
    with pytest.raises(OSError):
        full_copy(spark, source, FailingTarget(spark, str(tmp_path / "t"), 4), cfg)
    state, target = read_progress(spark, cfg.ledger_path).first(), FolderTarget(spark, str(tmp_path / "t"))
    assert state.status == "FAILED" and state.last_migrated_key and state.last_migrated_id is None
    assert target.read("t").count() == state.migrated_rows > 0
    result = full_copy(spark, source, target, cfg).first()
    assert (result.copied, result.refused) == (state.total_rows, 0)
    assert rows_of(target.read("t")) == rows_of(source.read("t"))


def test_a_number_of_an_older_ledger_still_bounds_a_wider_key(spark, tmp_path):
    rows = spark.range(100).selectExpr("id div 10 AS a", "id % 10 AS b")
    rows.write.parquet(str(tmp_path / "src/t.parquet"))
    target, cfg = FolderTarget(spark, str(tmp_path / "t")), CopyConfig(str(tmp_path / "ledger"), ranges=3)
    target.write(rows.where("a <= 4"), "t", 1000)
    append_progress(spark.createDataFrame(
        [("t", 100, 50, 4, "IN_PROGRESS", None)],
        "table_name string, total_rows long, migrated_rows long, last_migrated_id long, status string, error_message string"
    ).withColumns({c: F.current_timestamp() for c in ("start_time", "last_update_time", "complete_time")}), cfg.ledger_path)
    result = full_copy(spark, DirectorySource(spark, str(tmp_path / "src"), keys={"t": ["a", "b"]}), target, cfg).first()
    assert (result.copied, result.refused) == (100, 0)
    assert rows_of(target.read("t")) == rows_of(rows)
