"""The apply operator against the sequential model, on random logs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ferrylog.functions.images import identity
from ferrylog.operators.components import component_labels, connected_components
from ferrylog.operators.fold import _chase, apply_changes
from tests.model import apply_bag, apply_keyed

ROW = "k bigint, v string, n int"
CHANGE = f"file string, pos bigint, row_no int, op string, before struct<{ROW.replace(' ', ':', 1).replace(', v ', ',v:').replace(', n ', ',n:')}>, after struct<k:bigint,v:string,n:int>"


def key(row):
    return row[0]


def random_rows(rnd, keys, unique=True):
    rows = [(k, rnd.choice("abc"), rnd.choice([None, 1, 2])) for k in range(keys) if rnd.random() < 0.7]
    return rows if unique else rows + [rnd.choice(rows) for _ in range(keys // 3)]


def random_log(rnd, rows, keys, size, moves=0.0, hot=None):
    """Changes whose images are mostly right (they follow a model run) and partly stale."""
    now, log = {key(r): r for r in rows}, []
    for _ in range(size):
        k = hot if hot is not None and rnd.random() < 0.4 else rnd.randrange(keys)
        row = (k, rnd.choice("abc"), rnd.choice([None, 1, 2]))
        before = now.get(k) if rnd.random() < 0.8 and k in now else (k, rnd.choice("abc"), rnd.choice([None, 1, 2]))
        op = rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        if op == "UPDATE" and rnd.random() < moves:
            row = (rnd.randrange(keys), *row[1:])
        change = (op, None if op == "INSERT" else before, None if op == "DELETE" else row)
        log.append(change)
        now = {key(r): r for r in apply_keyed(list(now.values()), [change], key)}
    return log


def run(spark, rows, log, keys, **options):
    target = spark.createDataFrame(rows, ROW)
    # Several changes share a position, as the rows of one event do.
    changes = [("f1" if i < len(log) // 2 else "f2", (i // 3) * 10, i % 3, *c) for i, c in enumerate(log)]
    out = apply_changes(target, spark.createDataFrame(changes, CHANGE), keys, **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("null_match", ["safe", "never"])
def test_keyed(spark, seed, null_match):
    rnd = random.Random(seed)
    rows = random_rows(rnd, 60)
    log = random_log(rnd, rows, 60, 500)
    assert run(spark, rows, log, ["k"], null_match=null_match) == apply_keyed(rows, log, key, null_match == "never")


@pytest.mark.parametrize("seed", [3, 4])
def test_hot_keys_in_pieces(spark, seed):
    rnd = random.Random(seed)
    rows = random_rows(rnd, 12)
    log = random_log(rnd, rows, 12, 400, hot=5)
    assert run(spark, rows, log, ["k"], hot_limit=10) == apply_keyed(rows, log, key)


@pytest.mark.parametrize("limit", [10_000, 25])
def test_moved_keys(spark, limit):
    """Tied keys in one go, and components too large for one task in halves."""
    rnd = random.Random(limit)
    rows = random_rows(rnd, 80)
    log = random_log(rnd, rows, 80, 160, moves=0.3)
    assert run(spark, rows, log, ["k"], hot_limit=limit) == apply_keyed(rows, log, key)


@pytest.mark.parametrize("null_match", ["safe", "never"])
def test_no_key(spark, null_match):
    rnd = random.Random(7)
    rows = random_rows(rnd, 20, unique=False)
    log = random_log(rnd, rows, 20, 250, moves=0.3)
    assert run(spark, rows, log, None, null_match=null_match) == apply_bag(rows, log, null_match == "never")


def test_replaying_a_log_twice_changes_nothing(spark):
    rows = [(1, "a", 1), (2, "b", None)]
    log = [("UPDATE", (1, "a", 1), (1, "b", 1)), ("UPDATE", (1, "b", 1), (1, "c", 2)),
           ("DELETE", (2, "b", None), None), ("INSERT", None, (3, "c", 1))]
    once = run(spark, rows, log, ["k"])
    assert run(spark, once, log, ["k"]) == once == [(1, "c", 2), (3, "c", 1)]


def test_any_cut_of_the_log_gives_the_same_table(spark):
    rnd = random.Random(11)
    rows = random_rows(rnd, 30)
    log = random_log(rnd, rows, 30, 120)
    middle = run(spark, rows, log[:50], ["k"])
    assert run(spark, middle, log[50:], ["k"]) == run(spark, rows, log, ["k"])


@pytest.mark.parametrize("keys", [["k"], None])
def test_empty_sides(spark, keys):
    """No changes, no rows, and changes that all miss, on every path."""
    rows, miss = [(1, "a", 1)], [("UPDATE", (1, "z", 1), (2, "z", 1)), ("DELETE", (1, "z", 1), None)]
    assert run(spark, rows, miss, keys, hot_limit=1) == rows
    assert run(spark, [], miss, keys, hot_limit=1) == []
    nothing = spark.createDataFrame([], CHANGE)
    assert apply_changes(spark.createDataFrame(rows, ROW), nothing, keys).count() == 1


def test_components(spark):
    path = [(f"p{i}", f"p{i + 1}") for i in range(40)]
    edges = path + [("x", "y"), ("y", "x"), ("z", "y")]
    out = connected_components(spark.createDataFrame(edges, "src string, dst string"))
    groups = {}
    for r in out.collect():
        groups.setdefault(r.component, set()).add(r.id)
    assert sorted(map(len, groups.values())) == [3, 41]



@pytest.mark.parametrize("limit", [1, 10_000])
def test_equality_is_one_on_every_path(spark, limit):
    """Local time that occurs twice, signed zeros and maps compare alike whatever the limit."""


    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        spark.sql(f"""SELECT k, timestamp_seconds(s) AS at, f, map('x', 1, 'y', 2) AS m,
            array(named_struct('t', timestamp_seconds(s), 'd', f)) AS a
            FROM VALUES (1L, 1762061400, 0.0D), (2L, 1762065000, 0.0D), (3L, 1762061400, 1.0D) AS v(k, s, f)""").createOrReplaceTempView("wide_rows")
        made = lambda k, s, f, keys: f"named_struct('k', {k}L, 'at', timestamp_seconds({s}), 'f', {f}D, 'm', {keys}, 'a', array(named_struct('t', timestamp_seconds({s}), 'd', {f}D)))"
        plain, turned = "map('x', 1, 'y', 2)", "map('y', 2, 'x', 1)"
        steps = [(made(1, 1762065000, "0.0", plain), made(1, 9, "7.0", plain)),      # the other 01:30: no hit
                 (made(2, 1762065000, "-0.0", turned), made(2, 9, "8.0", plain)),    # equal
                 (made(2, 9, "8.0", turned), made(2, 10, "9.0", plain)),
                 (made(3, 1762061400, "1.0", "map('x', 1, 'y', 3)"), made(3, 9, "7.0", plain))]  # another map: no hit
        log = spark.sql(" UNION ALL ".join(f"SELECT 'f' AS file, {i}L AS pos, 0 AS row_no, 'UPDATE' AS op, {b} AS before, {a} AS after"
                                           for i, (b, a) in enumerate(steps)))
        out = apply_changes(spark.table("wide_rows"), log, ["k"], hot_limit=limit)
        assert sorted((r.k, r.f) for r in out.select("k", "f").collect()) == [(1, 0.0), (2, 9.0), (3, 1.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("limit", [2, 10_000])
def test_null_keys_are_values(spark, limit):
    rows = [(None, "a", 1), (2, "b", 2)]
    log = [("UPDATE", (None, "a", 1), (None, "b", 1)), ("INSERT", None, (None, "c", 1)), ("UPDATE", (None, "b", 1), (None, "d", None)),
           ("DELETE", (2, "b", 2), None)]
    assert run(spark, rows, log, ["k"], hot_limit=limit) == apply_keyed(rows, log, key) == [(None, "d", None)]


@pytest.mark.parametrize("few", [0, 50])
def test_components_by_contraction(spark, few):
    """Long paths, a star, random edges, repeated and own ones: the same groups whatever is contracted first."""
    rnd = random.Random(few)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (201, 202), (202, 201), (201, 202)]
    edges += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    least = {n: n for e in edges for n in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(edges, "src long, dst long")
    found = {r.id: r.component for r in component_labels(df, few).collect()}
    assert found.keys() == least.keys() and all(least[n] == least[c] for n, c in found.items())
    assert len(set(found.values())) == len(set(least.values()))
    assert {r.id: r.component for r in connected_components(df).collect()} == least


@pytest.mark.parametrize("links", [1, 7, 1000])
def test_chains_over_runs_of_numbers(spark, links):
    rnd = random.Random(links)
    nodes = [(n, rnd.choice([None, *range(n + 1, min(n + 20, 300))]) if n < 299 else None) for n in range(1, 300)]
    ends = {}
    for n, to in reversed(nodes):
        ends[n] = n if to is None else ends[to]
    out = _chase(spark.createDataFrame(nodes, "n long, next long"), links).collect()
    assert len(out) == len(nodes) and {r.n: r.end for r in out} == ends


_WRITTEN = {
    # Pairs of keys that move to one new key; one key whose row changes all the time; rows without a key.
    "moved": ("named_struct('k', id, 'v', 'old', 'n', 1)", "named_struct('k', id div 2 + 1000000, 'v', 'new', 'n', 2)", ["k"], 220),
    "hot": ("named_struct('k', 0L, 'v', 'x', 'n', cast(id as int))", "named_struct('k', 0L, 'v', 'x', 'n', cast(id + 1 as int))", ["k"], 170),
    "no key": ("named_struct('k', id, 'v', 'old', 'n', 1)", "named_struct('k', id, 'v', 'new', 'n', 2)", None, 170),
}


@pytest.mark.parametrize("kind", _WRITTEN)
def test_bytes_written_for_a_change(spark, kind):
    """What goes to the shared folder, in bytes a change."""
    before, after, keys, most = _WRITTEN[kind]
    n, root = 30_000, spark.conf.get("spark.checkpoint.dir")
    size = lambda: sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(root) for f in files)
    log = spark.range(n).selectExpr("'f' AS file", "id AS pos", "0 AS row_no", "'UPDATE' AS op", f"{before} AS before", f"{after} AS after")
    rows = spark.range(1 if kind == "hot" else n).selectExpr("id AS k", "'x' AS v", "0 AS n") if kind == "hot" else spark.range(n).selectExpr("id AS k", "'old' AS v", "1 AS n")
    was = size()
    out = apply_changes(rows, log, keys, hot_limit=500)
    found = out.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).first()
    assert tuple(found) == {"moved": (n, n + n // 2), "hot": (1, n), "no key": (n, 2 * n)}[kind]
    assert (size() - was) / n < most


def test_digests_are_short(spark):
    """Digests are most of what a fold shuffles; equal images share one, others do not."""
    images = spark.sql("SELECT named_struct('k', id, 'v', CAST(id % 2 AS string)) AS i FROM range(50)").union(
        spark.sql("SELECT named_struct('k', 1L, 'v', '1')"))
    found = [bytes(r.d) for r in images.select(identity("i", images.schema["i"].dataType).alias("d")).collect()]
    assert {len(d) for d in found} == {16} and len(set(found)) == 50 and found[50] == found[1]
