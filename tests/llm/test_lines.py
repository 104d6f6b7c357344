"""Line deduplication against a plain pass over all lines."""

import hashlib

import pytest

from ferrylog.llm import lines

SPACE = " \t\n\x0b\f\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(rows):
    """``rows`` of ``(id, text)``: kept text, lines and dropped lines of each."""
    def rank(i):
        return (i is not None, i)

    holder = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(SPACE))
            if len(key) >= 10:
                holder[key] = min(holder.get(key, i), i, key=rank)
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if holder.get(lower(x.strip(SPACE)), i) == i]
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (5, "A line that repeats\nown line of five\n  a LINE that repeats \t\nshort\n"), (2, "short\na line that repeats\nx"),
    (3, None), (4, ""), (9, "\n\n"), (7, "a line that repeats"), (8, "ÀÉ line of accents\nàé line of accents\nÀÉ LINE of accents"),
    (10, "àé line of accents\nÀÉ Line Of accents\r"), (11, "a line that repeats\n a line that repeats"),
    (12, "a line that repeats\nnew words here\nA line that repeats\nA line that repeats\nlast words here"),
    (12, "new words here\nanother row of twelve"), (12, "new words here\nanother row of twelve"), (13, "another row of twelve\n\n"),
    (None, "nobody's line here\nlast words here"), (None, "nobody's line here"), (14, "nobody's line here\nkept"),
    (15, "0123456789\n012345678"), (16, "0123456789\n012345678\n" + "long " * 100000), (17, "x\n" + "LONG " * 100000),
    (18, "\n".join(f"line number {i}" for i in range(5000))), (19, "\n".join(f"LINE number {2 * i}" for i in range(5000))),
]


@pytest.mark.parametrize("share", [lines.HOT_SHARE, 1 << 14, 3])
def test_against_a_plain_pass(spark, monkeypatch, share):
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in lines.digest(df).collect()), key=repr) == plain(ROWS)


def test_hot_lines_stay_in_place(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('The same line everywhere\n', 'own line ', id) AS text")
    entries = lines._entries(df)
    assert len(lines._hot_hashes(entries)) == 1
    out = lines.dedup_lines(df).groupBy("n_dropped").count().collect()
    assert {r.n_dropped: r["count"] for r in out} == {0: 1, 1: 2999}


def test_other_columns(spark):
    rows = [(1, "the same line here", "a", 7, 8, "f"), (2, "the same line here\nrest", "b", 7, 8, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, flips string, N_Lines long, version long, __id string")
    out = lines.dedup_lines(df)
    assert out.columns == ["doc_id", "flips", "version", "__id", "text", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 8, "f", "the same line here", 1, 0), (2, "b", 8, "g", "rest", 2, 1)]
    assert lines.digest(df.limit(0)).count() == 0
    assert lines.keep_bitmaps(df).select("doc_id", "n_dropped", "flips").collect()[0] == (2, 1, [0, 1])


def test_no_python_in_the_plan(spark, sf_dir):
    df = lines.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct"))
