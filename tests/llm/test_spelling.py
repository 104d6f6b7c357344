"""Spelling variants against a plain count and a plain comparison of all words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrylog.llm import spelling


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_counts(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(n):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of_words():
    rng = np.random.default_rng(5)
    stems = ["zebra", "reader", "reading", "treading", "écoles", "ÿaÿaÿ", "abcdefghij" * 30, "rating", "ratings", "gratings"]
    rows = []
    for i in range(900):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.exponential(2.5)), len(stems) - 1)]
            if rng.random() < 0.2:
                at = int(rng.integers(len(w)))
                w = w[:at] + rng.choice(["", "x", "é", "E"]) + w[at + int(rng.integers(2)):]
            words.append(w.upper() if rng.random() < 0.05 else w)
        rows.append((i, "  ".join(words) + rng.choice(["", ".", "×÷", "1"])))
    return rows + [(None, "null reader reader"), (None, None), (7, ""), (8, "reader" * 200000 + " reader"), (8, "ĀreaderĀrëader ÿaÿaÿ")]


def test_against_plain(spark):
    rows = rows_of_words()
    n = plain_counts(rows)
    df = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, n long, Form string").repartition(5)
    got = spelling.spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(n)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 300 and any(r[2] not in (r[0], r[1]) for r in want)


@pytest.mark.parametrize("block", [2, 7, 64, 5000])
def test_tiles_of_any_size(spark, block, monkeypatch):
    monkeypatch.setattr(spelling, "AT_ONCE", 64 if block == 7 else spelling.AT_ONCE)
    rng = np.random.default_rng(block)
    words = {"".join(rng.choice(list("abé"), int(rng.integers(5, 9)))) for _ in range(500)}
    n = {w: int(rng.integers(3, 40)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in spelling.near_words(df, block).collect()}
    want = {w: [v for v in n if is_near(w, v)] for w in n}
    assert got == {w: (len(v), min(v, key=lambda x: (-n[x], x))) for w, v in want.items() if v}


def test_checksums():
    rng = np.random.default_rng(1)
    first = [rng.bytes(int(rng.integers(0, 30))) for _ in range(200)]
    second = [rng.bytes(int(rng.integers(1, 256))) for _ in range(200)]
    offsets = np.append(0, np.cumsum([len(x) for x in second]))
    crc = spelling._crc_of_words(np.frombuffer(b"".join(second), np.uint8), offsets)
    assert crc.tolist() == [zlib.crc32(x) for x in second]
    joined = spelling.joined_crc(np.array([zlib.crc32(x) for x in first], np.uint32), crc, np.diff(offsets))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(first, second)]


def test_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "a b c"), (None, "")], "doc_id long, text string")
    assert spelling.spelling_variants(df).count() == 0 and spelling.spelling_variants(df.limit(0)).count() == 0
    many = spark.range(4).select("id", F.lit("single").alias("text")).withColumnRenamed("id", "doc_id")
    assert [tuple(r) for r in spelling.spelling_variants(many).collect()] == [("single", None, "single", 4, 0, None)]
