"""Removal of repeated passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferrylog.llm import exchange, repeats
from ferrylog.llm.words import words_of


def words(text):
    return [] if text is None else text.encode().split()


def brute_force(rows, size=13):
    """Expected ``(id, words, removed, kept)`` per row."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i:i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def check(spark, rows, size=13, buckets=7):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(df, window=size, buckets=buckets).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(brute_force(rows, size), key=key)


def passages(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice((3, 40, 3000)))]
    shared = [[rng.choice(vocabulary) for _ in range(rng.choice((12, 13, 14, 30)))] for _ in range(6)]
    rows = []
    for doc in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(shared) if rng.random() < .5 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
        rows.append((doc * 3 - 30, rng.choice((" ", "\n", " \t")).join(w)))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_passages_in_random_texts(spark, seed):
    check(spark, passages(seed))


def test_edges(spark):
    long = " ".join(f"x{i % 50}" for i in range(60000))
    run = " ".join(["same"] * 200)
    rows = [(5, None), (6, ""), (7, " \n"), (8, run), (9, run + " end"), (3, "a b"), (10, long), (11, long[:5000]),
            (None, run), (None, None), (12, "é ß " * 20), (13, "é ß " * 20), (13, "é ß " * 20), (1, "\x1c\x85 " * 15), (2, "\x1c\x85 " * 15)]
    check(spark, rows)
    check(spark, rows, size=3, buckets=1)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_words string, lang string")
    out = repeats.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "lang", "n_words", "n_removed", "kept_text"] and out.count() == 0


def test_document_buckets_are_those_of_spark(spark):
    ids = [0, 1, -5, 2**62, -2**63, 123456789]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.pmod(F.xxhash64("i"), F.lit(97)).alias("b")).collect()
    assert [r.b for r in got] == exchange.doc_bucket(np.array(ids), 97).tolist()


def test_equal_windows_have_equal_keys():
    texts = [t.encode() for _, t in passages(11, 400)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    w = words_of(data, np.cumsum([0, *map(len, texts)]))
    at, keys = repeats.window_keys(w)
    seen = {}
    for a, k in zip(at.tolist(), keys.tolist()):
        assert seen.setdefault(tuple(w.hash[a:a + 13].tolist()), k) == k
    assert len(np.unique(keys)) < 0.8 * len(seen)


def test_words_are_those_of_bytes_split():
    texts = [b"", b" a", b"a ", b"ab\x0bcd\tef", "é  x y \x1c".encode(), b"x" * 1000, b"  ", b"q"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    w = words_of(data, np.cumsum([0, *map(len, texts)]))
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(w.start, w.end)] == [x for t in texts for x in t.split()]
    assert np.diff(w.first).tolist() == [len(t.split()) for t in texts]
    assert len(np.unique(w.hash)) == len({x for t in texts for x in t.split()})
    assert pa.array(w.doc).to_pylist() == [i for i, t in enumerate(texts) for _ in t.split()]
