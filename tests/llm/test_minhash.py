"""Near duplicates against brute force over all pairs."""

import pathlib
import random

import numpy as np
import pytest

from ferrylog.llm import minhash
from ferrylog.operators.components import connected_components
from ferrylog.session import scratch_root


def shingles(text):
    w = [] if text is None else text.encode().translate(bytes(minhash._FOLD)).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(rows, threshold=75):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(((i is None, i or 0, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets),
                  key=repr)


def check(spark, rows):
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=repr)
    assert got == brute_force(rows)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_copies(spark, seed):
    rng = random.Random(seed)
    texts = [t for _ in range(8) for t in family(rng, 14, rng.choice((30, 80, 200)), 5)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for _ in range(30)] + texts[:6]
    rng.shuffle(texts)
    check(spark, [(i * 7 - 50, t) for i, t in enumerate(texts)])


def test_one_large_group(spark):
    rng = random.Random(5)
    texts = family(rng, 160, 60, 4)  # many pairs lie below the similarity and are linked through others only
    check(spark, list(enumerate(texts)))


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(50000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (6, "two one"), (7, "É é"), (8, "é é"), (9, long),
            (10, long + " tail"), (11, "a b c d e"), (11, "a b c d e"), (12, long), (None, long), (None, None),
            (13, "q w e r t"), (14, "p o i u y"), (20, "q w e r t"), (20, "p o i u y")]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, cls string, n string, bucket int")
    assert minhash.near_duplicates(df).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert minhash.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", "y", 3)], "doc_id long, text string, cls string, n string, bucket int")
    assert minhash.near_duplicates(df).count() == 1


def test_signature_estimates_similarity():
    rng = random.Random(3)
    a, b = family(rng, 2, 600, 0)[0].split(), None
    b = a[:450] + [f"z{i}" for i in range(150)]
    raw = [" ".join(a).encode(), " ".join(b).encode()]
    data = np.frombuffer(b"".join(raw), np.uint8)
    values, first = minhash.shingle_sets(data, np.cumsum([0, *map(len, raw)]))
    sig = minhash.signatures(values, first, 512)
    x, y = shingles(raw[0].decode()), shingles(raw[1].decode())
    assert abs((sig[0] == sig[1]).mean() - len(x & y) / len(x | y)) < 0.07
    assert [b - a for a, b in zip(first, first[1:])] == [len(x), len(y)]


def test_few_links_are_labelled_in_few_tasks(spark):
    """Rounds over few rows write few files, also where shuffles are not coalesced."""
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    written = lambda: set(pathlib.Path(scratch_root(spark).removeprefix("file:")).glob("ferrylog/labels-*"))
    before = written()
    usual = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        edges = spark.createDataFrame([(10 * (i % 3) + 100 * i, 10 * (i % 3) + 100 * (i + 3)) for i in range(300)], "src long, dst long")
        found = {r.id: r.component for r in connected_components(edges).collect()}
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert found == {10 * (i % 3) + 100 * i: 110 * (i % 3) for i in range(303)}
    rounds = [len(list(x.glob("part-*"))) for x in written() - before]
    assert rounds and max(rounds) <= spark.sparkContext.defaultParallelism
