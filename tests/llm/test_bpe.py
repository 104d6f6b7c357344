"""Byte-pair encoding against the library, and an exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ferrylog.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = list("ab  \n\t'sdtre1²½é\x1c\x85\xa0　​😀ſ!?.,<|>Σﬁ한") + ["́", " the", "<|endoftext|>"]


def odd_texts(seed, n):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["a" * 5000, "ab" * 700, "\n" * 900, " " * 400 + "x", "", " lead", "  lead", "x\t y", "qz" * 12000]


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(-1 - i, t) for i, t in enumerate([None, *odd_texts(1, 400)])]
    docs = docs.union(spark.createDataFrame(odd + odd[:3], "doc_id long, text string"))
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digest(docs, PATH, PATTERN).collect())) == sorted(want)


def test_one_and_many_trees_agree():
    rng = random.Random(3)
    table = bpe.RankVocabulary(PATH, PATTERN).table
    sequences = [[rng.randrange(256) for _ in range(rng.randint(1, 90))] for _ in range(300)]
    flat = np.array([s for q in sequences for s in q], np.int64)
    many = bpe.merge_many(flat, np.array(list(map(len, sequences))), table)
    assert [np.frombuffer(m, "<u4").tolist() for m in many] == [bpe.merge_one(list(q), table) for q in sequences]


def plain_merge(symbols, table):
    """Leftmost pair of least rank by looking at all pairs each time."""
    symbols = list(symbols)
    while True:
        rows = [table.get(a, b) for a, b in zip(symbols, symbols[1:])]
        ranked = [(int(table.rank[r]), i) for i, r in enumerate(rows) if r >= 0]
        if not ranked:
            return symbols
        _, i = min(ranked)
        symbols[i:i + 2] = [int(table.product[rows[i]])]


def test_merges_are_those_of_a_plain_search():
    rng = random.Random(4)
    table = bpe.RankVocabulary(PATH, PATTERN).table
    for _ in range(200):
        symbols = [rng.choice((0, 1, 2, 64, 65, 220, 83, 258)) for _ in range(rng.randint(1, 40))]
        assert bpe.merge_one(list(symbols), table) == plain_merge(symbols, table)


def test_a_full_memory_is_emptied():
    memo = bpe.Memo(lambda new: [x.upper() for x in new], limit=3)
    for wanted in (["a", "b"], ["b", "c", "d"], ["a"], ["e", "f", "g", "h", "i"]):
        known = memo.learn(wanted)
        assert all(known[w] == w.upper() for w in wanted) and len(known) <= max(3, len(wanted))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, ids string, decoded int")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"] and out.count() == 0
