"""Token counts against the library on whole texts."""

import random

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferrylog.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD = ["a", "bc ", " ", "  ", "\n", "\t", "don't", "é", "漢字", "́", "<|endoftext|>", "<|endo", "1", "23", "!!", "\xa0", "\x1c", "😀", "the "]


def test_chunks_are_spliced(library):
    rng = random.Random(1)
    starts = lambda t: [a for a, _ in library.encode(t, add_special_tokens=False).offsets]
    for chunk, overlap in ((40, 5), (64, 16), (7, 2)):
        for _ in range(150):
            text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 200)))
            assert token_counts.Chunked(starts, chunk, overlap).count(text) == count(library, text)


def test_overlaps_widen_where_nothing_aligns(library):
    starts = lambda t: [a for a, _ in library.encode(t, add_special_tokens=False).offsets]
    chunked = token_counts.Chunked(starts, 50, 4)
    text = "word " * 30 + "x" * 400 + " tail" * 40 + "\n" * 300 + "end"
    assert chunked.count(text) == count(library, text) and chunked.widened > 0


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(2)
    odd = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 80))) for _ in range(200)]
    odd += [None, "", " ", "long text " * 9000, "y" * 70000, "<|endoftext|>" * 3]
    odd = spark.createDataFrame([(-i, t) for i, t in enumerate(odd)] + [(1, "again"), (1, "again")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(odd)
    got = token_counts.token_report(docs, PATH).collect()
    want = sorted((r.doc_id, len((r.text or "").encode()), n := count(library, r.text), n > 512) for r in docs.collect())
    assert sorted(map(tuple, got)) == want


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_tokens string")
    out = token_counts.count_tokens(df, PATH)
    assert out.columns == ["doc_id", "text", "n_tokens"] and out.count() == 0
    assert token_counts.count_tokens(df.union(df.select(F.lit(1), F.lit("a b"), F.lit("x"))), PATH).count() == 0


@pytest.mark.parametrize("huge, chunk, overlap", [(1, 300, 20), (200, 100, 8), (1 << 30, 1 << 12, 256)])
def test_any_chunks_give_the_same_counts(spark, sf_dir, library, huge, chunk, overlap):
    """Of all documents, as if every one were huge; and none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH, huge=huge, chunk=chunk, overlap=overlap).collect()}
    assert got == {r.doc_id: count(library, r.text) for r in docs.collect()}
