"""Cutting and packing: ids against the library, sequences against their rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferrylog.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pieces_of(library, text, capacity=2048):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    return [(k, at, len(p), zlib.crc32(np.array(p, "<u4").tobytes()))
            for k, at in enumerate(range(0, len(ids), capacity)) for p in [ids[at:at + capacity]]]


def check_sequences(rows, capacity=2048):
    """Places without gaps, nothing over the capacity; returns the number of sequences."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rng = random.Random(1)
    letters = ["A", "é", "ß", "Σ", "İ", "́", "漢", "'s", "<|endoftext|>", "12", "!", "\xa0", "\x1c", " ", "\n", "ab", "½"]
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    odd += [None, "", "  ", "word " * 2047, "word " * 2048, "word " * 9000, "x" * 3000]
    docs = docs.union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    docs = docs.union(docs.where("doc_id = -3"))
    rows = packing.pack_documents(docs, PATH).collect()
    want = sorted((r.doc_id, *p) for r in docs.collect() for p in pieces_of(library, r.text))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    least = -(-sum(r.length for r in rows) // 2048)
    assert least <= check_sequences(rows) <= least * 1.02 + 1


def test_groups_are_joined(spark):
    rng = random.Random(2)
    sizes = [rng.randint(1, 60) for _ in range(3000)] + [100] * 20
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "id int, length long, part string")
    rows = packing.pack_pieces(df, 100, group=200).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    assert check_sequences(rows, 100) <= -(-sum(sizes) // 100) + 3


def test_leftovers_of_all_groups_meet(spark):
    """No sequence of three can be full, but each group leaves one that is emptier than it need be."""
    df = spark.range(600).selectExpr("id", "30L AS length")
    rows = packing.pack_pieces(df, 100, group=20).collect()
    assert sorted(r.id for r in rows) == list(range(600))
    assert check_sequences(rows, 100) == 200
    alone = packing.pack_pieces(spark.range(9).selectExpr("id", "60L AS length"), 100, group=2).collect()
    assert check_sequences(alone, 100) == 9
    pairs = packing.pack_pieces(spark.range(12).selectExpr("id", "20L AS length"), 100, group=1).collect()
    assert check_sequences(pairs, 100) == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, piece string")
    out = packing.pack_documents(df, PATH)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() == 0
    assert packing.cut_documents(df.union(df.select(F.lit(None), F.lit(None), F.lit(None))), PATH, with_ids=True).columns[-1] == "ids"


def optimum(sizes, capacity):
    """Fewest bins by trying all places."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_search_saves_bins():
    rng, better = random.Random(4), 0
    for _ in range(400):
        sizes = sorted((rng.randint(3, 20) for _ in range(11)), reverse=True)
        plain, searched = packing.best_fit(sizes, 30), packing.pack(sizes, 30)
        assert sorted(i for b in searched for i in b) == list(range(11))
        assert all(sum(sizes[i] for i in b) <= 30 for b in searched)
        assert optimum(sizes, 30) <= len(searched) <= len(plain)
        better += len(searched) < len(plain)
    assert better


def test_search_goes_on_while_it_gains():
    """One round without a gain ends the search here; the rounds before it are not counted."""
    for seed, low, bins in ((6, 20, 22), (26, 20, 21), (30, 10, 18)):
        rng = random.Random(seed)
        sizes = sorted((rng.randint(low, 45 if low == 20 else 50) for _ in range(60)), reverse=True)
        found = packing.pack(sizes, 100, rounds=1)
        assert sorted(i for b in found for i in b) == list(range(60)) and all(sum(sizes[i] for i in b) <= 100 for b in found)
        assert len(found) == bins < len(packing.best_fit(sizes, 100))


def test_a_change_raises_squared_fill():
    sizes = [9, 8, 5, 4, 3]
    pool = sorted([(9, 0), (5, 2)])
    gain, out, at = packing._improve([1], 1, pool, sizes)  # 8 out, 9 in
    assert (gain, out, pool[at][0]) == (1, (1,), 9)
    gain, out, at = packing._improve([3, 4], 2, [(9, 0)], sizes)  # two for one: 4 and 3 out, 9 in
    assert (gain, sorted(out)) == (2, [3, 4])
    gain, out, at = packing._improve([3], 6, [(5, 2)], sizes)  # a move
    assert (gain, out) == (5, ())


def test_pieces_keep_long_texts_whole(spark, library):
    text = " ".join(f"w{i}" for i in range(70000))
    rows = packing.cut_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).collect()
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_of(library, text)


def test_the_search_packs_the_given_documents(spark, sf_dir):
    """From documents as they come, the exchanges empty the bins: no more are left than best fit needs."""
    pieces = packing.cut_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH).where("length < 2048").orderBy("id", "piece")
    sizes, told = [r.length for r in pieces.collect()], {}
    found = packing.pack_group(sizes, told=told)
    assert sorted(i for b in found for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 2048 for b in found)
    assert told["exchanges"] > len(found) // 2 and told["emptied"] >= len(packing.as_they_come(sizes, 2048)) - len(found) > len(found) // 8
    longest = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    assert len(found) <= len(packing.best_fit([sizes[i] for i in longest], 2048)) <= -(-sum(sizes) // 2048) + 1


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(7, 60, "a", 1), (8, 50, "b", 2), (8, 40, "c", 3), (None, 100, "d", 4)], "__row long, length int, Offset string, __bin int")
    out = packing.pack_pieces(df, 100)
    assert out.columns == ["__row", "length", "__bin", "sequence_id", "offset"]
    assert sorted((r["__bin"], r["__row"], r["length"]) for r in out.collect()) == [(1, 7, 60), (2, 8, 50), (3, 8, 40), (4, None, 100)]
    assert check_sequences(out.collect(), 100) == 3


def test_words_at_the_edges_of_texts(library):
    vocabulary = packing.WordVocabulary(PATH)
    texts = ["one", "", "Two.three", "É×à÷b", "..", "a.", ". b!", " ÀÞ\x0bß?", "x\u0301 y", "'s it's", "12ab", "ÿ", "<|endoftext|>."]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    ids, ends = vocabulary.encode_texts(data, offsets, 0)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_memory_of_words_is_bounded():
    asked = []
    memory = packing.Remembered(lambda new: asked.append(len(new)) or [x + x for x in new], 8)
    for k in range(40):
        tokens = [b"%d" % i for i in range(k, k + 3)]
        assert memory(tokens) == [t + t for t in tokens] and len(memory.young) + len(memory.old) <= 12
    assert sum(asked) < 60
