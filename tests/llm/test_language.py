"""Language identification: code lengths against a model of dictionaries, and held-out accuracy."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ferrylog.llm import language
from ferrylog.llm.words import PIECE


def folded(text):
    out = []
    for b in text.encode():
        s = int(language._FOLD[b])
        if not (out and s == out[-1] == 32):
            out.append(s)
    return out


class Slow:
    """Prediction by partial matching with escapes, one symbol at a time."""

    def __init__(self, texts, order, alphabet):
        self.order, self.alphabet, self.count = order, alphabet, defaultdict(lambda: defaultdict(int))
        for t in texts:
            s = [32] * order + folded(t)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.count[tuple(s[i - k:i])][s[i]] += 1

    def p(self, context, symbol):
        c = self.count.get(context)
        shorter = (lambda: self.p(context[1:], symbol)) if context else (lambda: 1 / max(self.alphabet, 2))
        if c is None:
            return shorter()
        n, d = sum(c.values()), len(c)
        return c[symbol] / (n + d) if symbol in c else d / (n + d) * shorter()

    def bits(self, text):
        s = [32] * self.order + folded(text)
        return -sum(math.log2(self.p(tuple(s[i - self.order:i]), s[i])) for i in range(self.order, len(s)))


def test_code_lengths(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    kinds = {"aa": "abcdé", "bb": "abxyzß"}
    rows = [(i, lang, " ".join(word(kinds[lang]) for _ in range(rng.randint(0, 30))) + "!! 12\n")
            for i, lang in enumerate(sorted(kinds) * 20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.train(df, sample=10**6)
    slow = [Slow([t for _, x, t in rows if x == lang], 3, model.size) for lang in model.languages]
    texts = ["", "abc", "ABxyz zzz", "é q?", "unseen 漢字 bytes", " ".join(t for _, _, t in rows)]
    raw = [t.encode() for t in texts]
    bits, _ = model.code_lengths(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    want = [[s.bits(t) for s in slow] for t in texts]
    seen = {b for _, _, t in rows for b in folded(t)}
    for t, got, expected in zip(texts, bits, want):
        if set(folded(t)) <= seen:
            assert np.allclose(got, expected, rtol=1e-5), t
        else:  # unseen bytes share a symbol; in a context after one, nothing is known
            assert (got > 0).all()


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(done) > 20 and (done["lang"] == done["lang_pred"]).mean() > 0.97
    assert done["score"].between(0, 1).all()


def test_prediction_never_reads_the_label(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (language.identify(d).orderBy("doc_id").collect() for d in (docs, other))
    assert a == b


def test_edges(spark):
    rows = [(1, "hello there", "en", "x"), (2, None, "en", "x"), (3, "", None, "x"), (4, "123 !!", "en", "x"),
            (5, "hallo du", "de", "x"), (5, "hallo du", "de", "x"), (None, "hello", "en", "x"), (6, "a" * 700000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = {(r.doc_id, r.lang_pred) for r in language.identify(df).collect()}
    assert {i for i, x in out if x == "und"} == {2, 3, 4} and language.identify(df).count() == len(rows)
    kept = language.known_language(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 5, None, 6}
    none = df.limit(0)
    assert language.identify(none).count() == 0 and language.known_language(none).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_texts_do_not_come_back(spark):
    """Python gets the texts and gives ids and predictions, not the texts too."""
    df = spark.createDataFrame([(i, f"hello there {i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    plan = language.identify(df)._jdf.queryExecution().optimizedPlan().toString()
    given = re.search(r"MapInArrow [^\n]*, \[([^\]]*)\]", plan)[1]
    assert re.findall(r"(\w+)#", given) == ["doc_id", "lang_pred", "score", "bits_per_symbol"]


def test_rows_come_back_in_slices(spark, monkeypatch):
    """A batch of long texts is answered in parts of a bounded size, each row once and in its place."""
    rows = [(i, "hello there and more " * (1 + i % 3 * 15000), "en", [i, i + 1]) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, more array<long>")
    model, ran = language.train(df), []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: ran.append(run))
    language.predict(df, model)
    monkeypatch.undo()
    columns = [pa.array(c) for c in (*zip(*rows), [True] * len(rows))]
    parts = list(ran[0](iter([pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "lang", "more", "__letter"])])))
    assert [tuple(r[c] for c in df.columns) for p in parts for r in p.to_pylist()] == rows
    assert all(p.num_rows == 1 or sum(len(t) for t in p["text"].to_pylist()) <= PIECE for p in parts) and len(parts) > 3
    whole = language.predict(df, model).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in whole] == [(x["lang_pred"], x["score"]) for p in parts for x in p.to_pylist()]
    few = language.predict(df, model, columns=["more", "doc_id"])
    assert few.columns == ["doc_id", "more", "lang_pred", "score", "bits_per_symbol"]
    assert [tuple(r)[:2] for r in few.orderBy("doc_id").collect()] == [(i, m) for i, *_, m in rows]


def test_letters_anywhere(spark):
    """A letter counts wherever it stands; digits, marks and nulls are none."""
    texts = ["a", "1" * 63 + "a", "1" * 64 + "a", "\u00e4" * 70, "- " * 500 + "\u6f22", "\U0001f600" * 64 + "z", "\U0001f600" * 80,
             "12 !! " * 50, "\u0301" * 70, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r[0] for r in df.orderBy("i").select(language._has_letter("text")).collect()]
    assert got == [any(c.isalpha() for c in t or "") for t in texts] == [True] * 6 + [False] * 5
