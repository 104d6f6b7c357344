"""Quality measures and distances against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from ferrylog.llm import quality
from ferrylog.llm.words import _BYTE, PIECE, span_hashes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, repeated = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2)), set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i:i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def texts(seed=1, n=150):
    rng = random.Random(seed)
    parts = ["a", "bé", "c#", "ÄÖ", " ", "  ", "\n", "\t", "\r\n", "漢字", "x|y", "the end", "\x1c", "1.5"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, rng.choice((60, 600))))) for _ in range(n)]
    return out + ["", None, "\n\n", "a\na\n a\na", "x" * (PIECE + 50) + "\n" + "x" * (PIECE + 50) + "\nx", "one two three " * 30]


def test_measures(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality_report(df).collect()}
    for i, t in rows:
        want = slow(t)
        assert tuple(got[i][k] for k in quality._MEASURES) == want, t
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[i].kept and got[i].base_failed)


def divergence(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    return math.sqrt((kl(p) + kl(q)) / 2)


def test_distances(spark):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(texts(2))]
    refs = quality.references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [r[0] for r in refs] == ["en", "fr"]
    for lang, by_class, cells, by_word in quality._raw_references(
            spark.createDataFrame([(x, t) for _, t, x in rows if t is not None], "lang string, text string")):
        count = Counter()
        for _, t, x in rows:
            raw = (t or "").encode()
            if x == lang and len(raw.split()) >= quality.MIN_WORDS:
                hashes = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), quality._FOLD).hash
                for cell, k in Counter(quality._word_class(hashes).tolist()).items():
                    count[cell] += k * (10**6 // len(hashes))
        total = sum(count.values())
        assert dict(zip(cells.tolist(), by_word.tolist())) == {k: n / total for k, n in count.items() if n >= quality.COMMON * total}
        assert abs(by_class.sum() - 1) < 1e-9
    sample = [t.encode() for _, t, _ in rows[:40]]
    data, offsets = np.frombuffer(b"".join(sample), np.uint8), np.cumsum([0, *map(len, sample)])
    _, classes, words = quality.measure(data, offsets)
    for ref in refs:
        by_class, by_word = quality.distances(classes, words, ref)
        for i, t in enumerate(sample):
            if t:
                chars = classes[i] / classes[i].sum()
                assert abs(divergence(chars, ref[1]) - by_class[i]) < 1e-6
            own = Counter(quality._word_class(words.hash[words.doc == i]).tolist())
            n = sum(own.values())
            if n:
                p = [own.get(c, 0) / n for c in ref[2].tolist()]
                q = ref[3].tolist()
                assert abs(divergence([*p, 1 - sum(p)], [*q, 1 - sum(q)]) - by_word[i]) < 1e-6


def test_labelled_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    done = quality.quality_report(docs).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert done[done.quality == 1].kept.mean() > 0.97
    assert done[done.quality == 0].kept.mean() < 0.2


def test_edges(spark):
    df = spark.createDataFrame([(1, "word " * 3, None, 5), (1, "word " * 3, None, 5), (None, None, "en", 6)],
                               "doc_id long, text string, lang string, kept int")
    assert quality.quality_report(df).count() == 3 and quality.good_documents(df).columns == df.columns
    assert quality.quality_report(df.limit(0)).count() == 0


def test_span_hashes():
    data = np.frombuffer(b"abcabcxabc" + b"z" * (2 * PIECE + 3) + b"z" * (2 * PIECE + 3), np.uint8)
    end = 10 + 2 * PIECE + 3
    h = span_hashes(data, np.array([0, 3, 6, 7, 10, end]), np.array([3, 6, 7, 10, end, 2 * end - 10]))
    assert h[0] == h[1] == h[3] and h[4] == h[5] and len(set(h.tolist())) == 3 and len(_BYTE) == 256
