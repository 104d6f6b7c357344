"""Quality rules by distribution divergence.

Each language has a reference: the mean share of each character class and of each
common word in its documents. A document is compared with the references by the
Jensen-Shannon distance (0 to 1), and fails a rule when it is too far from the one
with the nearest common words. A histogram of few words differs by chance: the limits
grow as texts get shorter, and below a least length the rules say nothing.

Words are counted by 16-bit classes of their hash with A-Z as a-z. The common words
of a language are the classes that hold at least ``COMMON`` of its words - at most
``1 / COMMON`` of them - and the rest are one class. So the counts cover all
documents and have one fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ferrylog.llm.minhash import _FOLD
from ferrylog.llm.rows import keep_rows
from ferrylog.llm.words import mix, seen_before, slices, span_hashes, text_buffers, windows, words_of

#: Share of a language's words from which a word is common.
COMMON = 0.004
#: Least number of words for the rules, and the greatest distances of n words as ``a + b / sqrt(n)``:
#: the second part is what chance alone does to a histogram of few words.
MIN_WORDS = 50
CLASS_LIMIT, WORD_LIMIT = (0.16, 0.9), (0.10, 2.1)
_U = np.uint64
_BITS = 16
_ONE = 10**6

# The symbols that are counted.
SYMBOLS = b"#*$%&|<>"
# Character classes: lower and upper case, digits, white space, plain punctuation, other ASCII, other characters.
_CLASSES = 7
_CLASS = np.full(256, 5, np.uint8)
_CLASS[0x80:] = 6
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[list(b".,;:'\"()-?!")] = 4
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags, local):
    """Sum of ``flags`` in each text."""
    total = np.append(0, np.cumsum(flags))
    return total[local[1:]] - total[local[:-1]]


def _duplicate_lines(data, offsets, words):
    """Lines with a word that equal an earlier line of their text, per text."""
    part = data[offsets[0]:offsets[-1]]
    local, n = offsets - offsets[0], len(offsets) - 1
    breaks = np.flatnonzero(part == 10)
    start = np.union1d(local[:-1], breaks + 1)
    start = start[start < len(part)]
    doc = np.searchsorted(local, start, "right") - 1
    end = np.minimum(np.append(start[1:], len(part)), local[doc + 1])
    end = np.where((end > start) & (part[np.maximum(end - 1, 0)] == 10), end - 1, end)
    has = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, doc = start[has], end[has], doc[has]
    if not len(start):
        return np.zeros(n, np.int64)
    earlier, _ = seen_before(doc, span_hashes(part, start, end))
    return np.bincount(doc[earlier], minlength=n)


def measure(data, offsets):
    """``(measures, class histogram, words)`` of each text in ``data[offsets[0]:offsets[-1]]``."""
    n = len(offsets) - 1
    part, local = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    classes, words = histograms(data, offsets)
    chars = classes.sum(1) - classes[:, 3]
    symbols = _per_text(_SYMBOL[part], local)
    exact = words_of(data, offsets)
    at, values = windows(exact, 3)
    _, again = seen_before(exact.doc[at], values)
    cover = np.zeros(len(exact.hash) + 3, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 3, -1)
    repeated = exact.doc[np.cumsum(cover[:len(exact.hash)]) > 0]
    numbers = np.stack([np.diff(words.first), chars, symbols, _duplicate_lines(data, offsets, exact),
                        np.bincount(repeated, minlength=n)], 1).astype(np.int64)
    return numbers, classes, words


def _word_class(hashes):
    return (mix(hashes, 5) >> _U(64 - _BITS)).astype(np.int64)


def _raw_references(docs: DataFrame, refs=None) -> list:
    """References of ``docs(lang, text)``, without the texts that lie far from ``refs``.

    What a task sends has a fixed size for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def run(batches):
        refs, sums = shared.value, {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            offsets, data = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                classes, words = histograms(data, offsets[a:b + 1])
                n = np.diff(words.first)
                ok = n >= MIN_WORDS
                if refs:
                    by_class, by_word = nearest(classes, words, refs)
                    ok &= ~too_far(by_class, by_word, n)
                # Whole numbers, so that the sums don't depend on how the documents are dealt out.
                share = classes * _ONE // np.maximum(classes.sum(1, keepdims=True), 1)
                weight = (_ONE // np.maximum(n, 1)).astype(float)
                word_class = _word_class(words.hash)
                for lang in set(langs[a:b]):
                    mine = (langs[a:b] == lang) & ok
                    c, w = sums.setdefault(lang, (np.zeros(_CLASSES, np.int64), np.zeros(1 << _BITS, np.int64)))
                    c += share[mine].sum(0)
                    at = mine[words.doc]
                    w += np.bincount(word_class[at], weight[words.doc[at]], 1 << _BITS).astype(np.int64)
        for lang, (c, w) in sums.items():
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (_CLASSES + len(at)), pa.string()),
                 pa.array(np.concatenate([-1 - np.arange(_CLASSES), at]), pa.int32()),
                 pa.array(np.concatenate([c, w[at]]), pa.int64())], names=["lang", "cell", "n"])

    cells = docs.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    all_words = cells.groupBy("lang").agg(F.sum(F.when(F.col("cell") >= 0, F.col("n")).otherwise(0)).alias("words"))
    # At most 1 / COMMON word classes and the character classes of a language are left.
    common = cells.join(all_words, "lang").where((F.col("words") > 0) & ((F.col("cell") < 0) | (F.col("n") >= COMMON * F.col("words"))))
    out = []
    for lang, own in sorted(common.toPandas().groupby("lang"), key=lambda x: x[0]):
        classes = np.zeros(_CLASSES)
        characters = own[own["cell"] < 0]
        classes[-1 - characters["cell"].to_numpy()] = characters["n"]
        words = own[own["cell"] >= 0].sort_values("cell")
        out.append((lang, classes / classes.sum(), words["cell"].to_numpy(np.int64),
                    words["n"].to_numpy(float) / float(own["words"].iloc[0])))
    return out


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> list:
    """``(language, class shares, common word classes, their shares)`` over all documents.

    Every document of at least ``MIN_WORDS`` words counts alike, however long. The
    references are made twice: from all documents, then from those near the first ones,
    so that odd documents do not shape what they are judged by.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    first = _raw_references(rows)
    return _raw_references(rows, first) or first


def histograms(data, offsets):
    """Characters of each class, and words."""
    part, local = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    head, kind = (part & 0xC0) != 0x80, _CLASS[part]
    return np.stack([_per_text(head & (kind == c), local) for c in range(_CLASSES)], 1), words_of(data, offsets, _FOLD)


def _half(p, q):
    """``p * log2(p / ((p + q) / 2))``, 0 where p is 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log2(2 * p / (p + q)), 0.0)


def distances(classes, words, reference) -> tuple[np.ndarray, np.ndarray]:
    """Jensen-Shannon distances of each text to one reference: character classes, common words."""
    _, q_class, cells, q_word = reference
    p = classes / np.maximum(classes.sum(1, keepdims=True), 1)
    by_class = np.sqrt(np.maximum((_half(p, q_class) + _half(q_class + 0 * p, p)).sum(1) / 2, 0))
    n = len(classes)
    table = np.full(1 << _BITS, len(cells), np.int64)
    table[cells] = np.arange(len(cells))
    width = len(cells) + 1
    count = np.bincount(words.doc * width + table[_word_class(words.hash)], minlength=n * width).reshape(n, width)
    p = count / np.maximum(count.sum(1, keepdims=True), 1)
    q = np.append(q_word, max(0.0, 1 - q_word.sum()))
    by_word = np.sqrt(np.maximum((_half(p, q) + _half(q + 0 * p, p)).sum(1) / 2, 0))
    return by_class, by_word


def nearest(classes, words, refs) -> tuple[np.ndarray, np.ndarray]:
    """Both distances to the reference with the nearest common words."""
    pairs = [distances(classes, words, r) for r in refs]
    by_word = np.stack([w for _, w in pairs])
    best = by_word.argmin(0)[None, :]
    return np.take_along_axis(np.stack([c for c, _ in pairs]), best, 0)[0], np.take_along_axis(by_word, best, 0)[0]


def too_far(by_class, by_word, n):
    """Which texts of ``n`` words differ more from their reference than chance explains."""
    root = np.sqrt(np.maximum(n, 1))
    far = (by_class > CLASS_LIMIT[0] + CLASS_LIMIT[1] / root) | (by_word > WORD_LIMIT[0] + WORD_LIMIT[1] / root)
    return far & (n >= MIN_WORDS)


def _verdicts(texts, refs):
    """``(a, b, columns)`` for slices ``[a:b]`` of a column of texts: measures, distances, ``base_failed`` and ``kept``."""
    offsets, data = text_buffers(texts)
    for a, b in slices(offsets):
        numbers, classes, words = measure(data, offsets[a:b + 1])
        by_class, by_word = nearest(classes, words, refs) if refs else np.zeros((2, b - a))
        n = numbers[:, 0]
        failed = (n < 50) | (100 * numbers[:, 4] > 50 * n)
        yield a, b, [*numbers.T, by_class, by_word, failed, ~failed & ~too_far(by_class, by_word, n)]


def judge(docs: DataFrame, refs: list, text_col: str = "text") -> DataFrame:
    """Add the measures, the distances to the nearest reference, ``base_failed`` and ``kept``.

    Columns so named before are replaced, all others kept. Base rules: fewer than 50
    words, or more than half of the words in three-word windows that occur again. Null
    and empty texts have no words and fail. Without references only the base rules hold.
    """
    added = [*_MEASURES, "class_distance", "word_distance", "base_failed", "kept"]
    docs = docs.drop(*added)
    names = docs.schema.names
    shared = docs.sparkSession.sparkContext.broadcast(refs)  # a few kilobytes a language
    kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
    spark_kinds = [T.LongType()] * 5 + [T.DoubleType()] * 2 + [T.BooleanType()] * 2

    def run(batches):
        for batch in batches:
            for a, b, columns in _verdicts(batch.column(names.index(text_col)), shared.value):
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns),
                                                  *(pa.array(np.ascontiguousarray(c), k) for c, k in zip(columns, kinds))],
                                                 names=[*names, *added])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(x, k) for x, k in zip(added, spark_kinds))])
    return docs.mapInArrow(run, schema)


def quality_report(docs: DataFrame) -> DataFrame:
    done = judge(docs.select("doc_id", "text"), references(docs.select("text", "lang")))
    return done.select("doc_id", *_MEASURES, "base_failed", "kept", "class_distance", "word_distance")


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(references(docs.select("text", "lang")))

    def keep(texts):
        for a, b, columns in _verdicts(texts, shared.value):
            yield a, b, columns[-1]

    return keep_rows(docs, keep)
