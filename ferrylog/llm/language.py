"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of
the byte that follows. A byte's code length comes from the longest context that the
language has seen; a byte new to a context costs an escape there and is then coded in
the next shorter one (an escape counts as often as distinct bytes followed, the
lowest level is uniform). The statistics are frozen, so a text's code length under a
language is a sum of table entries, and the language with the shortest code is the
prediction.

Before counting, letters A-Z become a-z, every run of other ASCII characters becomes
one blank, and bytes of longer characters stay. Bytes that no language has seen share
a symbol.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ferrylog.llm.names import free_name
from ferrylog.llm.rows import keep_rows
from ferrylog.llm.words import slices, text_buffers

ORDER = 3
#: Bound of the labelled documents a language is learned from; whole texts, chosen by a hash of the id.
SAMPLE = 1000
_OTHER, _UNSEEN = 32, 0
_FOLD = np.full(256, _OTHER, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = _FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def fold(data, offsets):
    """``(symbols, offsets)`` of the texts ``data[offsets[i]:offsets[i + 1]]`` after folding."""
    symbols = _FOLD[data[offsets[0]:offsets[-1]]]
    local = offsets - offsets[0]
    keep = symbols != _OTHER
    keep[1:] |= symbols[:-1] != _OTHER
    keep[local[:-1][local[:-1] < len(symbols)]] = True
    return symbols[keep], np.append(0, np.cumsum(keep))[local]


def context_codes(symbols, offsets, order, base=256, blank=_OTHER):
    """Per symbol a number for the ``order`` symbols before it in its text; the nearest is the last digit.

    ``symbols`` are numbers below ``base``. A text begins as if after blanks.
    """
    n = len(symbols)
    heads = np.unique(offsets[:-1])
    heads = heads[heads < n]
    code = np.zeros(n, np.int64)
    for k in range(1, order + 1):
        back = np.full(n, blank, np.int64)
        back[k:] = symbols[:max(0, n - k)]
        for d in range(k):  # these have another text's symbols before them
            place = heads + d
            back[place[place < n]] = blank
        code += back * base ** (k - 1)
    return code


def count_contexts(labelled: DataFrame, lang_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """``(lang, code, n)``: how often each byte followed each context of ``order`` bytes."""

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            offsets, data = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                symbols, ends = fold(data, offsets[a:b + 1])
                code = context_codes(symbols, ends, order) * 256 + symbols
                for lang in sorted(set(langs[a:b])):
                    mine = np.repeat(langs[a:b] == lang, np.diff(ends))
                    values, n = np.unique(code[mine], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values),
                                                      pa.array(n, pa.int64())], names=["lang", "code", "n"])

    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Model:
    """Frozen code lengths: ``cost[node * symbols + symbol]`` has the bits under each language."""

    def __init__(self, languages, counts, order: int = ORDER):
        """``counts``: per language, ``(codes, n)`` for contexts of ``order`` bytes."""
        self.languages, self.order = languages, order
        seen = np.zeros(256, bool)
        for codes, _ in counts:
            for k in range(order + 1):
                seen[np.unique(codes >> (8 * k) & 255)] = True
        seen[_UNSEEN] = True
        self.symbol = np.zeros(256, np.int64)
        self.symbol[np.flatnonzero(seen)] = np.arange(seen.sum())
        self.size = size = int(seen.sum())
        small = [(sum(self.symbol[codes >> (8 * k) & 255] * size ** k for k in range(order + 1)), n) for codes, n in counts]
        # Nodes: every context of 0 to ``order`` symbols that some language has seen.
        self.nodes, first = [], 0
        for k in range(order + 1):
            ctx = np.unique(np.concatenate([(c // size) % size ** k for c, _ in small] or [np.zeros(0, np.int64)])) if k else np.zeros(1, np.int64)
            self.nodes.append((first, ctx))
            first += len(ctx)
        cost = np.empty((first, size, max(1, len(small))), np.float32)
        for i, (codes, n) in enumerate(small):
            below = np.full((1, size), np.log2(max(size, 2)))
            for k in range(order + 1):
                at, ctx = self.nodes[k]
                parent = below if k == 0 else below[np.searchsorted(self.nodes[k - 1][1], ctx % size ** (k - 1))]
                total = np.zeros((len(ctx), size))
                np.add.at(total, (np.searchsorted(ctx, (codes // size) % size ** k), codes % size), n)
                distinct, events = (total > 0).sum(1, keepdims=True), total.sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    inside = np.log2(events + distinct) - np.log2(total)
                    escaped = np.log2(events + distinct) - np.log2(distinct) + parent
                below = np.where(events == 0, parent, np.where(total > 0, inside, escaped))
                cost[at:at + len(ctx), :, i] = below
        self.cost = cost.reshape(first * size, -1)
        # The node of each context of ``order`` symbols: its longest known end.
        self.node_of = np.zeros(size ** order, np.int32)
        for k in range(1, order + 1):
            at, ctx = self.nodes[k]
            grid = self.node_of.reshape(size ** (order - k), size ** k)
            grid[:, ctx] = (at + np.arange(len(ctx)))[None, :]

    def code_lengths(self, data, offsets) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each language (texts x languages), and symbols of each text."""
        symbols, ends = fold(data, offsets)
        symbols = self.symbol[symbols]
        out = np.zeros((len(ends) - 1, self.cost.shape[1]))
        step = 1 << 18
        for a in range(0, len(symbols), step):
            b, start = min(a + step, len(symbols)), max(0, a - self.order)
            heads = ends[(ends >= start) & (ends < b)] - start
            ctx = context_codes(symbols[start:b], np.append(heads, b - start), self.order, self.size, self.symbol[_OTHER])
            bits = self.cost[(self.node_of[ctx].astype(np.int64) * self.size + symbols[start:b])[a - start:]]
            i, j = int(np.searchsorted(ends, a, "right")) - 1, int(np.searchsorted(ends, b))
            cut = np.maximum(ends[i:j], a) - a
            full = np.append(cut[1:], b - a) > cut
            out[i:j][full] += np.add.reduceat(bits, cut[full], axis=0, dtype=np.float64)
        return out, np.diff(ends)


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          sample: int = SAMPLE, order: int = ORDER) -> Model:
    """Learn from rows with a text and a language.

    At most about ``sample`` documents of a language are taken, those whose hashed id
    falls below the share that this is of them. Only counts of contexts of these texts
    reach the driver.
    """
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    many = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}
    if not many:
        return Model([], [], order)
    share = F.lit(1.0)
    for lang, n in many.items():
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("language")), 11) / F.lit(float(1 << 53))
    counted = count_contexts(labelled.where(draw < share), lang_col, text_col, order).toPandas()
    languages = sorted(counted["lang"].unique())
    parts = [counted[counted["lang"] == x] for x in languages]
    return Model(languages, [(p["code"].to_numpy(np.int64), p["n"].to_numpy(np.float64)) for p in parts], order)


def _has_letter(text_col: str) -> Column:
    # Most texts begin with one; only the others are decoded as a whole.
    text = F.col(text_col)
    return F.coalesce(F.substring(text, 1, 64).rlike(r"\p{L}") | text.rlike(r"\p{L}"), F.lit(False))


def _predictions(texts, letters, model):
    """``(a, b, languages, scores, bits a symbol)`` for slices ``[a:b]`` of a column of texts."""
    letters = letters.to_numpy(zero_copy_only=False).astype(bool)
    offsets, data = text_buffers(texts)
    for a, b in slices(offsets):
        n, ok = b - a, letters[a:b]
        names, score, rate = np.full(n, "und", object), np.zeros(n), np.zeros(n)
        if model.languages:
            bits, size = model.code_lengths(data, offsets[a:b + 1])
            best = bits.argmin(1)
            ahead = np.minimum(bits - bits.min(1, keepdims=True), 1000.0)
            names[ok] = np.array(model.languages, object)[best][ok]
            score[ok] = (1 / np.exp2(-ahead).sum(1))[ok]
            rate[ok] = (bits.min(1) / np.maximum(size, 1))[ok]
        yield a, b, names, score, rate


def predict(docs: DataFrame, model: Model, text_col: str = "text", columns=None) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_symbol``; columns so named before are replaced.

    Of the columns of ``docs`` those in ``columns`` come back, all if it is None.
    ``score`` is the probability of the language if all are as likely beforehand. Null
    texts, texts without a letter and all texts under an empty model get ``und`` and 0.
    Equal code lengths go to the language that sorts first. Rows come back slice by
    slice, so a batch of texts is never held twice.
    """
    docs = docs.drop("lang_pred", "score", "bits_per_symbol")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by the languages and their samples
    fields = docs.schema.names
    back = [i for i, c in enumerate(fields) if columns is None or c in columns]
    schema = T.StructType([*(docs.schema.fields[i] for i in back), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("bits_per_symbol", T.DoubleType())])
    out = schema.names

    def run(batches):
        for batch in batches:
            for a, b, names, score, rate in _predictions(batch.column(fields.index(text_col)), batch.column(len(fields)), shared.value):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in back), pa.array(names, pa.string()), pa.array(score), pa.array(rate)],
                    names=out)

    return docs.withColumn(free_name(fields, "__letter"), _has_letter(text_col)).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Predict the language of every document from the labelled ones that are not held out."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    done = predict(docs.select("doc_id", "text"), model, columns=["doc_id"])
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_symbol")


#: Bits a symbol from which a text is none of the learned languages: hardly shorter than plain bytes.
MOST_BITS = 7.0


def known_language(docs: DataFrame) -> DataFrame:
    """The documents in a learned language, with all their columns as they are.

    Those without text or letters go, and those that no language codes in fewer than
    ``MOST_BITS`` bits a symbol.
    """
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts, letters):
        for a, b, names, _, rate in _predictions(texts, letters, shared.value):
            yield a, b, (names != "und") & (rate < MOST_BITS)

    return keep_rows(docs, keep, _has_letter("text"))
