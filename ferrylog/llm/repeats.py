"""Exact removal of repeated passages by recompression.

A text's words are named by 64-bit hashes. A round names every maximal run of one
name by its name and length, then every pair ``ab`` of a left and a right name by
both; whether a name is left or right is a bit of the name. Names are pure functions
of what they stand for, so every task gives equal things equal names and a round
needs no dictionary. What a symbol is depends on the words it covers and on a few
around it, its *context*. Where the context of a symbol lies inside two equal
passages, both hold the symbol: it is interior.

Each window of words is represented by one interior symbol of the last round, the
one with the least key; the key hashes the context. A window without any is
represented by itself. Equal windows choose equal keys, so

1. keys are gathered per document and dealt out; a key in one document only ends here;
2. documents with shared keys give the fingerprints (128 bits) of the windows behind
   them, which are dealt out in turn; a window is removed in all documents but those
   with the smallest id;
3. the words of removed windows leave the texts.

Rows that travel are sorted arrays of numbers, one row for a pair of buckets. In a
bucket of documents only the smallest document of a key goes on for the others, so a
passage that a third of all documents hold costs an entry per bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ferrylog.llm import exchange
from ferrylog.llm.names import free_name
from ferrylog.llm.words import mix, slices, text_buffers, windows, words_of

WINDOW = 13
ROUNDS = 2
_U = np.uint64
_MOST = _U((1 << 64) - 1)
_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def recompress(names, doc, rounds: int = ROUNDS):
    """Symbols after some rounds over the words of several texts.

    Returns ``(first context word, end of context, usable, name)`` per symbol. A
    symbol whose context would pass the edge of its text is not usable.
    """
    n = len(names)
    at = np.arange(n)
    left, right = at.copy(), at + 1  # context
    edge = np.zeros(n, bool)
    doc = np.asarray(doc)
    for level in range(rounds):
        # Runs. A symbol is no longer run only if its neighbours differ: they join the context.
        new_doc = np.ones(len(names), bool)
        new_doc[1:] = doc[1:] != doc[:-1]
        head = new_doc.copy()
        head[1:] |= names[1:] != names[:-1]
        start = np.flatnonzero(head)
        end = np.append(start[1:], len(names))
        if not len(start):
            break
        length = (end - start).astype(np.uint64)
        run = np.where(length > _U(1), mix(names[start] ^ mix(length, 3), 31 + level), names[start])
        run_edge = np.logical_or.reduceat(edge, start)
        run_doc, first = doc[start], new_doc[start]
        last = np.append(first[1:], True)
        l2, r2 = left[start], right[end - 1]
        l2[1:] = np.where(first[1:], l2[1:], left[start[1:] - 1])
        r2[:-1] = np.where(last[:-1], r2[:-1], right[end[:-1]])
        run_edge |= first | last
        near = np.zeros(len(start), bool)
        near[1:] |= ~first[1:] & edge[start[1:] - 1]
        near[:-1] |= ~last[:-1] & edge[end[:-1]]
        names, doc, left, right, edge = run, run_doc, l2, r2, run_edge | near
        # Pairs. Left before right; a symbol stays alone because of its one neighbour.
        is_left = (mix(names, 57 + level) & _U(1)).astype(bool)
        pair = np.zeros(len(names), bool)
        pair[:-1] = is_left[:-1] & ~is_left[1:] & (doc[:-1] == doc[1:])
        joined = np.zeros(len(names), bool)
        joined[1:] = pair[:-1]
        keep = np.flatnonzero(~joined)
        paired = pair[keep]
        after = np.minimum(keep + 1, len(names) - 1)
        prior = np.maximum(keep - 1, 0)
        alone_left, alone_right = ~paired & is_left[keep], ~paired & ~is_left[keep]
        open_end = alone_left & ((keep + 1 == len(names)) | (doc[after] != doc[keep]))
        open_start = alone_right & ((keep == 0) | (doc[prior] != doc[keep]))
        l2 = np.where(alone_right & ~open_start, left[prior], left[keep])
        r2 = np.where(~alone_right & ~open_end, right[after], right[keep])
        edge = edge[keep] | open_end | open_start | (~alone_right & ~open_end & edge[after]) | (alone_right & ~open_start & edge[prior])
        names = np.where(paired, mix(names[keep] * _U(3) ^ mix(names[after], 11), 83 + level), names[keep])
        doc, left, right = doc[keep], l2, r2
    return left, right, ~edge, names


def window_keys(words, size: int = WINDOW, rounds: int = ROUNDS):
    """``(first words, key of each window)``: equal windows have equal keys."""
    at, whole = windows(words, size, 5)
    if not len(at):
        return at, whole
    n = len(words.hash)
    left, right, usable, names = recompress(words.hash, words.doc, rounds)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words.hash * _powers(_STEP, n), out=total[1:])
    key = mix((total[right] - total[left]) * _powers(_BACK, n + 1)[left] + (right - left).astype(np.uint64) + names)
    key[~usable | (right - left > size)] = _MOST
    # Contexts begin and end in order, so the symbols inside a window are neighbours.
    low = np.cumsum(np.bincount(left, minlength=n + 1))
    high = np.cumsum(np.bincount(right, minlength=n + 1))
    first = np.where(at > 0, low[at - 1], 0)
    count = high[at + size] - first
    least, best, width = key, np.full(len(at), _MOST, np.uint64), 1
    while width <= size:
        take = np.flatnonzero((count >= width) & (count < 2 * width))
        a = first[take]
        best[take] = np.minimum(least[a], least[a + count[take] - width])
        if len(least) > width:
            least = np.minimum(least[:-width], least[width:])
        width *= 2
    return at, np.where(best == _MOST, whole, best)


def _group(docs, ids, fn):
    """Words of a bucket's texts, a slice at a time: ``fn(words, ids, first row)``."""
    offsets, data = text_buffers(docs)
    return [fn(words_of(data, offsets[a:b + 1]), ids[a:b], a) for a, b in slices(offsets)]


def _ids(table, column):
    """Ids as 64-bit integers, and which rows have one."""
    ids = table.column(column).combine_chunks().cast(pa.int64())
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False), valid


def _combine(ids, keys):
    return mix(keys ^ mix(ids.astype(np.uint64), 77))


def _marked(words, at, keys, ids, wanted):
    """Which windows have their (document, key) in the sorted ``wanted``."""
    if not len(wanted) or not len(at):
        return np.zeros(len(at), bool)
    value = _combine(ids[words.doc[at]], keys)
    place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
    return wanted[place] == value


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   buckets: int | None = None) -> DataFrame:
    """Remove words covered by a window that also starts in a document with a smaller id.

    Adds ``n_words``, ``n_removed`` and ``kept_text`` (the words left, joined by one
    blank); columns so named before are replaced and all others kept. Windows are
    judged on the given texts, not on what is left.

    Null and empty texts have no words and keep an empty text. Rows with a null id are
    kept whole and remove nothing elsewhere. Rows with one id are one document: they
    don't remove each other's windows. ``buckets`` bounds the texts that a task holds
    at once; by default there are two for each shuffle partition, and one bucket of keys.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_buckets, buckets = buckets or partitions, buckets or 2 * partitions
    docs = docs.drop("n_words", "n_removed", "kept_text")
    bucket = free_name(docs.columns, "__bucket")
    placed = docs.withColumn(bucket, F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(buckets)).cast("int"))
    if docs.schema[id_col].nullable:  # rows without an id are spread by their text
        spread = F.pmod(F.xxhash64(text_col), F.lit(buckets)).cast("int")
        placed = placed.withColumn(bucket, F.when(F.col(id_col).isNull(), spread).otherwise(F.col(bucket)))

    def key_rows(table: pa.Table) -> pa.Table:
        ids, valid = _ids(table, id_col)

        def keys_of(words, ids, a):
            at, keys = window_keys(words, window)
            ok = valid[a:a + len(ids)][words.doc[at]]
            at, keys = at[ok], keys[ok]
            own = words.doc[at]
            new = np.ones(len(at), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
            return keys[new], ids[own[new]]

        parts = _group(table.column(text_col), ids, keys_of)
        keys, ids = (np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)]) for k, kind in ((0, np.uint64), (1, np.int64)))
        return exchange.first_keys(keys, ids, key_buckets, buckets)

    def window_rows(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, valid = _ids(left, id_col)
        docs, keys, _ = exchange.unpack(right)
        wanted = np.unique(_combine(docs, keys))

        def prints_of(words, ids, a):
            at, keys = window_keys(words, window)
            hit = _marked(words, at, keys, ids, wanted) & valid[a:a + len(ids)][words.doc[at]]
            own = ids[words.doc[at[hit]]]
            return windows(words, window, 17)[1][hit], own, windows(words, window, 29)[1][hit]

        parts = _group(left.column(text_col), ids, prints_of) if len(wanted) else []
        keys, ids, more = (np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)])
                           for k, kind in ((0, np.uint64), (1, np.int64), (2, np.uint64)))
        keys, ids, more, lead, above, _ = exchange.settle(keys, ids, more)
        at = np.concatenate([np.flatnonzero(lead), np.flatnonzero(above)])
        to = np.concatenate([exchange.key_bucket(keys[lead], key_buckets), -1 - exchange.doc_bucket(ids[above], buckets)])
        return exchange.pack(to, ids[at], keys[at], more[at])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, valid = _ids(left, id_col)
        docs, keys, _ = exchange.unpack(right)
        wanted = np.unique(_combine(docs, keys))
        column = left.column(text_col).combine_chunks()

        def kept_of(words, ids, a):
            removed = np.zeros(len(words.hash) + 1, np.int64)
            if len(wanted):
                at, prints = windows(words, window, 17)
                at = at[_marked(words, at, prints, ids, wanted) & valid[a:a + len(ids)][words.doc[at]]]
                np.add.at(removed, at, 1)
                np.add.at(removed, at + window, -1)
            gone = np.cumsum(removed[:-1]) > 0
            n_words = np.diff(words.first)
            n_gone = np.bincount(words.doc[gone], minlength=len(ids)) if len(gone) else np.zeros(len(ids), np.int64)
            texts = []
            for i, text in enumerate(column.slice(a, len(ids)).to_pylist()):
                own = (text or "").encode().split()
                if n_gone[i]:
                    drop = gone[words.first[i]:words.first[i + 1]].tolist()
                    own = [w for w, d in zip(own, drop) if not d]
                texts.append(b" ".join(own).decode())
            return n_words, n_gone, texts

        parts = _group(left.column(text_col), ids, kept_of)
        total = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1)]
        texts = [t for p in parts for t in p[2]]
        out = left.drop_columns([bucket])
        for name, column_ in (("n_words", pa.array(total[0], pa.int64())), ("n_removed", pa.array(total[1], pa.int64())),
                              ("kept_text", pa.array(texts, pa.string()))):
            out = out.append_column(name, column_)
        return out

    # The three uses of ``texts`` are one exchange: the texts are dealt out once.
    texts = placed.groupBy(bucket)
    shared = texts.applyInArrow(key_rows, exchange.ROWS).groupBy("bucket").applyInArrow(exchange.shared_keys(buckets), exchange.ROWS)
    prints = texts.cogroup(shared.groupBy("bucket")).applyInArrow(window_rows, exchange.ROWS)
    later = prints.groupBy("bucket").applyInArrow(exchange.later_entries(buckets), exchange.ROWS)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return texts.cogroup(later.groupBy("bucket")).applyInArrow(cut, schema)


def digest(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
