"""Near duplicates by min-max hashing.

Under each permutation of the shingle hashes both the least and the greatest value
are kept, so ``n`` hash evaluations a shingle give a signature of ``2 n`` values; the
share of equal values is an unbiased estimate of the Jaccard similarity with less
variance than ``n`` minima and fewer evaluations than ``2 n``. Bands of consecutive
values make the candidates; every link is confirmed on the full shingle sets.

Texts with one shingle set are one class. Classes in a band's bucket are compared
with pivots of the bucket, never all with all at once:

* first with the smallest class of the bucket; what is confirmed is one component;
* then, in buckets that still hold several components, with a number of pivots that
  grows sixteenfold a round, and only across components.

A bucket is done when its members that were no pivots yet lie in one component. Then
every pair of it was compared, is connected by confirmed links, or cannot be a link:
two sets share at most what both have in common with the bucket's first class, and
beyond it those of their shingles that any other candidate has. This bounds their
similarity from above; copies with many changes of their own drop out by it without a
comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ferrylog.llm import exchange
from ferrylog.llm.words import mix, slices, text_buffers, windows, words_of
from ferrylog.operators.components import connected_components
from ferrylog.session import gathered, materialize, materialize_counted

SHINGLE = 5
#: 64 permutations give 128 values: 32 bands of 4. A pair at 0.75 is missed once in 190,000.
PERMUTATIONS, BAND_ROWS = 64, 4
THRESHOLD = 75  # per cent
_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_rng = np.random.Generator(np.random.PCG64(75))
_FACTORS = _rng.integers(0, 1 << 63, 1024, dtype=np.uint64) * _U(2) + _U(1)
_CHUNK = 1 << 15


def shingle_sets(data, offsets, size: int = SHINGLE):
    """``(hashes, first)``: the distinct shingle hashes of text i are ``hashes[first[i]:first[i + 1]]``, sorted.

    Letters A-Z count as a-z. A text of fewer words has its whole sequence as its one
    shingle; a text without words has none.
    """
    n = len(offsets) - 1
    words = words_of(data, offsets, _FOLD)
    at, values = windows(words, size)
    own = words.doc[at]
    count = np.diff(words.first)
    for k in np.unique(count[(count > 0) & (count < size)]).tolist():
        short = np.flatnonzero(count == k)
        h = np.zeros(len(short), np.uint64)
        for j in range(k):
            h = mix(h * _U(31) + words.hash[words.first[short] + j], 1000 + k)
        own, values = np.concatenate([own, short]), np.concatenate([values, h])
    order = np.lexsort((values, own))
    own, values = own[order], values[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (values[1:] != values[:-1])
    own, values = own[new], values[new]
    return values, np.searchsorted(own, np.arange(n + 1))


def signatures(values, first, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Min-max signatures (texts x 2 permutations); rows of empty sets are zero."""
    n = len(first) - 1
    some = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((n, 2 * permutations), np.uint64)
    low = np.full((permutations, len(some)), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros((permutations, len(some)), np.uint64)
    starts = first[some]
    for a in range(0, len(values), _CHUNK):  # a chunk stays in the processor's cache
        part = values[a:a + _CHUNK]
        i, j = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, a + len(part))
        cut = np.maximum(starts[i:j] - a, 0)
        for k in range(permutations):
            h = part * _FACTORS[k]
            h ^= h >> _U(29)
            low[k, i:j] = np.minimum(low[k, i:j], np.minimum.reduceat(h, cut))
            high[k, i:j] = np.maximum(high[k, i:j], np.maximum.reduceat(h, cut))
    out[some, 0::2] = low.T
    out[some, 1::2] = high.T
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_shingles, set_a, set_b, bands)``: size, 128-bit name and band keys of each shingle set."""
    bands = 2 * PERMUTATIONS // BAND_ROWS

    def run(batches):
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                values, first = shingle_sets(data, offsets[a:b + 1])
                size = np.diff(first)
                names = []
                for seed in (1, 2):  # sums of mixed values do not depend on an order
                    total = np.append(_U(0), np.cumsum(mix(values, seed)))
                    names.append(mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64), seed))
                sig = signatures(values, first)
                key = np.zeros((b - a, bands), np.uint64)
                # Band j takes values j, j + bands, ...: the two ends of one permutation go to different bands.
                for r in range(BAND_ROWS):
                    key = mix(key * _U(31) + sig[:, r * bands:(r + 1) * bands], r)
                key = mix(key + np.arange(bands, dtype=np.uint64)[None, :], 5)[size > 0].view(np.int64)
                ends = np.append(0, np.cumsum(np.where(size > 0, bands, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(key.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(size, pa.int64()),
                     *(pa.array(x.view(np.int64)) for x in names), lists],
                    names=["id", "n_shingles", "set_a", "set_b", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _sets_of(column):
    """Shingle sets of a column of texts; equal neighbours are computed once."""
    offsets, data = text_buffers(column)
    for a, b in slices(offsets):
        values, first = shingle_sets(data, offsets[a:b + 1])
        for i in range(b - a):
            yield values[first[i]:first[i + 1]]


def compare(pairs: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs ``(a, b)`` with the size of the intersection of their full shingle sets, and whether that links them.

    ``texts(id, text)`` has the texts; an id with several gives a row for each.
    """

    def run(batches):
        for batch in batches:
            sets = [(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))
                    for x, y in zip(_sets_of(batch.column(2)), _sets_of(batch.column(3)))]
            linked = [n > 0 and 100 * both >= threshold * (n + m - both) for n, m, both in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([both for *_, both in sets], pa.int64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "both", "linked"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long, both long, linked boolean")


def common_shingles(texts: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(id, common)``: how many shingles of a text ``texts(id, text)`` has under another id too."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_buckets, buckets = buckets or partitions, buckets or partitions

    def shingles(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        offsets, data = text_buffers(table.column("text"))
        keys, own = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, b in slices(offsets):
            values, first = shingle_sets(data, offsets[a:b + 1])
            keys.append(values)
            own.append(np.repeat(ids[a:b], np.diff(first)))
        return exchange.first_keys(np.concatenate(keys), np.concatenate(own), key_buckets, buckets)

    def count(table: pa.Table) -> pa.Table:
        docs, keys, _ = exchange.unpack(table)
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
        ids, n = np.unique(docs[new], return_counts=True)
        return pa.table({"id": pa.array(ids, pa.int64()), "common": pa.array(n, pa.int64())})

    placed = texts.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    found = placed.groupBy("bucket").applyInArrow(shingles, exchange.ROWS).groupBy("bucket").applyInArrow(
        exchange.shared_keys(buckets), exchange.ROWS)
    return found.groupBy("bucket").applyInArrow(count, "id long, common long")


def _share(row: Column, bucket: Column) -> Column:
    """A number in [0, 1) that depends on a member and its bucket."""
    return F.shiftrightunsigned(F.xxhash64(row, bucket), 11) / F.lit(float(1 << 53))


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _open_members(members: DataFrame, most: int, labels: DataFrame, done: float) -> tuple[DataFrame, int]:
    """Members (``most`` rows) of buckets in which those that were no pivot yet lie in several components, and how many."""
    fresh = (members.join(labels.withColumnRenamed("id", "cls"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls"))
             .withColumn("place", _share(F.col("cls"), F.col("bucket")) * F.col("size"))
             .where((F.col("place") >= done) & (F.col("cls") != F.col("least"))))
    spread = fresh.groupBy("bucket").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
    return materialize_counted(gathered(fresh.join(spread.select("bucket"), "bucket"), most), "open")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for every row of ``docs``.

    Documents are linked when ``100 * |A and B| >= threshold * |A or B|`` on their sets
    of five-word shingles; ``component_id`` is the smallest id that links lead to and
    ``kept`` marks that document. Rows without words are linked with nothing. Rows
    with one id are one document, linked when any of their texts is; each row is
    returned. Rows with a null id get a null component and are kept.
    """
    sketched, n_docs = materialize_counted(sketch(docs, id_col, text_col), "sketch")
    known = sketched.where("id IS NOT NULL AND n_shingles > 0")
    classes = materialize(known.groupBy("set_a", "set_b").agg(
        F.min("id").alias("cls"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")), "classes")
    members = classes.select("cls", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("least")).where("size > 1")
    members, n_members = materialize_counted(members.join(shared, "bucket"), "members")
    wanted = members.select(F.col("cls").alias("id")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = materialize(rows.join(wanted, "id", "left_semi"), "texts")

    # An id with several sets is in several classes and connects them.
    own = known.join(classes.select("set_a", "set_b", "cls"), ["set_a", "set_b"])
    several = own.groupBy("id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z")
    bridges = own.join(several, "id").where("cls <> a").select("a", F.col("cls").alias("b"))

    tried = members.where("cls <> least").select(F.col("least").alias("a"), F.col("cls").alias("b")).distinct()
    star, n_star = materialize_counted(compare(tried, texts, threshold), "star")
    links = materialize(gathered(bridges.union(star.where("linked").select("a", "b")), n_docs + n_star), "links")
    labels = _components(links)
    fresh, n = _open_members(members, n_members, labels, -1.0)
    if n:
        # What the members of open buckets have in common with others at most.
        some = texts.join(fresh.select(F.explode(F.array("cls", "least")).alias("id")).distinct(), "id", "left_semi")
        common = common_shingles(some).withColumnRenamed("id", "cls")
        members = members.join(common, "cls").where(100 * F.col("common") >= threshold * F.col("n"))
        # An id has one set as a rule; with several, these bound what their union shares from below and above.
        shares = F.max("both").alias("near"), F.sum("both").alias("nearly")
        near = star.groupBy(F.col("a").alias("least"), F.col("b").alias("cls")).agg(*shares)
        members = members.join(near, ["least", "cls"], "left")
        members, n_members = materialize_counted(members.join(classes.select("cls", "bands"), "cls"), "narrowed")
        fresh, n = _open_members(members, n_members, labels, -1.0)
    share = 16.0
    while n:
        m, p = fresh.alias("m"), fresh.where(F.col("place") < share).alias("p")
        # Of what two members share, a part lies in the bucket's first class, the rest among what they have in common
        # with others beyond it.
        inside = F.least("m.nearly", "p.nearly")
        beyond = F.least(F.col("m.common") - F.col("m.near"), F.col("p.common") - F.col("p.near"))
        both = F.least(inside + beyond, "m.common", "p.common", "m.n", "p.n")
        # Two members may share many buckets; the smallest one compares them.
        first = F.array_min(F.array_intersect("m.bands", "p.bands"))
        pairs = (m.join(p, (F.col("m.bucket") == F.col("p.bucket")) & (F.col("m.component") != F.col("p.component"))
                        & (100 * both >= threshold * (F.col("m.n") + F.col("p.n") - both)) & (first == F.col("m.bucket")))
                 .select(F.least("m.cls", "p.cls").alias("a"), F.greatest("m.cls", "p.cls").alias("b"))
                 .distinct().join(star.select("a", "b"), ["a", "b"], "left_anti"))
        more, found = materialize_counted(
            compare(materialize(pairs, "pairs"), texts, threshold).where("linked").select("a", "b"), "links")
        if found:
            links = links.union(more)
            labels = _components(links)
        (fresh, n), share = _open_members(members, n_members, labels, share), share * 16
    named = (own.select("id", "cls").distinct().join(labels.withColumnRenamed("id", "cls"), "cls", "left")
             .groupBy("id").agg(F.min(F.coalesce("component", "cls")).alias("component_id")))
    out = sketched.select("id", "n_shingles").join(named, "id", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
