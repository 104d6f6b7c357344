"""Keys of documents, dealt out by key in rows of sorted arrays.

One row holds the entries of one bucket as binaries of 64-bit numbers, so an exchange
moves a few large rows instead of one for each key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ferrylog.llm.words import mix

_U = np.uint64
ROWS = "bucket int, docs binary, keys binary, more binary"
# Buckets of keys count from 0. Entries that are settled go to a bucket of their document, -1 and below.
# The primes of xxHash64.
_XXH = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def pack(buckets, docs, keys, more=None) -> pa.Table:
    """One row a bucket from entries sorted by bucket."""
    order = np.argsort(buckets, kind="stable")
    buckets, docs, keys = buckets[order], docs[order], keys[order]
    more = None if more is None else more[order]
    cut = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, int)
    ends = np.append(cut[1:], len(buckets))
    column = lambda x: [x[a:b].tobytes() for a, b in zip(cut, ends)]
    return pa.table({"bucket": pa.array(buckets[cut], pa.int32()), "docs": pa.array(column(docs), pa.binary()),
                     "keys": pa.array(column(keys), pa.binary()),
                     "more": pa.array(column(more) if more is not None else [b""] * len(cut), pa.binary())})


def unpack(table):
    read = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    return read("docs", np.int64), read("keys", np.uint64), read("more", np.uint64)


def key_bucket(keys, count):
    return (mix(keys, 99) % _U(count)).astype(np.int32)


def doc_bucket(ids, count):
    """``pmod(xxhash64(id), count)`` as Spark computes it for 64-bit integers."""
    turn = lambda h, k: (h << _U(k)) | (h >> _U(64 - k))
    p1, p2, p3, p4, p5 = (_U(p) for p in _XXH)
    h = turn(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1 ^ (_U(42 + 8) + p5)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> _U(33))) * p2
    h = (h ^ (h >> _U(29))) * p3
    return np.mod((h ^ (h >> _U(32))).view(np.int64), np.int64(count)).astype(np.int32)


def first_of_key(keys, docs, more=None):
    """Order by key, then document; marks of a key's first entry, and first positions."""
    order = np.lexsort((docs, keys) if more is None else (docs, more, keys))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if more is not None:
        more = more[order]
        new[1:] |= more[1:] != more[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(keys)))
    return keys, docs, more, start, size


def settle(keys, docs, more):
    """Entries of a bucket of documents: settled ones, and the smallest document of each key.

    Settled are the documents above a key's smallest one here; they need no bucket of
    the key, so a frequent key gathers nowhere. The smallest of several is known to
    share its key, and still goes on for the others.
    """
    keys, docs, more, start, size = first_of_key(keys, docs, more)
    lead = np.zeros(len(keys), bool)
    lead[start] = True
    above = ~lead & (docs != np.repeat(docs[start], size))
    shared = np.zeros(len(keys), bool)
    shared[start] = np.logical_or.reduceat(above, start) if len(start) else False
    return keys, docs, more, lead, above, shared


def shared_keys(buckets):
    """Of a bucket of keys, the entries whose key has several documents; settled entries as they are."""
    def shared(table: pa.Table) -> pa.Table:
        docs, keys, _ = unpack(table)
        if table.column("bucket")[0].as_py() >= 0:
            keys, docs, _, start, size = first_of_key(keys, docs)
            many = np.repeat(docs[start] != docs[start + size - 1], size)
            keys, docs = keys[many], docs[many]
        return pack(doc_bucket(docs, buckets), docs, keys)
    return shared


def later_entries(buckets):
    """Of a bucket of keys, the entries above the smallest document of their key; settled entries as they are."""
    def later(table: pa.Table) -> pa.Table:
        docs, keys, more = unpack(table)
        if table.column("bucket")[0].as_py() >= 0:
            keys, docs, _, start, size = first_of_key(keys, docs, more)
            above = docs != np.repeat(docs[start], size)
            keys, docs = keys[above], docs[above]
        return pack(doc_bucket(docs, buckets), docs, keys)
    return later


def first_keys(keys, ids, key_buckets, buckets) -> pa.Table:
    """Rows for ``shared_keys`` from the keys of a bucket of documents."""
    keys, ids, _, lead, above, shared = settle(keys, ids, None)
    known = above | shared
    at = np.concatenate([np.flatnonzero(lead), np.flatnonzero(known)])
    return pack(np.concatenate([key_bucket(keys[lead], key_buckets), -1 - doc_bucket(ids[known], buckets)]), ids[at], keys[at])
