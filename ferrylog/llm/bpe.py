"""Byte-pair encoding with a segment tree per pre-token.

The leaves of a tree are byte positions. A leaf holds the rank of the pair that
starts there (none: infinity) with the position as the lower digits, so the root is
the leftmost pair of least rank. A merge writes three leaves - the pair that goes,
the new symbol's pair, its left neighbour's pair - and their paths to the root.
``merge_all`` does this for many pre-tokens side by side, one merge of each a
round; ``merge_one`` for a single long one.

Texts are cut where a pre-token must end whatever surrounds it: at a blank whose
previous character is no white space. Equal pieces are encoded once per worker.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ferrylog.llm.words import slices, text_buffers

_NONE = np.int64(1) << np.int64(60)
_PAIR = 1 << 20
_BLANK_AFTER_SPACE = re.compile(r"\s ")
_STABLE = re.compile(r"(?<=\S) ")
#: Pieces that a worker keeps; beyond it the memory is emptied and filled anew.
MEMO = 400_000


class PairTable:
    """Rank and product of each pair of symbols."""

    def __init__(self, left, right, rank, product):
        key = np.asarray(left, np.int64) * _PAIR + np.asarray(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key = np.append(key[order], _NONE)
        self.rank = np.append(np.asarray(rank, np.int64)[order], -1)
        self.product = np.append(np.asarray(product, np.int64)[order], -1)
        self.lookup = None

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair, or -1."""
        key = left * _PAIR + right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, at, -1)

    def get(self, left: int, right: int) -> int:
        if self.lookup is None:
            self.lookup = {int(k): i for i, k in enumerate(self.key[:-1])}
        return self.lookup.get(left * _PAIR + right, -1)


def merge_all(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """Merge rows of ``symbols`` (n x width, a power of two) in place; dead places become -1."""
    n, width = symbols.shape
    place = np.arange(width)
    live = place[None, :] < lengths[:, None]
    after = np.where(place[None, :] + 1 < lengths[:, None], place[None, :] + 1, width).repeat(1, axis=0)
    before = np.broadcast_to(place[None, :] - 1, (n, width)).copy()
    rows = np.full((n, width), -1, np.int64)
    if width > 1:
        both = live[:, 1:]
        rows[:, :-1][both] = table.find(symbols[:, :-1][both], symbols[:, 1:][both])
    symbols[~live] = -1
    tree = np.full((n, 2 * width), _NONE, np.int64)
    tree[:, width:] = np.where(rows >= 0, table.rank[rows] * width + place[None, :], _NONE)
    level = width
    while level > 1:
        level //= 2
        np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2], out=tree[:, level:2 * level])
    active = np.flatnonzero(tree[:, 1] < _NONE)
    while len(active):
        a = active
        pos = tree[a, 1] % width
        right = after[a, pos]
        symbols[a, pos] = table.product[rows[a, pos]]
        symbols[a, right] = -1
        beyond = after[a, right]
        after[a, pos] = beyond
        has = beyond < width
        before[a[has], beyond[has]] = pos[has]
        prev = before[a, pos]
        led = prev >= 0
        # The three leaves: the new symbol's pair, the dead place, the pair of the left neighbour.
        pair = np.full(len(a), -1, np.int64)
        pair[has] = table.find(symbols[a[has], pos[has]], symbols[a[has], beyond[has]])
        rows[a, pos] = pair
        tree[a, width + pos] = np.where(pair >= 0, table.rank[pair] * width + pos, _NONE)
        tree[a, width + right] = _NONE
        al, pl = a[led], prev[led]
        pair = table.find(symbols[al, pl], symbols[al, pos[led]])
        rows[al, pl] = pair
        tree[al, width + pl] = np.where(pair >= 0, table.rank[pair] * width + pl, _NONE)
        left, mid, dead = np.where(led, prev, pos) + width, pos + width, right + width
        while width > 1 and mid[0] > 1:
            left, mid, dead = left >> 1, mid >> 1, dead >> 1
            for node in (left, mid, dead):
                tree[a, node] = np.minimum(tree[a, 2 * node], tree[a, 2 * node + 1])
        active = a[tree[a, 1] < _NONE]
    return symbols


def merge_one(symbols: list[int], table: PairTable) -> list[int]:
    """Merge one sequence; equal to ``merge_all`` on one row."""
    n = len(symbols)
    width = 1 << max(0, (n - 1).bit_length())
    none, rank, product = int(_NONE), table.rank, table.product
    after, before = [*range(1, n), width], [*range(-1, n - 1)]
    rows, tree = [-1] * n, [none] * (2 * width)

    def leaf(i):
        j = after[i]
        r = rows[i] = table.get(symbols[i], symbols[j]) if j < width else -1
        tree[width + i] = int(rank[r]) * width + i if r >= 0 else none

    for i in range(n):
        leaf(i)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    while tree[1] < none:
        i = tree[1] % width
        j = after[i]
        symbols[i], symbols[j] = int(product[rows[i]]), -1
        after[i] = after[j]
        if after[j] < width:
            before[after[j]] = i
        tree[width + j] = none
        leaf(i)
        touched = [i, j]
        if before[i] >= 0:
            leaf(before[i])
            touched.append(before[i])
        for k in touched:
            k = (k + width) >> 1
            while k:
                tree[k] = min(tree[2 * k], tree[2 * k + 1])
                k >>= 1
    return [s for s in symbols if s >= 0]


def merge_many(flat: np.ndarray, lengths: np.ndarray, table: PairTable) -> list[bytes]:
    """Merge the sequences that lie one after another in ``flat``.

    Gives the ids of each as little-endian unsigned 32-bit integers.
    """
    out: list[bytes] = [b""] * len(lengths)
    starts = np.cumsum(lengths) - lengths
    width = np.int64(1) << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
    for w in np.unique(width[lengths > 0]).tolist():
        member = np.flatnonzero((width == w) & (lengths > 0))
        if w >= 256 and len(member) * 256 < w * 8 or w >= 1 << 14:  # few and long: side by side gains nothing
            for i in member:
                out[i] = np.array(merge_one(flat[starts[i]:starts[i] + lengths[i]].tolist(), table), "<u4").tobytes()
            continue
        step = max(1, (1 << 19) // w)  # bounds the memory of the trees
        for at in range(0, len(member), step):
            part = member[at:at + step]
            grid = np.full((len(part), w), -1, np.int64)
            inside = np.arange(w)[None, :] < lengths[part][:, None]
            grid[inside] = flat[(starts[part][:, None] + np.arange(w)[None, :])[inside]]
            grid = merge_all(grid, lengths[part], table)
            keep = grid >= 0
            ids = grid[keep].astype("<u4").tobytes()
            ends = (np.cumsum(keep.sum(1)) * 4).tolist()
            a = 0
            for i, b in zip(part.tolist(), ends):
                out[i] = ids[a:b]
                a = b
    return out


class RankVocabulary:
    """A rank file: the pieces of bytes in order of their merge."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        left, right, rank = [], [], []
        for piece, r in self.ranks.items():
            self.pieces[r] = piece
            for k in range(1, len(piece)):
                a, b = self.ranks.get(piece[:k]), self.ranks.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.table = PairTable(left, right, rank, rank)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.findall = regex.compile(pattern).findall

    def encode_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, pre-token by pre-token."""
        found = list(map(self.findall, texts))
        tokens = list(set().union(*found))
        raw = [t.encode() for t in tokens]
        whole = list(map(self.ranks.get, raw))
        todo = [r for r, w in zip(raw, whole) if w is None]
        merged = iter(merge_many(self.byte[np.frombuffer(b"".join(todo), np.uint8)],
                                 np.fromiter(map(len, todo), np.int64, len(todo)), self.table))
        known = {t: next(merged) if w is None else w.to_bytes(4, "little") for t, w in zip(tokens, whole)}
        return [b"".join(map(known.__getitem__, tokens)) for tokens in found]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def stable_pieces(text: str) -> list[str]:
    """Cut before each blank that follows a character other than white space.

    The blanks at the cuts are left out: all pieces but the first stand for a blank
    and themselves.
    """
    return text.split(" ") if not _BLANK_AFTER_SPACE.search(text) and text[:1] != " " else _STABLE.split(text)


class Memo:
    """Remembers what ``encode`` gives for a piece; ``encode`` takes lists."""

    def __init__(self, encode, limit: int = MEMO):
        self.encode, self.limit, self.known = encode, limit, {}

    def learn(self, pieces: Iterable[str]) -> dict:
        wanted = set(pieces)
        new = list(wanted.difference(self.known))
        if new:
            if len(self.known) + len(new) > self.limit:
                self.known, new = {}, list(wanted)
            self.known.update(zip(new, self.encode(new)))
        return self.known


_vocabularies: dict = {}


def _vocabulary(path, pattern):
    """One per worker and file, with the memory of pieces that follow a blank."""
    if (path, pattern) not in _vocabularies:
        v = RankVocabulary(path, pattern)
        _vocabularies[path, pattern] = v, Memo(lambda new: v.encode_pieces([" " + x for x in new]))
    return _vocabularies[path, pattern]


def strings_of(batch: pa.RecordBatch, column: str):
    """``(first, last, texts)`` in slices of a bounded size; nulls are empty."""
    at = batch.schema.get_field_index(column)
    offsets, _ = text_buffers(batch.column(at))
    for a, b in slices(offsets):
        yield a, b, [t or "" for t in batch.column(at).slice(a, b - a).to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the ids of ``text`` as little-endian unsigned 32-bit integers in one binary.

    As the rank vocabulary's own library would encode ordinary text: every match of
    ``pattern`` separately and no special tokens. Null and empty texts have no ids.
    Other columns and repeated rows are kept; a column named like ``ids`` is replaced.
    """
    docs = docs.drop(ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType())])

    def run(batches):
        vocabulary, memo = _vocabulary(path, pattern)
        for batch in batches:
            out = []
            for _, _, texts in strings_of(batch, text):
                cut = [stable_pieces(t) for t in texts]
                known = memo.learn(chain.from_iterable(pieces[1:] for pieces in cut))
                heads = vocabulary.encode_pieces([pieces[0] for pieces in cut])
                out += [b"".join([head, *map(known.__getitem__, pieces[1:])]) for head, pieces in zip(heads, cut)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that ``ids`` stand for; null ids give null."""
    encoded = encoded.drop(decoded)
    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches):
        vocabulary, _ = _vocabulary(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            out = [None if x is None else vocabulary.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, decoded])

    return encoded.mapInArrow(run, schema)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the decoded bytes."""
    done = decode(encode(docs.select("doc_id", "text"), path, pattern).select("doc_id", "ids"), path, pattern)
    return done.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
