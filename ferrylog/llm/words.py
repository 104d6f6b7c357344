"""Words, hashes and windows of whole Arrow batches with numpy.

A word is ``[^\\x20\\x09-\\x0D]+``. No byte of a longer UTF-8 character is white
space in this sense, so everything works on bytes. Texts are handled in pieces of
about ``PIECE`` bytes cut at white space: memory stays bounded by the piece, the
longest word and some bytes per word of the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; kept between calls up to a bound."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, PIECE + 1024)
        known = np.empty(size, np.uint64)
        known[0], filled, step = 1, 1, base
        while filled < size:
            more = min(filled, size - filled)
            known[filled:filled + more] = known[:more] * _U(step)
            step = step * step & (1 << 64) - 1
            filled += more
        if size <= 16 * PIECE:
            _powers[base] = known
    return known[:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on each other."""
    h = h + _U(seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 & (1 << 64) - 1)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


def slices(offsets: np.ndarray, limit: int = PIECE):
    """Ranges ``(first, last)`` of texts with at most ``limit`` bytes together, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@dataclass
class Words:
    """Words of some texts: byte range, hash and text index of each, and words before each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def cuts(data, a, b):
    """Cut ``data[a:b]`` after white space into pieces of about ``PIECE`` bytes."""
    while b - a > PIECE:
        at = a + PIECE
        while at < b:
            space = np.flatnonzero(_SPACE[data[at:min(at + 4096, b)]])
            if len(space):
                at += int(space[0]) + 1
                break
            at = min(at + 4096, b)
        yield a, at
        a = at
    if a < b:
        yield a, b


def words_of(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``, which lie one after another.

    ``fold`` maps bytes before hashing (for lower case). Byte positions count from
    ``offsets[0]``. Call it with one of ``slices``.
    """
    base, n = int(offsets[0]), len(offsets) - 1
    local = (offsets - base).astype(np.int64)
    table = _BYTE if fold is None else _BYTE[fold]
    starts, ends, hashes = [], [], []
    for a, b in ([(base, int(offsets[-1]))] if n > 1 else cuts(data, base, int(offsets[-1]))):
        piece = data[a:b]
        inside = ~_SPACE[piece]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        if n > 1:  # a word ends with its text
            edge = local[1:-1]
            edge = edge[(edge > 0) & (edge < len(piece))]
            opens[edge] = inside[edge]
            closes[edge - 1] = inside[edge - 1]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        values = table[piece]
        values *= _power(_BASE, len(piece))
        total = np.empty(len(piece) + 1, np.uint64)
        total[0] = 0
        np.cumsum(values, out=total[1:])
        h = (total[e] - total[s]) * _power(_INVERSE, len(piece) + 1)[s]
        starts.append(s + (a - base))
        ends.append(e + (a - base))
        hashes.append(mix(h + (e - s).astype(np.uint64)))
    if not starts:
        starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    start, end, h = (np.concatenate(x) if len(x) > 1 else x[0] for x in (starts, ends, hashes))
    first = np.searchsorted(start, local)
    first[-1] = len(start)
    return Words(start, end, h, np.repeat(np.arange(n), np.diff(first)), first)


def windows(words: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, hash)`` of every run of ``size`` words inside one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1:])
    step = _U((0xD1342543DE82EF95 + 2 * seed * 0x9E3779B97F4A7C15 | 1) & (1 << 64) - 1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h *= step
        h += words.hash[k:n + k]
    return at, mix(h[at], seed + size)


def seen_before(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether an earlier entry of its group is equal, and whether any other is."""
    if not len(values):
        return np.zeros(0, bool), np.zeros(0, bool)
    key = mix(values ^ mix(groups.astype(np.uint64), 7))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    earlier, other = np.zeros(len(key), bool), np.zeros(len(key), bool)
    earlier[order[1:]] = same
    other[order[1:]] = same
    other[order[:-1]] |= same
    return earlier, other


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; spans lie in order and do not overlap."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        a, b = int(start[i]), int(end[j - 1])
        if b - a > PIECE:  # one long span, in pieces
            for c in range(a, b, PIECE):
                values = _BYTE[data[c:min(c + PIECE, b)]]
                values *= _power(_BASE, len(values))
                out[i] = mix(out[i:i + 1] + values.sum(dtype=np.uint64), 3)[0]
        else:
            values = _BYTE[data[a:b]]
            values *= _power(_BASE, b - a)
            total = np.append(_U(0), np.cumsum(values, dtype=np.uint64))
            at, to = start[i:j] - a, end[i:j] - a
            out[i:j] = (total[to] - total[at]) * _power(_INVERSE, b - a + 1)[at]
        i = j
    return mix(out + (end - start).astype(np.uint64))
