"""Packing of token sequences into training sequences of a fixed capacity.

Pieces are laid into bins as they come. Then a local search raises the sum of squared
fills: the least filled bins give up their pieces, and underfull bins take the largest
of these that fits, or exchange one or two of their own pieces for it, so that fuller
bins get fuller and the given-up pieces shorter, until they need a bin less. Where that
ends above the lower bound, the search is run from best fit too. Pieces are spread over
groups of a bounded size; what a group leaves in underfull bins, and some of its bins of
small pieces, is packed again with that of other groups, until one group is left.
"""

from __future__ import annotations

import json
import math
import zlib
from bisect import bisect_right, insort
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from ferrylog.llm.bpe import PairTable, merge_many
from ferrylog.llm.words import cuts, slices, text_buffers
from ferrylog.session import materialize

CAPACITY = 2048
#: Pieces that one task packs at a time.
GROUP = 40_000
#: Words that a worker remembers.
MEMO = 500_000
#: Rounds of the local search without a gain after which it ends, and bins that it dissolves beyond those that should
#: go: ``SPARE`` at most, and in every other round from pieces as they come ``SHARE`` of all bins.
SEARCH_ROUNDS, SPARE, SHARE = 24, 16, 0.3
#: Of a group's bins, one in so many that is full of small pieces is packed again with what other groups leave.
RESERVE = 64


# White space between words, stops that may end a word, and the bytes of the
# letters A-Z, a-z and U+00C0 to U+00FF (behind C3; two of these are signs, not letters).
_SPACE, _ASCII, _BEHIND, _STOP = (np.zeros(256, bool) for _ in range(4))
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_BEHIND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_STOPS = np.array(sorted(b".,;:!?"))
_STOP[_STOPS] = True
#: Lower case of an ASCII byte, and of a byte behind C3.
_LOWER, _LOWER_BEHIND = np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER_BEHIND[[b for b in range(0x80, 0x9F) if b != 0x97]] += 32
#: Bytes of the texts that are encoded together.
TOGETHER = 1 << 21


class Remembered:
    """What ``encode`` gives for a list of byte strings; two generations, of which the older one is forgotten."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit, self.young, self.old = encode, limit, {}, {}

    def __call__(self, tokens: list[bytes]) -> list[bytes]:
        out = list(map(self.young.get, tokens))
        missing = [i for i, x in enumerate(out) if x is None]
        for i in missing:
            out[i] = self.old.get(tokens[i])
        new = [i for i in missing if out[i] is None]
        for i, ids in zip(new, self.encode([tokens[i] for i in new]) if new else []):
            out[i] = ids
        self.young.update((tokens[i], out[i]) for i in missing)
        if len(self.young) > self.limit // 2:
            self.old, self.young = self.young, {}
        return out


class WordVocabulary:
    """A vocabulary file of the tokenizers library for lower-case words with marked ends.

    Its ids for a text are those of the text's blank-separated words one after another:
    white space is dropped, no character combines across it, and no piece spans it.
    Words of plain Latin letters, perhaps before a stop, are cut from whole texts at once
    and merged here side by side; all others go through the pattern or to the library.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.end = spec["model"]["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.table = PairTable([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)),
                               [vocab[a + b] for a, b in pairs])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.findall = regex.compile(pattern).findall
        # Printable bytes stand for themselves in the file's alphabet, the others for the characters from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.byte = np.array([vocab[char[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[char[b] + self.end] for b in range(256)], np.int64)
        # Fixed by Unicode: letters whose lower case is one character of the same range, and composed already.
        self.simple = regex.compile(r"[\x21-\x7EÀ-ÿ]+").fullmatch
        self.letters, self.others = Remembered(self.merge, MEMO), Remembered(self.encode, MEMO // 8)

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of each lower-case pre-token as little-endian unsigned 32-bit integers."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.byte[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        return merge_many(symbols, lengths, self.table)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        texts = [w.decode() for w in words]
        own = [w for w in texts if self.simple(w) and "<|" not in w]
        cut = [self.findall(w.lower()) for w in own]
        tokens = list(set(chain.from_iterable(cut)))
        known = dict(zip(tokens, self.merge([t.encode() for t in tokens])))
        done = {w: b"".join(map(known.__getitem__, c)) for w, c in zip(own, cut)}
        rest = [w for w in texts if w not in done]
        for w, e in zip(rest, self.library.encode_batch(rest, add_special_tokens=False) if rest else []):
            done[w] = np.array(e.ids, "<u4").tobytes()
        return list(map(done.__getitem__, texts))

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray, final: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts ``data[offsets[i]:offsets[i + 1]]``, each behind the other with ``final`` at its end.

        A long text alone is encoded in pieces cut at white space.
        """
        base = int(offsets[0])
        if len(offsets) == 2 and offsets[1] - base > TOGETHER:
            ids = [self.encode_texts(data, np.array(cut), final)[0][:-1] for cut in cuts(data, base, int(offsets[1]))]
            ids = np.concatenate([*ids, np.array([final], np.uint32)])
            return ids, np.array([len(ids)])
        data, edges = data[base:int(offsets[-1])], (offsets - base).astype(np.int64)
        inside = ~_SPACE[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edge = edges[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]  # a word ends with its text
        opens[edge] = inside[edge]
        closes[edge - 1] = inside[edge - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if not len(start):
            return np.full(len(edges) - 1, final, np.uint32), np.arange(1, len(edges))
        letter = _ASCII[data]
        leads = np.flatnonzero(data[:-1] == 0xC3)
        behind = leads[_BEHIND[data[leads + 1]]] + 1
        letter[behind] = letter[behind - 1] = True
        odd = np.append(np.int32(0), np.cumsum(~letter, dtype=np.int32))  # bytes that are no letter, before each place
        odd = odd[end] - odd[start]
        stop = np.where((odd == 1) & (end - start > 1) & _STOP[data[end - 1]], data[end - 1], 0)
        plain = (odd == 0) | (stop > 0)
        low = _LOWER[data]
        low[behind] = _LOWER_BEHIND[data[behind]]
        code, parts = np.empty(len(start), np.int64), []
        for own, text, known, to in ((plain, low, self.letters, end - (stop > 0)), (~plain, data, self.others, end)):
            at = np.flatnonzero(own)
            if not len(at):
                continue
            size = to[at] - start[at]
            taken = np.zeros(len(text) + 1, np.int8)
            taken[start[at]] += 1  # one word at most begins, and one ends, at a place
            taken[to[at]] -= 1
            taken = np.cumsum(taken[:-1], dtype=np.int8).view(bool)
            coded = pa.Array.from_buffers(pa.large_binary(), len(at), [
                None, pa.py_buffer(np.append(0, np.cumsum(size))), pa.py_buffer(text[taken])]).dictionary_encode()
            code[at] = coded.indices.to_numpy().astype(np.int64) + len(parts)
            parts += known(coded.dictionary.to_pylist())
        parts += [self.last[b].astype("<u4").tobytes() for b in _STOPS] + [final.to_bytes(4, "little")]
        # What stands for each word, for its stop, and for the end of every text, in order.
        stopped = stop > 0
        words = np.searchsorted(start, edges)
        texts = np.arange(len(edges) - 1)
        place = np.cumsum(1 + stopped) - (1 + stopped) + np.repeat(texts, np.diff(words))
        closing = np.append(0, np.cumsum(1 + stopped))[words[1:]] + texts
        entry = np.full(int(closing[-1]) + 1, len(parts) - 1)
        entry[place] = code
        entry[place[stopped] + 1] = len(parts) - 1 - len(_STOPS) + np.searchsorted(_STOPS, stop[stopped])
        count = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4))
        ids = pa.LargeListArray.from_arrays(pa.array(count), pa.array(np.frombuffer(b"".join(parts), "<u4"))).take(pa.array(entry))
        ids, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy()[closing + 1]
        return ids, ends


_vocabularies: dict = {}


def _vocabulary(path: str) -> WordVocabulary:
    """One per worker and file, with what it remembers."""
    if path not in _vocabularies:
        _vocabularies[path] = WordVocabulary(path)
    return _vocabularies[path]


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` and, if asked for, ``ids``.

    A document is the ids of its text and ``end_id``; one longer than ``capacity`` is
    cut into pieces of that length, of which the last may be shorter. Null texts are
    empty. Repeated rows are documents of their own.
    """
    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(batches):
        vocabulary = _vocabulary(path)
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for a, b in slices(offsets, TOGETHER):
                ids, ends = vocabulary.encode_texts(data, offsets[a:b + 1], end_id)
                first = np.append(0, ends[:-1])
                pieces = -(-(ends - first) // capacity)
                row = np.repeat(np.arange(b - a), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                at = first[row] + number * capacity
                length = np.minimum(ends[row] - at, capacity)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                own = [raw[4 * x:4 * y] for x, y in zip(at.tolist(), (at + length).tolist())]
                out = [batch.column(0).slice(a, b - a).take(pa.array(row)), pa.array(number, pa.int32()),
                       pa.array(number * capacity, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(list(map(zlib.crc32, own)), pa.int64())]
                if with_ids:
                    out.append(pa.array(map(bytes, own), pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, T.StructType(fields))


def best_fit(sizes, capacity: int) -> list[list[int]]:
    """Bins as lists of indexes into ``sizes``; each piece, longest first, goes where it leaves the least room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []  # bit r of ``rooms``: there is a bin with room r
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


def _improve(bin_, room, pool, sizes):
    """Best change of one bin with the pool: ``(gain, pieces out, piece in)``.

    ``pool`` is sorted by size. A move takes a piece in, an exchange gives one or two
    pieces for it; the gain is what the bin gets fuller, at most ``room``.
    """
    best = (0, (), None)
    given = [()] + [(q,) for q in bin_] + [(p, q) for k, p in enumerate(bin_) for q in bin_[:k]]
    for out in given:
        base = sum(sizes[q] for q in out)
        at = bisect_right(pool, (base + room, math.inf)) - 1
        if at >= 0 and pool[at][0] - base > best[0]:
            best = (pool[at][0] - base, out, at)
            if best[0] == room:
                break
    return best


def as_they_come(sizes, capacity: int) -> list[list[int]]:
    """Bins as lists of indexes: each piece goes behind the one before it, or opens a bin."""
    bins, room = [], 0
    for i, size in enumerate(sizes):
        if size <= room:
            bins[-1].append(i)
            room -= size
        else:
            bins.append([i])
            room = capacity - size
    return bins


def pack(sizes, capacity: int = CAPACITY, rounds: int = SEARCH_ROUNDS, start=best_fit, share: float = 0, told=None) -> list[list[int]]:
    """The swap search from ``start``, until ``rounds`` rounds on end neither empty a bin nor raise the squared fill.

    Both are bounded by the sum of the sizes, so the search ends. ``told``, a dict, gets
    the rounds, the exchanges and the bins emptied.
    """
    bins = start(sizes, capacity)
    least, best, most, stalled = -(-sum(sizes) // capacity), [list(b) for b in bins], 0, 0
    told = {} if told is None else told
    told |= {"rounds": 0, "exchanges": 0, "emptied": 0}
    while stalled < rounds:
        extra = len(bins) - least
        if extra <= 0:
            break
        fill = [sum(sizes[i] for i in b) for b in bins]
        order = sorted(range(len(bins)), key=fill.__getitem__)
        wide = int(share * len(bins)) if stalled % 2 == 0 else 0
        donors = order[:max(wide, extra + min(SPARE, least // 4))]
        open_bins = [b for b in reversed(order[len(donors):]) if fill[b] < capacity]
        pool = sorted((sizes[i], i) for b in donors for i in bins[b])
        changed = False
        for b in open_bins:
            room = capacity - fill[b]
            while room and pool:
                gain, out, at = _improve(bins[b], room, pool, sizes)
                if not gain:
                    break
                _, piece = pool.pop(at)
                for q in out:
                    bins[b].remove(q)
                    insort(pool, (sizes[q], q))
                bins[b].append(piece)
                room -= gain
                changed = True
                told["exchanges"] += 1
        if not changed and not wide:
            if not share:
                break
            stalled += 1  # the next round is wide again
            continue
        gone, rest = set(donors), [i for _, i in pool]
        again = best_fit([sizes[i] for i in rest], capacity)
        told["rounds"] += 1
        told["emptied"] += len(donors) - len(again)
        bins = [x for b, x in enumerate(bins) if b not in gone] + [[rest[k] for k in x] for x in again]
        squared = sum(sum(sizes[i] for i in b) ** 2 for b in bins)
        stalled += 1
        if len(bins) < len(best):
            best, most, stalled = [list(b) for b in bins], squared, 0
        elif len(bins) == len(best) and squared > most:
            most, stalled = squared, 0
    return best


def pack_group(sizes, capacity: int = CAPACITY, told=None) -> list[list[int]]:
    """The search from pieces as they come, and from best fit where that ends above the lower bound; the better one counts."""
    bins = pack(sizes, capacity, start=as_they_come, share=SHARE, told=told)
    if (len(bins) - 1) * capacity >= sum(sizes):
        longest = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        other = pack([sizes[i] for i in longest], capacity)
        if len(other) < len(bins):
            bins = [[longest[k] for k in own] for own in other]
    return bins


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Offsets have no gaps. Pieces of full length are sequences by themselves. Underfull
    sequences of all groups are packed again, in ever fewer groups until one is left, so
    the waste does not grow with the number of groups; a few full ones of small pieces
    go with them, as these fit in anywhere. Where few pieces get into full sequences,
    the fuller half of each group's others stays as it is. Columns of ``pieces`` stay,
    but for those two names.
    """
    own = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    numbered = materialize(pieces.select(F.struct(*own).alias("piece"), F.col("length").cast("long").alias("length"),
                                         F.monotonically_increasing_id().alias("__row")), "pieces")
    schema = "__group long, __row long, length long, __bin long, offset long, __full boolean, __fuller boolean"

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__row").reset_index(drop=True)
        sizes = rows["length"].tolist()
        member, number, offset, full, fuller = [], [], [], [], []
        bins = pack_group(sizes, capacity)
        fill = [sum(sizes[i] for i in own) for own in bins]
        order = sorted(range(len(bins)), key=lambda b: (-fill[b], len(bins[b])))
        bins, whole_bins = [bins[b] for b in order], sum(x == capacity for x in fill)
        half = (len(bins) + whole_bins) // 2
        # The last of the full ones have the most pieces.
        whole_bins -= min(whole_bins, max(len(bins) // RESERVE, min(SPARE, len(bins) // 4)))
        for b, own in enumerate(bins):
            at = 0
            for i in own:
                member.append(i)
                number.append(b)
                offset.append(at)
                at += sizes[i]
            full += [b < whole_bins] * len(own)
            fuller += [b < half] * len(own)
        out = rows.iloc[member].assign(__bin=number, offset=offset, __full=full, __fuller=fuller)
        return out[["__group", "__row", "length", "__bin", "offset", "__full", "__fuller"]]

    whole = numbered.where(F.col("length") == capacity).select("__row", F.col("__row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_pieces, placed, stage = numbered.where(F.col("length") < capacity).select("__row", "length"), [whole], 1
    count = open_pieces.count()
    groups = max(1, -(-count // group))
    while True:
        dealt = open_pieces.withColumn("__group", F.pmod(F.xxhash64("__row", F.lit(stage)), F.lit(groups)))
        done = materialize(dealt.groupBy("__group").applyInPandas(packed, schema), "packed")
        # Sequence ids: pieces of full length have those of their rows, which are not negative; the others are below.
        sequence = -((F.col("__group") * F.lit(1 << 20) + F.col("__bin")) * F.lit(1 << 12) + F.lit(stage))
        if groups == 1:
            placed.append(done.select("__row", sequence.alias("sequence_id"), "offset"))
            break
        stays, before, count = F.col("__full"), count, done.where(~F.col("__full")).count()
        if count * 10 > before * 9:  # too few full sequences: only the emptier ones of each group meet those of others
            stays = F.col("__fuller")
            count = done.where(~stays).count()
        placed.append(done.where(stays).select("__row", sequence.alias("sequence_id"), "offset"))
        open_pieces, stage = done.where(~stays).select("__row", "length"), stage + 1
        # Groups of one sequence each leave all pieces; then half as many groups have two.
        groups = max(1, min(-(-count // group), groups // 2 if count == before else groups))
    where = placed[0]
    for more in placed[1:]:
        where = where.unionByName(more)
    return numbered.join(where, "__row").select("piece.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut and pack ``docs(doc_id, text)``."""
    pieces = cut_documents(docs, path, capacity)
    out = pack_pieces(pieces, capacity)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
