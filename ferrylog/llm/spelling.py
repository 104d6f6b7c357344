"""Spelling variants: words that differ by one code point, grouped under their most frequent form.

Words are runs of Latin letters; one in 97 of a document's words is damaged first, so
that variants are there to be found. Pairs are found by dense tiles: code-point
matrices of two blocks of words are compared position by position, from the front and
from the back, and two words are near if their common prefix and suffix together reach
the longer length less one.

One of the two then reaches half of the longer length, so only words that share such a
prefix or suffix (and a length, or the next one) meet in a tile. Blocks of these groups
are compared pairwise; a large group makes many tiles, and many small ones share one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ferrylog.llm.words import PIECE, slices, text_buffers
from ferrylog.session import materialize, materialize_while

#: One word in so many is damaged; fewest code points and occurrences of a word; times more frequent a form is.
DAMAGE, LEAST_LENGTH, LEAST_COUNT, TIMES = 97, 5, 3, 2
#: Words of a block of a large group; rows of a tile of many small groups; comparisons at a time.
BLOCK, TILE_ROWS, AT_ONCE = 1024, 16_384, 1 << 21
#: Entries of partial counts that a task holds.
MOST_PARTS = 1 << 19

# Letters of a run are A-Z, a-z and U+00C0 to U+00FF, whose first byte is C3.
_LEAD = 0xC3
_ASCII = np.zeros(256, bool)
_ASCII[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


# --- checksums of id and word -------------------------------------------------

def _crc_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC, _LONGEST = _crc_bytes(), 255


def _crc_shifts() -> np.ndarray:
    """``[length, byte number, byte]``: what that byte of a checksum becomes behind so many more bytes."""
    out = np.empty((_LONGEST + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << np.uint32([[0], [8], [16], [24]])
    for n in range(1, _LONGEST + 1):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ _CRC[out[n - 1] & 255]
    return out


_SHIFT = _crc_shifts().reshape(-1)


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts in a row, from that of each and the bytes of the second (at most 255)."""
    at = length.astype(np.int64) * 1024
    out = second.copy()
    for k in range(4):
        out ^= _SHIFT[at + (k * 256) + ((first >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def _crc_of_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of many short byte strings, a position of all of them at a time."""
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")
    start, sizes = offsets[:-1][order], length[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(min(sizes.max(initial=0), _LONGEST))):
        n = int(np.searchsorted(-sizes, -k, "left"))  # the words longer than k
        state[:n] = (state[:n] >> np.uint32(8)) ^ _CRC[(state[:n] ^ data[start[:n] + k]) & np.uint32(255)]
    out = np.empty_like(state)
    out[order] = ~state
    return out


# --- words and their counts ---------------------------------------------------

def _letters(data: np.ndarray) -> np.ndarray:
    lead = data == _LEAD
    out = _ASCII[data] | lead
    out[1:] |= lead[:-1]
    return out


def _pieces(data, offsets):
    """``(bytes, offsets of texts, first text)``: whole texts together, and long ones cut between runs."""
    for first, last in slices(offsets):
        a, b = int(offsets[first]), int(offsets[last])
        if last - first > 1 or b - a <= PIECE:
            yield data[a:b], offsets[first:last + 1] - a, first
            continue
        while a < b:
            at = min(a + PIECE, b)
            while at < b:
                # A cut is right behind an ASCII byte that is no letter.
                ends = np.flatnonzero(~_ASCII[data[at:at + 4096]] & (data[at:at + 4096] < 128))
                if len(ends):
                    at += int(ends[0]) + 1
                    break
                at = min(at + 4096, b)
            yield data[a:at], np.array([0, at - a]), first
            a = at


def _piece_words(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray):
    """Distinct words of a piece with their counts, and the damaged ones one by one."""
    inside = _letters(data)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(opens)
    if not len(start):
        return None
    sizes = np.flatnonzero(closes) + 1 - start
    bounds = np.append(0, np.cumsum(sizes))
    letters = _LOWER[data[inside]]
    runs = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = runs.dictionary_encode()
    number, known = coded.indices.to_numpy(), coded.dictionary
    places, bytes_ = text_buffers(known)
    of_text = np.searchsorted(offsets, start, "right") - 1
    crc = joined_crc(marks[of_text], _crc_of_words(bytes_, places)[number], np.minimum(sizes, _LONGEST))
    for i in np.flatnonzero(sizes > _LONGEST):
        crc[i] = zlib.crc32(letters[bounds[i]:bounds[i + 1]].tobytes(), int(marks[of_text[i]]))
    hit = np.flatnonzero(crc % np.uint32(DAMAGE) == 0)
    counts = np.bincount(number, minlength=len(known)) - np.bincount(number[hit], minlength=len(known))
    damaged = []
    for h, word in zip(crc[hit].tolist(), known.take(pa.array(number[hit])).to_pylist()):
        gone = h % len(word)
        damaged.append(word[:gone] + word[gone + 1:])
    words = pa.chunked_array([known.cast(pa.string()), pa.array(damaged, pa.string())])
    n = pa.chunked_array([pa.array(counts), pa.array(np.ones(len(damaged), np.int64))])
    wanted = pc.and_(pc.greater_equal(pc.utf8_length(words), LEAST_LENGTH), pc.greater(n, 0))
    return pa.table({"word": words, "n": n}).filter(wanted)


def _count_words(batches):
    def folded(parts):
        out = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": out["word"], "n": out["n_sum"]})

    parts, held = [], 0
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        marks = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        offsets, data = text_buffers(batch.column("text"))
        for piece, edges, first in _pieces(data, offsets):
            words = _piece_words(piece, edges, marks[first:])
            if words is None:
                continue
            parts.append(words)
            held += len(words)
            if held > MOST_PARTS:
                parts = [folded(parts)]
                held = len(parts[0])
                if held > MOST_PARTS // 2:  # mostly new words: hand them on
                    yield from parts[0].to_batches(max_chunksize=1 << 16)
                    parts, held = [], 0
    if parts:
        yield from folded(parts).to_batches(max_chunksize=1 << 16)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of words of at least 5 code points that occur 3 times or more."""
    parts = docs.select("doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- near words -----------------------------------------------------------------

def _matrix(words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words against the front and against the back of ``width`` places, and lengths."""
    offsets, data = text_buffers(words)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(offsets[0], offsets[-1])
    front, back = np.zeros((len(size), width), np.uint8), np.zeros((len(size), width), np.uint8)
    column = at - np.repeat(offsets[:-1], size)
    front[row, column] = data[at]
    back[row, column + width - np.repeat(size, size)] = data[at]
    return front, back, size


def _common(a: np.ndarray, b: np.ndarray, backwards=False) -> np.ndarray:
    """Length of the common start (or end) of each row of ``a`` with each row of ``b``, in stacks of blocks."""
    width = a.shape[2]
    same = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    out = np.zeros(same.shape, np.uint8 if width < 256 else np.int32)
    for k in reversed(range(width)) if backwards else range(width):
        same &= a[:, :, None, k] == b[:, None, :, k]
        if not same.any():
            break
        out += same
    return out


def _near(front, back, rows_a, rows_b, longer, suffix_side, triangle):
    """Pairs of row numbers that are near, in stacks of blocks; -1 is no row.

    In tiles of a common suffix, pairs that share the prefix too are left to its tile.
    """
    starts = _common(front[rows_a], front[rows_b])
    total = starts.astype(np.int32) + _common(back[rows_a], back[rows_b], True)
    longer = longer[:, None, None]
    found = (total >= longer - 1) & (rows_a >= 0)[:, :, None] & (rows_b >= 0)[:, None, :]
    found &= ~(suffix_side[:, None, None] & (starts >= longer // 2))
    if triangle:
        found &= np.triu(np.ones(found.shape[1:], bool), 1)[None]
    g, i, j = np.nonzero(found)
    return rows_a[g, i], rows_b[g, j]


def _self_pairs(front, back, group, longer, side):
    """Near pairs within each of many groups; rows lie by group. Groups of about one size are stacked."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, len(group)))
    step = 2
    while step // 2 < size.max(initial=0):
        own = np.flatnonzero((size > step // 2) & (size <= step))
        many = max(1, AT_ONCE // (step * step))
        for k in range(0, len(own), many):
            some = own[k:k + many]
            place = np.arange(step)[None, :]
            rows = np.where(place < size[some][:, None], first[some][:, None] + place, -1)
            yield _near(front, back, rows, rows, longer[first[some]], side[first[some]], True)
        step *= 2


def _compare_tile(tile: pa.Table) -> pa.Table:
    """Per word of a tile: its near words there, and the most frequent of them."""
    tile = tile.combine_chunks().sort_by([("longer", "ascending"), ("side", "ascending"), ("stem", "ascending"), ("part", "ascending")])
    longer, side = tile["longer"].to_numpy().astype(np.int64), tile["side"].to_numpy() == 1
    part, n = tile["part"].to_numpy(), tile["n"].to_numpy()
    words = tile["latin"].combine_chunks()
    front, back, _ = _matrix(words, int(longer.max()))
    if part.max() < 0:
        stem = pc.dictionary_encode(tile["stem"].combine_chunks()).indices.to_numpy().astype(np.int64)
        pairs = list(_self_pairs(front, back, (stem << 32) + (longer << 1) + side, longer, side))
    elif tile["tile_a"][0].as_py() == tile["tile_b"][0].as_py():
        rows = np.arange(len(part))[None, :]
        pairs = list(_blocks(front, back, rows, rows, longer, side))
    else:
        rows_a = np.flatnonzero(part == tile["tile_a"][0].as_py())[None, :]
        rows_b = np.flatnonzero(part == tile["tile_b"][0].as_py())[None, :]
        pairs = list(_blocks(front, back, rows_a, rows_b, longer, side)) if rows_a.size and rows_b.size else []
    a = np.concatenate([p[0] for p in pairs] + [np.zeros(0, np.int64)]).astype(np.int64)
    b = np.concatenate([p[1] for p in pairs] + [np.zeros(0, np.int64)]).astype(np.int64)
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    # By word, then the largest count, then the smallest word; Latin-1 bytes order as code points do.
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(n))
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    head = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    near = np.diff(np.append(head, len(own)))
    names = tile["word"].combine_chunks()
    return pa.table({"word": names.take(pa.array(own[head])), "n_near": pa.array(near.astype(np.int64)),
                     "best": names.take(pa.array(other[head])), "best_n": pa.array(n[other[head]].astype(np.int64))})


def _blocks(front, back, rows_a, rows_b, longer, side):
    """Near pairs of two blocks of one group (or within one), some rows of the first at a time."""
    triangle, step = rows_a is rows_b, max(1, AT_ONCE // rows_b.shape[1])
    for k in range(0, rows_a.shape[1], step):
        a, b = _near(front, back, rows_a[:, k:k + step], rows_b, longer[:1], side[:1], False)
        keep = a < b if triangle else slice(None)
        yield a[keep], b[keep]


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, n_near, best, best_n)`` of the words of ``vocabulary(word, n)`` with a near word.

    Words must be distinct. A group of words that share half of their code points is
    split into blocks by a hash, and each pair of its blocks is a tile of its own.
    """
    length = F.char_length("word")
    halves = []
    for more in (0, 1):  # as the longer word of a pair, or as the shorter one
        half = F.floor((length + more) / 2).cast("int")
        for side, stem in ((0, F.left("word", half)), (1, F.right("word", half))):
            halves.append(F.struct((length + more).alias("longer"), F.lit(side).alias("side"), stem.alias("stem")))
    group = ["longer", "side", "stem"]
    places = vocabulary.select("word", "n", F.inline(F.array(*halves)))
    large = places.groupBy(*group).agg(F.count(F.lit(1)).alias("n_words")).where(F.col("n_words") > block)
    total = vocabulary.count() * 4
    shared = max(1, -(-total // TILE_ROWS))
    sized = places.join(large, group, "left").withColumn("blocks", F.ceil(F.col("n_words") / block).cast("int"))
    part = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    sized = sized.withColumn("part", F.coalesce(part, F.lit(-1)))
    meets = F.when(F.col("part") < 0, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (sized.withColumn("other", F.explode(meets))
                  .withColumns({"tile_a": F.least("part", "other"), "tile_b": F.greatest("part", "other")})
                  .withColumn("tile", F.when(F.col("part") < 0, F.pmod(F.xxhash64(*group), F.lit(shared)).cast("string"))
                                       .otherwise(F.concat_ws(":", *group)))
                  .select("tile", "tile_a", "tile_b", *group, "part", "word", "n", F.encode("word", "ISO-8859-1").alias("latin")))
    found = tiles.groupBy("tile", "tile_a", "tile_b").applyInArrow(
        _compare_tile, "word string, n_near long, best string, best_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.max("best_n").alias("best_n"),
        F.min_by("best", F.struct(-F.col("best_n"), F.col("best"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` by pointer doubling; counts double with every step, so there is no circle."""
    links, more = materialize(forms, "spelling-forms"), True
    links = links.select("word", F.col("form").alias("root"))
    while more:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step, more = materialize_while(links.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots", F.col("moved"))
        links = step.select("word", "root")
    return links


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word ``(word, form, root, n, n_near, form_n)``.

    A null text has no words, a null id damages as an empty one would, and rows that
    share an id count each. Only ``doc_id`` and ``text`` are read. A table without such
    words gives no rows. Texts are read in pieces cut between runs, so only a single
    run, however long, must fit in memory.
    """
    vocabulary = materialize(word_counts(docs), "spelling-words")
    near = materialize(near_words(vocabulary), "spelling-near")
    formed = vocabulary.join(near, "word", "left")
    has_form = F.coalesce(F.col("best_n") >= TIMES * F.col("n"), F.lit(False))
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(has_form, F.col("best")).alias("form"),
                           F.when(has_form, F.col("best_n")).alias("form_n"))
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    return (formed.join(roots, "word", "left")
                  .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


VARIANTS_SQL = f"""WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS h
  FROM runs, bytes),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT DISTINCT c.word, w.word AS other FROM cut c JOIN words w ON c.rest = w.word),
pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, other FROM longer UNION ALL SELECT other, word FROM longer),
ranked AS (
  SELECT p.word, p.other, w.n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS place
  FROM pairs p JOIN words w ON w.word = p.other),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= {TIMES} * w.n THEN r.other END AS form,
         CASE WHEN r.n >= {TIMES} * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
  SELECT word, form AS reached, 1 AS steps FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f LEFT JOIN roots r ON r.word = f.word"""
