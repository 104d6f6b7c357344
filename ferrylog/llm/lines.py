"""Line deduplication over all documents, in DataFrame functions only.

Lines are compared by their key: white space stripped from both ends, A-Z in lower
case. Of a key that several documents hold, the document with the smallest id keeps
its lines and the others lose theirs. Only hashes and places are shuffled: the hashes
are range-partitioned and sorted by document and place, so the first document of a
key streams by before the others, and what comes back per document is a run-length
bitmap of the lines to keep. The text meets its bitmap once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ferrylog.session import materialize

#: White space of a line's ends, and the fewest code points of a key that counts.
SPACE, LEAST = " \t\n\x0b\f\r", 10
#: A key with more than one of so many lines is hot; so there are fewer hot keys than that.
HOT_SHARE = 2000
#: Counters of the sketch that finds hot keys; its error is far below a hot key's share.
COUNTERS = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The text that decides whether two lines are equal."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() of other letters would fold more than A-Z, but ASCII has no others.
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _version(text: Column) -> Column:
    """Tells rows that share an id apart; equal rows need no telling apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _entries(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, place, h1, h2)`` of every line whose key is long enough."""
    lines = docs.select("doc_id", _version(F.col("text")).alias("version"),
                        F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    key = line_key(F.col("line"))
    return (lines.where(F.char_length(F.btrim("line", F.lit(SPACE))) >= LEAST)
                 .select("doc_id", "version", "place", F.xxhash64(F.lit(0), key).alias("h1"),
                         F.xxhash64(F.lit(1), key).alias("h2")))


def _hot_hashes(entries: DataFrame) -> list[int]:
    """Hashes that hold more than a ``HOT_SHARE``-th of all lines: fewer than that many."""
    found = entries.agg(F.expr(f"approx_top_k(h1, {HOT_SHARE}, {COUNTERS})").alias("top"),
                        F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found.top or [] if r["count"] * HOT_SHARE > found.n]


def _later_lines(entries: DataFrame) -> DataFrame:
    """The entries that a document with a smaller id makes superfluous.

    Hot keys do not travel: their first document is a map-side minimum, and the few
    minima are broadcast. All other keys stream past in order.
    """
    hot = _hot_hashes(entries)
    streamed = entries.where(~F.col("h1").isin(hot)) if hot else entries
    order = (Window.partitionBy("h1", "h2").orderBy("doc_id", "version", "place")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    later = (streamed.repartitionByRange("h1", "h2")
                     .withColumn("first", F.first("doc_id").over(order))
                     .where(~F.col("doc_id").eqNullSafe(F.col("first")))
                     .select("doc_id", "version", "place"))
    if not hot:
        return later
    of_hot = entries.where(F.col("h1").isin(hot))
    first = of_hot.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"),
                                           F.bool_or(F.col("doc_id").isNull()).alias("null_first"))
    superfluous = F.col("doc_id").isNotNull() & (F.col("null_first") | (F.col("doc_id") > F.col("first")))
    return later.unionByName(of_hot.join(F.broadcast(first), ["h1", "h2"]).where(superfluous)
                                   .select("doc_id", "version", "place"))


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, n_dropped, flips)`` of the documents that lose lines.

    ``flips`` is the run-length form of the bitmap with a bit per line: the places
    where the bit changes, from the first line on, and it starts with "keep". Lines
    past the last flip are kept. ``version`` tells rows with the same id apart.
    """
    later = _later_lines(materialize(_entries(docs), "line-hashes"))
    places = later.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("place")).alias("p"))
    starts = F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) != x - 1))
    ends = F.transform(F.filter("p", lambda x, i: F.coalesce(F.get("p", i + 1) != x + 1, F.lit(True))), lambda x: x + 1)
    return places.select("doc_id", "version", F.size("p").cast("long").alias("n_dropped"),
                         F.sort_array(F.concat(starts, ends)).alias("flips"))


def _kept(lines: Column, flips: Column) -> Column:
    """The lines whose bit says "keep"."""
    def run(j):
        start = F.coalesce(F.get(flips, 2 * j - 1), F.lit(0))
        end = F.coalesce(F.get(flips, 2 * j), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.floor(F.size(flips) / 2).cast("int")), run))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` without their superfluous lines, with ``n_lines`` and ``n_dropped``.

    ``text`` holds the lines left, joined by a line feed; columns of these three names
    are replaced and all others stay. A null text is one empty line, and so is an empty
    one. Rows that share an id are one document: none of them loses a line to another.
    Rows without an id are one document too, before all others. An empty table gives
    no rows. A text is handled within its row, so a row's size bounds the memory.
    """
    bitmaps = keep_bitmaps(docs.select("doc_id", "text")).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), "n_dropped", "flips")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("__text"),
                       _version(F.col("text")).alias("__of"))
    met = rows.join(bitmaps, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__version")), "left")
    lines = _lines(F.col("__text"))
    done = met.select(
        "__row", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("flips").isNull(), F.col("__text")).otherwise(F.array_join(_kept(lines, F.col("flips")), "\n")).alias("text"))
    own = [c for c in docs.columns if c.lower() not in ("text", "n_lines", "n_dropped")]
    return done.select(*[F.col("__row").getField(c).alias(c) for c in own], "text", "n_lines", "n_dropped")


def digest(docs: DataFrame) -> DataFrame:
    """Per document the counts and the checksum of the text that is left."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


LINES_SQL = f"""WITH lines AS (
  SELECT doc_id, place, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents)),
keyed AS (SELECT doc_id, place, line, translate(bare, '{_UPPER}', '{_LOWER}') AS key FROM lines),
first AS (SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= {LEAST} GROUP BY key),
judged AS (SELECT k.doc_id, k.place, k.line, f.holder IS NOT NULL AND k.doc_id > f.holder AS gone
           FROM keyed k LEFT JOIN first f ON k.key = f.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
