"""Jump consistent hashing of stable keys to shards, in DataFrame functions only.

A 64-bit linear congruential generator seeded with the key draws the jumps: from
shard ``b`` the key next moves when the number of shards reaches
``floor((b + 1) * 2**31 / (draw + 1)) + 1``. The last jump below the shard count is
the shard, so a further shard only takes keys and no table of shards is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ferrylog.operators.numbering import number_rows

# Multiplier of the generator, and the range of its upper bits.
_MULTIPLIER = 2862933555777941757
_TOP = 1 << 31


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a whole number; null for a null key.

    The state is an unsigned 64-bit number, kept as a decimal of 20 digits; its
    product with the multiplier has at most 38, so nothing overflows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    modulus = F.lit(str(1 << 64)).cast("decimal(20,0)")
    seed = key.cast("decimal(20,0)")
    seed = F.when(seed < 0, seed + modulus).otherwise(seed).cast("decimal(20,0)")

    def jump(state, _):
        drawn = F.pmod(state["key"] * F.lit(str(_MULTIPLIER)).cast("decimal(19,0)") + F.lit(1), modulus).cast("decimal(20,0)")
        top = F.floor(drawn / F.lit(str(1 << 33)).cast("decimal(20,0)")).cast("double")
        target = F.floor((state["next"] + 1).cast("double") * (F.lit(float(_TOP)) / (top + 1.0)))
        moved = F.struct(drawn.alias("key"), state["next"].alias("shard"), target.cast("long").alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    start = F.struct(seed.alias("key"), F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))
    # The shard grows with every jump, so ``shards`` of them always suffice; all but a few are skipped.
    last = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)
    return F.when(key.isNotNull(), last["shard"].cast("int"))


def assign_shards(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (with one shard more).

    Columns so named before are replaced. A null key goes to shard 0 under both
    counts. Equal keys share a shard. No shuffle.
    """
    at = F.col(key)
    return rows.withColumns({"shard": F.coalesce(jump_hash(at, shards), F.lit(0)),
                             "grown_shard": F.coalesce(jump_hash(at, shards + 1), F.lit(0))})


def number_in_shards(placed: DataFrame, key: str) -> DataFrame:
    """Add ``slot``, from 0 without gaps in each shard in order of ``key``.

    Rows are numbered once over ``(shard, key)`` in range partitions, so a large
    shard spreads over many tasks; a shard's first number (one row a shard, which
    bounds the broadcast) is taken off. Repeated keys have slots of their own.
    """
    numbered = number_rows(placed, ["shard", key], "__row")
    first = numbered.groupBy("shard").agg(F.min("__row").alias("__first"))
    return (numbered.join(F.broadcast(first), "shard")
                    .withColumn("slot", F.col("__row") - F.col("__first")).drop("__row", "__first"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Place documents by ``doc_id``; the text only gives its size and checksum.

    A null text counts no bytes and has the checksum of nothing. Other columns are
    not read. An empty table gives no rows.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    facts = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                        F.crc32(text).alias("text_crc32"))
    return (number_in_shards(assign_shards(facts, "doc_id", shards), "doc_id")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    F.col("slot").cast("long").alias("slot"), "grown_shard"))


def _jumps_sql(shards: int) -> str:
    return f"""jumps AS (
  SELECT doc_id, CAST(doc_id AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616::HUGEINT ELSE 0 END AS key,
         CAST(-1 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS next, n
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES ({shards}), ({shards + 1})) AS counts(n)
  UNION ALL
  SELECT doc_id, drawn, next,
         CAST(floor(CAST(next + 1 AS DOUBLE) * (2147483648.0::DOUBLE / (CAST(drawn // 8589934592 AS DOUBLE) + 1))) AS BIGINT), n
  FROM (SELECT *, (key * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS drawn FROM jumps WHERE next < n))"""


#: DuckDB has no CRC: the byte table is built by eight shifts, then applied byte by byte.
SHARD_SQL = f"""WITH RECURSIVE {_jumps_sql(40)},
placed AS (SELECT doc_id, max(shard) FILTER (n = 40) AS shard, max(shard) FILTER (n = 41) AS grown FROM jumps GROUP BY doc_id),
bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
sums AS (
  SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS crc
  FROM documents, bytes)
SELECT s.doc_id, CAST(octet_length(encode(coalesce(s.text, ''))) + 16 AS BIGINT) AS size, CAST(s.crc AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(p.shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY p.shard ORDER BY s.doc_id) - 1 AS slot,
       CAST(p.grown AS INTEGER) AS grown_shard
FROM sums s JOIN placed p ON s.doc_id = p.doc_id"""
