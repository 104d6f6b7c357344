"""Do two copies of a table agree?"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from ferrylog.session import is_empty, materialize

#: Levels of a digest tree are so many bits of the keys' hash apart; leaves have the last number of bits.
LEVELS = (4, 10, 16)


def table_checksum(df: DataFrame) -> DataFrame:
    """Order-free fingerprint: row count, and xor and sum of row hashes.

    The xor alone would miss rows repeated an even number of times.
    """
    names = sorted(df.columns)
    h = df.select(F.xxhash64(*names).alias("h"))
    return h.agg(F.count(F.lit(1)).alias("row_count"),
                 F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
                 F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0))
                  .cast("string").alias("hash_sum"))


def diff_tables(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing on the right, extra on the right, or changed.

    Both sides go through one grouped aggregate of a row hash: a single shuffle of
    key and hash, folded before it, so wide rows do not travel and a repeated key
    cannot blow up as it would in a join. Repeated keys compare as bags.
    """
    keys = list(keys)
    names = left.columns

    def side(df, is_left):
        h = F.xxhash64(*names).cast("decimal(38,0)")
        zero = F.lit(0).cast("decimal(38,0)")
        return df.select(*keys, F.lit(1 if is_left else 0).alias("l"),
                         F.lit(0 if is_left else 1).alias("r"),
                         (h if is_left else zero).alias("lh"),
                         (zero if is_left else h).alias("rh"))

    sums = side(left, True).unionByName(side(right, False)).groupBy(*keys).agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"),
        F.sum("lh").alias("lh"), F.sum("rh").alias("rh"))
    state = (F.when(F.col("right_rows") == 0, F.lit("missing"))
              .when(F.col("left_rows") == 0, F.lit("extra"))
              .when((F.col("lh") != F.col("rh")) | (F.col("left_rows") != F.col("right_rows")),
                    F.lit("changed")))
    return (sums.withColumn("state", state).where("state IS NOT NULL")
                .select(*keys, "state", "left_rows", "right_rows"))


# --- digest tree --------------------------------------------------------------

def _leaf(keys, bits):
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def digest_leaves(df: DataFrame, keys: Sequence[str], bits: int = LEVELS[-1]) -> DataFrame:
    """Fingerprints ``(node, row_count, hash_xor, hash_sum)`` of the ranges of the keys' hash.

    Folded before the shuffle: a task sends a row per range, however many rows it reads.
    """
    names = sorted(df.columns)
    h = df.select(_leaf(keys, bits).alias("node"), F.xxhash64(*names).alias("h"))
    return h.groupBy("node").agg(F.count(F.lit(1)).alias("row_count"), F.bit_xor("h").alias("hash_xor"),
                                 F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"))


def roll_up(digests: DataFrame, bits: int) -> DataFrame:
    """Fingerprints of the ranges one level up, each ``2 ** bits`` ranges of the level below."""
    return digests.groupBy(F.shiftrightunsigned("node", bits).alias("node")).agg(
        F.sum("row_count").alias("row_count"), F.bit_xor("hash_xor").alias("hash_xor"), F.sum("hash_sum").alias("hash_sum"))


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges whose fingerprints differ, or that only one side has."""
    marks = ("row_count", "hash_xor", "hash_sum")
    other = right.select(F.col("node").alias("__node"), *[F.col(m).alias(f"__{m}") for m in marks])
    same = F.lit(True)
    for m in marks:
        same = same & F.col(m).eqNullSafe(F.col(f"__{m}"))
    return left.join(other, F.col("node") == F.col("__node"), "full_outer").where(~same).select(F.coalesce("node", "__node").alias("node"))


def unequal_ranges(left: DataFrame, right: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """``node`` of the leaves that differ, found from the root down: only below unequal nodes are leaves compared."""
    steps = list(zip(levels[1:], levels))
    sides = [[left], [right]]
    for fine, coarse in reversed(steps):
        for side in sides:
            side.insert(0, roll_up(side[0], fine - coarse))
    found = _unequal(sides[0][0], sides[1][0])
    for level, (fine, coarse) in enumerate(steps, 1):
        above = found.select(F.col("node").alias("__above"))
        a, b = (side[level].join(F.broadcast(above), F.shiftrightunsigned("node", fine - coarse) == F.col("__above"), "left_semi") for side in sides)
        found = _unequal(a, b)
    return found


def rows_in_unequal_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], levels: Sequence[int] = LEVELS) -> tuple[DataFrame, DataFrame] | None:
    """Rows of both sides in the key ranges whose fingerprints differ; None if none do.

    Each side is read once for its fingerprints, and again for these rows.
    """
    right = right.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in left.schema])
    sides = [materialize(digest_leaves(df, keys, levels[-1]), "digests") for df in (left, right)]
    found = materialize(unequal_ranges(*sides, levels), "unequal-ranges")
    if is_empty(found):
        return None
    # At most one row a leaf, which bounds the broadcast.
    found = F.broadcast(found.select(F.col("node").alias("__leaf")))
    return tuple(df.join(found, _leaf([df[k] for k in keys], levels[-1]) == F.col("__leaf"), "left_semi") for df in (left, right))


def diff_by_digest(left: DataFrame, right: DataFrame, keys: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """What ``diff_tables`` gives; only rows in key ranges that differ are shuffled.

    The right side's columns are compared with the types of the left.
    """
    rows = rows_in_unequal_ranges(left, right, keys, levels)
    return diff_tables(*(rows or (left.limit(0), left.limit(0))), keys)
