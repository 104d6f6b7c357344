"""Row images: whole-row structs, their identity and their equality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from ferrylog.functions.text import col

ABSENT = b""  # identity of "no row"


def pack(columns) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def align(image, schema: T.StructType) -> Column:
    """The image with the fields, order and types of the target table."""
    image = col(image)
    return F.when(image.isNotNull(), F.struct(
        *[image.getField(f.name).cast(f.dataType).alias(f.name) for f in schema]))


def has_null(image, schema: T.StructType) -> Column:
    image = col(image)
    return reduce(lambda a, b: a | b, [image.getField(f.name).isNull() for f in schema])


def has_map(kind) -> bool:
    """Whether values of a type hold a map, which Spark can neither compare nor sort."""
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def _text(value: Column, kind) -> Column:
    """Text of a value, equal for equal values only: each part carries its length."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(kind)  # -0.0 equals 0.0
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)  # local time is ambiguous where clocks are set back
    elif isinstance(kind, T.ArrayType):
        value = F.array_join(F.transform(value, lambda v: _text(v, kind.elementType)), "")
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.concat(
            _text(e["key"], kind.keyType), _text(e["value"], kind.valueType)))
        value = F.array_join(F.array_sort(entries), "")
    elif isinstance(kind, T.StructType):
        value = F.when(value.isNotNull(), F.concat(F.lit(""), *[_text(value.getField(f.name), f.dataType) for f in kind]))
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))


def identity(image, schema: T.StructType) -> Column:
    """Digest of the whole image, as bytes: equal images, and no others, share one. NULL images give ABSENT.

    The first 128 bits of a SHA-256: digests are most of what a fold shuffles, and among 10**10
    images two share these bits with a chance of one in 10**18.
    """
    image = col(image)
    return F.when(image.isNull(), F.lit(ABSENT)).otherwise(
        F.unhex(F.substring(F.sha2(F.concat(*[_text(image.getField(f.name), f.dataType) for f in schema]), 256), 1, 32)))
