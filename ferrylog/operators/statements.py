"""Exported statements back to typed row changes.

Only the three shapes the exporter writes are read; every other text is kept
with an error. Escapes are first masked so that a quote always ends a literal,
which lets plain patterns cut a statement at any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ferrylog.functions.text import col
from ferrylog.operators.once import compute_once
from ferrylog.schema import DELETE, INSERT, UPDATE

_MARK = "\ufdd0"  # a noncharacter; itself escaped, so any text survives
_MASKS = [(_MARK, _MARK + "0"), ("\\\\", _MARK + "1"), ("\\'", _MARK + "2")]
_UNMASKS = [("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"),
            (_MARK + "2", "'"), (_MARK + "1", "\\"), (_MARK + "0", _MARK)]

_LITERAL = r"(X'[0-9A-F]*'|'[^']*'|[^\s,()';]+)"
_INSERT_HEAD = r"^INSERT INTO (\S+) \(([^)]*)\) VALUES \("
_INSERT_VALUES = r"(?s)^INSERT INTO \S+ \([^)]*\) VALUES \((.*)\)$"
_OTHER_HEAD = r"^(?:UPDATE|DELETE FROM) \S+"
_VALUE = r"(?:^|, )" + _LITERAL
_PAIR = r"( SET | WHERE |, | AND )(\S+) = " + _LITERAL


def _swap(c, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _typed(literal: Column, dtype: T.DataType) -> Column:
    """Value of a masked literal; NULL also where the text does not fit the type."""
    quoted = literal.startswith("'")
    inner = F.substring(literal, F.lit(2), F.length(literal) - 2)
    if isinstance(dtype, T.BinaryType):
        hexed = F.regexp_extract(literal, r"^X'([0-9A-F]*)'$", 1)
        return F.when(literal.startswith("X'"), F.unhex(hexed))
    text = F.when(quoted, _swap(inner, _UNMASKS)).when(literal != "NULL", literal)
    return text if isinstance(dtype, T.StringType) else text.try_cast(dtype)


def _literals(prefix, names, values, schema):
    """Literal text per column, looked up by name."""
    return {f"{prefix}{i}": F.get(values, F.array_position(names, F.lit(f.name)).cast("int") - 1)
            for i, f in enumerate(schema)}


def _image(prefix, schema, present):
    """The typed image, and whether every column has a literal that fits its type."""
    fits, fields = F.lit(True), []
    for i, f in enumerate(schema):
        text, value = F.col(f"{prefix}{i}"), F.col(f"{prefix}v{i}")
        fits = fits & text.isNotNull() & ((text == "NULL") | value.isNotNull())
        fields.append(value.alias(f.name))
    return F.when(present, F.struct(*fields)), ~present | F.coalesce(fits, F.lit(False))


def parse_statements(entries: DataFrame, schema: T.StructType, sql="sql") -> DataFrame:
    """Add op, database, table, before, after and ``error`` (NULL when read in full)."""
    kept, width = entries.columns, len(schema)
    t, insert, at = F.col("__t"), F.col("__insert"), F.col("__at")
    rows = compute_once(entries, __t=_swap(F.regexp_replace(col(sql), ";$", ""), _MASKS))
    rows = compute_once(
        rows, __insert=t.startswith("INSERT INTO "),
        __op=F.when(t.startswith("INSERT INTO "), F.lit(INSERT))
              .when(t.startswith("UPDATE "), F.lit(UPDATE))
              .when(t.startswith("DELETE FROM "), F.lit(DELETE)))
    rows = compute_once(
        rows,
        __head=F.when(insert, F.regexp_extract(t, _INSERT_HEAD, 0))
                .otherwise(F.regexp_extract(t, _OTHER_HEAD, 0)),
        __names=F.when(insert, F.split(F.regexp_extract(t, _INSERT_HEAD, 2), ", "))
                 .otherwise(F.regexp_extract_all(t, F.lit(_PAIR), F.lit(2))),
        __values=F.when(insert, F.regexp_extract_all(
            F.regexp_extract(t, _INSERT_VALUES, 1), F.lit(_VALUE), F.lit(1)))
            .otherwise(F.regexp_extract_all(t, F.lit(_PAIR), F.lit(3))),
        __seps=F.when(~insert, F.regexp_extract_all(t, F.lit(_PAIR), F.lit(1))))
    # The pieces put together again must be the statement: nothing was skipped.
    pairs = F.zip_with(F.zip_with("__seps", "__names", lambda s, n: F.concat(s, n, F.lit(" = "))),
                       "__values", lambda p, v: F.concat(p, v))
    rebuilt = F.when(insert, F.concat("__head", F.array_join("__values", ", "), F.lit(")"))) \
               .otherwise(F.concat("__head", F.array_join(pairs, "")))
    rows = compute_once(
        rows, __at=F.coalesce(F.array_position("__seps", F.lit(" WHERE ")).cast("int"), F.lit(0)),
        __whole=F.coalesce(rebuilt == t, F.lit(False)))

    def share(name, after):
        """SET part or WHERE part of the pairs; an insert is all after."""
        c = F.col(name)
        if after:
            return F.when(insert, c).otherwise(F.slice(c, F.lit(1), F.greatest(at - 1, F.lit(0))))
        return F.when(~insert & (at > 0), F.slice(c, F.greatest(at, F.lit(1)),
                                                  F.greatest(F.size(c) - at + 1, F.lit(0))))

    rows = compute_once(rows, __an=share("__names", True), __av=share("__values", True),
                 __bn=share("__names", False), __bv=share("__values", False))
    rows = compute_once(rows, **_literals("__a", F.col("__an"), F.col("__av"), schema),
                 **_literals("__b", F.col("__bn"), F.col("__bv"), schema))
    rows = compute_once(rows, **{f"__{side}v{i}": _typed(F.col(f"__{side}{i}"), f.dataType)
                          for side in "ab" for i, f in enumerate(schema)})

    op, has_after = F.col("__op"), F.col("__op").isin(INSERT, UPDATE)
    has_before = op.isin(UPDATE, DELETE)
    after, after_fits = _image("__a", schema, has_after)
    before, before_fits = _image("__b", schema, has_before)
    counted = ((~has_after | (F.size("__an") == width)) & (~has_before | (F.size("__bn") == width)))
    target = F.regexp_extract("__head", r"^(?:INSERT INTO|UPDATE|DELETE FROM) (\S+)", 1)
    error = (F.when(op.isNull(), F.lit("not a row statement"))
              .when(~F.col("__whole") | (has_before & (at < 1)), F.lit("statement shape"))
              .when(~(after_fits & before_fits & F.coalesce(counted, F.lit(False))),
                    F.lit("columns or values")))
    rows = compute_once(rows, op=op, database=F.substring_index(target, ".", 1),
                 table=F.regexp_extract(target, r"\.(.*)$", 1),
                 before=before, after=after, error=error)
    return rows.select(*kept, "op", "database", "table", "before", "after", "error")
