"""Row images to statement text, typed column by column so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ferrylog.functions.text import col
from ferrylog.schema import DELETE, INSERT, UPDATE

# Escapes of a quoted literal, in the order they are applied.
ESCAPES = [("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]


def quote_text(c) -> Column:
    out = col(c)
    for raw, escaped in ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit("'"), out, F.lit("'"))


def sql_literal(c, dtype: T.DataType) -> Column:
    """NULL, a bare number, 1/0 for booleans, hex for bytes, else quoted text."""
    c = col(c)
    if isinstance(dtype, T.BooleanType):
        text = F.when(c, F.lit("1")).otherwise(F.lit("0"))
    elif isinstance(dtype, T.NumericType):
        text = c.cast("string")
    elif isinstance(dtype, T.BinaryType):
        text = F.concat(F.lit("X'"), F.hex(c), F.lit("'"))
    else:
        text = quote_text(c.cast("string"))
    return F.when(c.isNull(), F.lit("NULL")).otherwise(text)


def _literals(image, image_type: T.StructType):
    image = col(image)
    return [(f.name, sql_literal(image.getField(f.name), f.dataType)) for f in image_type]


def _pairs(image, image_type, sep) -> Column:
    return F.concat_ws(sep, *[F.concat(F.lit(f"{name} = "), text)
                              for name, text in _literals(image, image_type)])


def render_insert(table, after, image_type) -> Column:
    names = ", ".join(f.name for f in image_type)
    values = F.concat_ws(", ", *[text for _, text in _literals(after, image_type)])
    return F.concat(F.lit("INSERT INTO "), col(table), F.lit(f" ({names}) VALUES ("),
                    values, F.lit(")"))


def render_update(table, before, after, image_type) -> Column:
    return F.concat(F.lit("UPDATE "), col(table), F.lit(" SET "), _pairs(after, image_type, ", "),
                    F.lit(" WHERE "), _pairs(before, image_type, " AND "))


def render_delete(table, before, image_type) -> Column:
    return F.concat(F.lit("DELETE FROM "), col(table), F.lit(" WHERE "),
                    _pairs(before, image_type, " AND "))


def render_change(image_type, op="op", table="table", before="before", after="after") -> Column:
    """The statement of one row change; other operations give NULL."""
    op = col(op)
    return (F.when(op == INSERT, render_insert(table, after, image_type))
             .when(op == UPDATE, render_update(table, before, after, image_type))
             .when(op == DELETE, render_delete(table, before, image_type)))


def map_literals(names, image, kinds) -> Column:
    """Literals of a text map in column order; ``kinds`` maps a name to number or boolean.

    For feeds of many tables, where the row is a map and not a typed struct.
    """
    image, kinds = col(image), col(kinds)

    def literal(name):
        value, kind = image[name], F.coalesce(kinds[name], F.lit("text"))
        return (F.when(value.isNull(), F.lit("NULL"))
                 .when(kind == "number", value)
                 .when(kind == "boolean", F.when(F.lower(value).isin("true", "1"), F.lit("1"))
                                           .otherwise(F.lit("0")))
                 .otherwise(quote_text(value)))

    return F.transform(col(names), literal)


def render_map_change(op, table, names, before, after, kinds) -> Column:
    """Statement of a row change whose images are text maps (empty maps are no image)."""
    def pairs(image, sep):
        return F.array_join(F.zip_with(col(names), map_literals(names, image, kinds),
                                       lambda n, v: F.concat(n, F.lit(" = "), v)), sep)

    op, table = col(op), col(table)
    return (F.when(op == INSERT,
                   F.concat(F.lit("INSERT INTO "), table, F.lit(" ("),
                            F.array_join(col(names), ", "), F.lit(") VALUES ("),
                            F.array_join(map_literals(names, after, kinds), ", "), F.lit(")")))
             .when(op == UPDATE,
                   F.concat(F.lit("UPDATE "), table, F.lit(" SET "), pairs(after, ", "),
                            F.lit(" WHERE "), pairs(before, " AND ")))
             .when(op == DELETE,
                   F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE "), pairs(before, " AND "))))


def statement_terminator(sql) -> Column:
    """End with one semicolon; blank statements become NULL."""
    sql = col(sql)
    blank = F.coalesce(F.regexp_replace(sql, r"[\x00-\x20]+", ""), F.lit("")) == ""
    return (F.when(blank, F.lit(None).cast("string"))
             .when(sql.endswith(";"), sql)
             .otherwise(F.concat(sql, F.lit(";"))))
