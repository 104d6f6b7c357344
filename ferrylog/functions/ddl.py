"""DDL text: clean-up, skip rules and the type map."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ferrylog.functions.text import col, strip

# Statements and schemas whose DDL is never carried over.
TRANSACTION_WORDS = ["BEGIN", "COMMIT", "ROLLBACK"]
SYSTEM_SCHEMAS = ["MYSQL.", "INFORMATION_SCHEMA.", "PERFORMANCE_SCHEMA."]


def clean_ddl(sql) -> Column:
    """Drop the database prefix before a quoted name; restart AUTO_INCREMENT at 1."""
    bare = F.regexp_replace(col(sql), r"`[^`]+`\.`", "`")
    return F.regexp_replace(bare, r"AUTO_INCREMENT=\d+", "AUTO_INCREMENT=1")


def is_skipped_ddl(sql) -> Column:
    """Blank text, transaction words, or any mention of a system schema."""
    text = F.upper(strip(F.coalesce(col(sql), F.lit(""))))
    system = F.lit(False)
    for schema in SYSTEM_SCHEMAS:
        system = system | text.contains(schema)
    return (text == "") | text.isin(TRANSACTION_WORDS) | system


# Type name to Spark type, plain and unsigned.
_INTEGERS = {
    "tinyint": ("tinyint", "smallint"),
    "smallint": ("smallint", "int"),
    "mediumint": ("int", "int"),
    "int": ("int", "bigint"),
    "integer": ("int", "bigint"),
    "bigint": ("bigint", "decimal(20,0)"),
}
_PLAIN = {
    "bool": "boolean", "boolean": "boolean",
    "float": "float", "double": "double",
    "binary": "binary", "varbinary": "binary", "tinyblob": "binary", "blob": "binary",
    "mediumblob": "binary", "longblob": "binary", "bit": "binary",
    "date": "date", "datetime": "timestamp_ntz", "timestamp": "timestamp", "year": "smallint",
}


def mysql_type_to_spark(type_text) -> Column:
    """Column type text of the source to a Spark type name; unknown types are strings."""
    text = F.lower(strip(type_text))
    name = F.regexp_extract(text, r"^([a-z]+)", 1)
    unsigned = text.contains("unsigned")
    precision = F.regexp_extract(text, r"^[a-z]+\(([0-9]+)", 1).try_cast("int")
    scale = F.coalesce(F.regexp_extract(text, r"^[a-z]+\([0-9]+, *([0-9]+)", 1).try_cast("int"),
                       F.lit(0))
    out = F.when(text.isin("tinyint(1)", "bit(1)"), F.lit("boolean"))
    for word, (plain, wide) in _INTEGERS.items():
        out = out.when(name == word, F.when(unsigned, F.lit(wide)).otherwise(F.lit(plain)))
    for word, spark_type in _PLAIN.items():
        out = out.when(name == word, F.lit(spark_type))
    out = out.when(name.isin("decimal", "numeric") & (F.coalesce(precision, F.lit(10)) <= 38),
                   F.format_string("decimal(%d,%d)", F.coalesce(precision, F.lit(10)), scale))
    return out.otherwise(F.lit("string"))


# Spellings of the present moment as a default.
_NOW = r"^(CURRENT_TIMESTAMP|NOW|LOCALTIMESTAMP)(\([0-6]?\))?$"


def spark_default(default_value, spark_type) -> Column:
    """A column default of the source as SQL text for a Spark column; NULL for none or one without a counterpart."""
    text, kind = col(default_value), col(spark_type)
    quoted = F.concat(F.lit("'"), F.regexp_replace(text, r"([\\'])", r"\\$1"), F.lit("'"))
    moment = kind.startswith("timestamp")
    return (F.when(moment & F.upper(text).rlike(_NOW),
                   F.when(kind == "timestamp", F.lit("current_timestamp()")).otherwise(F.lit("localtimestamp()")))
             .when(moment & text.try_cast("timestamp_ntz").isNotNull(), F.concat(F.upper(kind), quoted))
             .when((kind == "date") & text.try_cast("date").isNotNull(), F.concat(F.lit("DATE"), quoted))
             .when(kind == "boolean", F.when(text.isin("1", "b'1'"), F.lit("true")).when(text.isin("0", "b'0'"), F.lit("false")))
             .when(kind == "string", quoted)
             .when(kind.rlike("int$|^float|^double|^decimal") & text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), text))
