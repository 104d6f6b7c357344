"""Table sources and their catalogs.

A source lists its tables and reads one as a DataFrame. Catalog rows are control
data (one per table or column); table rows stay in DataFrames.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, NamedTuple, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrylog import schema
from ferrylog.functions.ddl import clean_ddl, mysql_type_to_spark, spark_default
from ferrylog.functions.text import quote_ident
from ferrylog.sources.files import child_names


class KeyRange(NamedTuple):
    """Partitioned JDBC read: numeric column, bounds and number of partitions."""

    column: str
    lower: int
    upper: int
    partitions: int


class DirectorySource:
    """One file or folder per table: ``<root>/<name>.<format>``."""

    def __init__(self, spark: SparkSession, root: str, format="parquet",
                 keys: Optional[Mapping[str, Sequence[str]]] = None):
        self.spark, self.root, self.format = spark, root.rstrip("/"), format
        self.keys = dict(keys or {})

    def table_names(self):
        suffix = f".{self.format}"
        return [n[: -len(suffix)] for n in child_names(self.spark, self.root, suffix)]

    def read(self, table, part: Optional[KeyRange] = None) -> DataFrame:
        return self.spark.read.format(self.format).load(f"{self.root}/{table}.{self.format}")

    def count(self, table) -> DataFrame:
        """One row: ``row_count``."""
        return self.read(table).agg(F.count(F.lit(1)).alias("row_count"))

    def key_range(self, table, key, partitions) -> Optional[KeyRange]:
        """Files split themselves."""
        return None

    def columns(self, tables=None) -> DataFrame:
        return _columns_of(self, tables)

    def key_columns(self) -> DataFrame:
        return _declared_keys(self)


class CatalogSource(DirectorySource):
    """Tables of a session-catalog database."""

    def __init__(self, spark: SparkSession, database="default", keys=None):
        self.spark, self.database, self.keys = spark, database, dict(keys or {})

    def table_names(self):
        return sorted(t.name for t in self.spark.catalog.listTables(self.database)
                      if not t.isTemporary)

    def read(self, table, part=None) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{table}`")


# Catalog queries of a MySQL-style information schema.
INFORMATION_SCHEMA = {
    "tables": "SELECT table_name AS table_name FROM information_schema.tables "
              "WHERE table_schema = DATABASE() AND table_type = 'BASE TABLE'",
    "columns": "SELECT table_name AS table_name, ordinal_position AS ordinal, "
               "column_name AS column_name, column_type AS data_type, "
               "is_nullable = 'YES' AS nullable, column_default AS default_value, "
               "extra LIKE '%auto_increment%' AS is_auto_increment "
               "FROM information_schema.columns WHERE table_schema = DATABASE()",
    "keys": "SELECT table_name AS table_name, column_name AS column_name "
            "FROM information_schema.key_column_usage "
            "WHERE table_schema = DATABASE() AND constraint_name = 'PRIMARY'",
}


class JdbcSource:
    """Tables behind JDBC. ``queries`` gives the catalog queries of other databases."""

    def __init__(self, spark: SparkSession, url: str, properties=None, queries=None,
                 fetch_size=1000):
        self.spark, self.url = spark, url
        self.properties = {"fetchsize": str(fetch_size), **(properties or {})}
        self.queries = {**INFORMATION_SCHEMA, **(queries or {})}

    def query(self, text) -> DataFrame:
        rows = (self.spark.read.format("jdbc").options(**self.properties)
                .option("url", self.url).option("query", text).load())
        return rows.toDF(*[c.lower() for c in rows.columns])

    def table_names(self):
        return sorted(r[0] for r in self.query(self.queries["tables"]).collect())

    def read(self, table, part: Optional[KeyRange] = None) -> DataFrame:
        if part is None:
            return self.spark.read.jdbc(self.url, table, properties=self.properties)
        return self.spark.read.jdbc(self.url, table, column=part.column, lowerBound=part.lower,
                                    upperBound=part.upper, numPartitions=part.partitions,
                                    properties=self.properties)

    def count(self, table) -> DataFrame:
        """Counted by the database; only the number travels."""
        return self.query(f"SELECT COUNT(*) AS row_count FROM {table}").select(F.col("row_count").cast("bigint"))

    def key_range(self, table, key, partitions) -> Optional[KeyRange]:
        """Bounds for a read in parallel by a numeric key."""
        row = self.query(f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").first()
        return None if row.lo is None else KeyRange(key, int(row.lo), int(row.hi), partitions)

    def columns(self, tables=None) -> DataFrame:
        rows = _as(self.query(self.queries["columns"]), schema.COLUMN_CATALOG)
        return rows.where(F.col("table_name").isin(list(tables))) if tables else rows

    def key_columns(self) -> DataFrame:
        return _as(self.query(self.queries["keys"]), schema.PRIMARY_KEYS)


def _as(df, shape):
    return df.select(*[F.col(f.name).cast(f.dataType) for f in shape])


def _columns_of(source, tables=None) -> DataFrame:
    rows = [(table, i, f.name, f.dataType.simpleString(), f.nullable, None, False)
            for table in source.table_names() if not tables or table in tables
            for i, f in enumerate(source.read(table).schema, 1)]
    return source.spark.createDataFrame(rows, schema.COLUMN_CATALOG)


def _declared_keys(source) -> DataFrame:
    rows = [(table, column) for table, columns in source.keys.items() for column in columns]
    return source.spark.createDataFrame(rows, schema.PRIMARY_KEYS)


def scan_table(source, table, columns=None, part: Optional[KeyRange] = None) -> DataFrame:
    """One whole table, with an explicit column list if given."""
    df = source.read(table, part)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def list_tables(source) -> DataFrame:
    return source.spark.createDataFrame([(t,) for t in source.table_names()], "table_name string")


def column_catalog(source, tables=None) -> DataFrame:
    return source.columns(tables)


def primary_keys(source) -> DataFrame:
    return source.key_columns()


def attach_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Flag the key columns on the column catalog."""
    flagged = keys.distinct().withColumn("is_primary_key", F.lit(True))
    return (columns.join(flagged, ["table_name", "column_name"], "left")
                   .withColumn("is_primary_key", F.coalesce("is_primary_key", F.lit(False))))


def resume_key(catalog: DataFrame) -> DataFrame:
    """First key column of each table in column order."""
    return (catalog.where("is_primary_key").groupBy("table_name")
                   .agg(F.min_by("column_name", "ordinal").alias("resume_key")))


def create_ddl(columns: DataFrame) -> DataFrame:
    """CREATE TABLE text per table, columns in order."""
    line = F.concat_ws(" ", quote_ident("column_name"), "data_type",
                       F.when(~F.col("nullable"), F.lit("NOT NULL")))
    lines = F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line"))))
    return columns.groupBy("table_name").agg(F.concat(
        F.lit("CREATE TABLE "), quote_ident(F.first("table_name")), F.lit(" ("),
        F.array_join(lines["line"], ", "), F.lit(")")).alias("create_sql"))


def _lines(columns: DataFrame, *parts) -> DataFrame:
    """Column lines of each table in column order, and its key columns."""
    line = F.concat_ws(" ", quote_ident("column_name"), *parts)
    at = F.struct("ordinal", line.alias("line"), "column_name", "is_primary_key", "is_auto_increment")
    all_of = F.array_sort(F.collect_list(at))  # the columns of one table
    return columns.groupBy("table_name").agg(all_of.alias("c")).select(
        "table_name", F.array_join("c.line", ", ").alias("lines"),
        F.filter("c", lambda c: c["is_primary_key"])["column_name"].alias("keys"),
        F.filter("c", lambda c: c["is_auto_increment"])["column_name"].alias("counted"))


def mysql_ddl(columns: DataFrame, database: Optional[str] = None) -> DataFrame:
    """MySQL CREATE TABLE text per table with defaults, counters and the primary key, cleaned for another database.

    ``columns`` as ``attach_keys`` gives them. Column types stand as the source names them.
    """
    now = F.upper("default_value").rlike("^(CURRENT_TIMESTAMP|NOW)")
    text = F.concat(F.lit("'"), F.regexp_replace("default_value", "'", "''"), F.lit("'"))
    default = F.concat(F.lit("DEFAULT "), F.when(now, F.col("default_value")).otherwise(text))
    tables = _lines(columns, "data_type", F.when(~F.col("nullable"), F.lit("NOT NULL")), default,
                    F.when(F.col("is_auto_increment"), F.lit("AUTO_INCREMENT")))
    name = quote_ident("table_name") if database is None else F.concat(F.lit(f"`{database}`."), quote_ident("table_name"))
    key = F.when(F.size("keys") > 0, F.concat(F.lit(", PRIMARY KEY (`"), F.array_join("keys", "`, `"), F.lit("`)"))).otherwise(F.lit(""))
    counter = F.when(F.size("counted") > 0, F.lit(" AUTO_INCREMENT=1")).otherwise(F.lit(""))
    raw = F.concat(F.lit("CREATE TABLE "), name, F.lit(" ("), F.col("lines"), key, F.lit(")"), counter)
    return tables.select("table_name", clean_ddl(raw).alias("create_sql"))


def catalog_ddl(columns: DataFrame) -> DataFrame:
    """Spark CREATE TABLE text per table from MySQL column types, as ``(table_name, create_sql, properties)``.

    Types go through ``mysql_type_to_spark`` and defaults through ``spark_default``. Spark's
    file tables have no keys or counters; ``properties`` keeps their names for a later reader.
    """
    typed = columns.withColumn("data_type", mysql_type_to_spark("data_type"))
    tables = _lines(typed, "data_type", F.when(~F.col("nullable"), F.lit("NOT NULL")),
                    F.concat(F.lit("DEFAULT "), spark_default("default_value", "data_type")))
    noted = [F.when(F.size(c) > 0, F.concat(F.lit(f"'{name}' = '"), F.array_join(c, ","), F.lit("'")))
             for name, c in (("primary_key", "keys"), ("auto_increment", "counted"))]
    return tables.select(
        "table_name", F.concat(F.lit("CREATE TABLE "), quote_ident("table_name"), F.lit(" ("), F.col("lines"), F.lit(")")).alias("create_sql"),
        F.concat_ws(", ", *noted).alias("properties"))


def describe_source(source) -> DataFrame:
    """Every column of every table with key flags and the table's DDL."""
    columns = attach_keys(column_catalog(source), primary_keys(source))
    return columns.join(create_ddl(columns), "table_name")


def row_counts(source, tables=None) -> DataFrame:
    """Row count of every table: one row per table."""
    counts = [source.count(t).select(F.lit(t).alias("table_name"), "row_count")
              for t in (tables or source.table_names())]
    if not counts:
        return source.spark.createDataFrame([], "table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, counts)


def skip_empty_tables(counts: DataFrame) -> DataFrame:
    return counts.where("row_count > 0")


def table_exists(source, name: str) -> bool:
    """Exact name match; the name is not a pattern."""
    return name in source.table_names()
