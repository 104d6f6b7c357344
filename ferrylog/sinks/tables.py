"""Table writers and target creation."""

from __future__ import annotations

from typing import Mapping, NamedTuple, Optional

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrylog.errors import first_line
from ferrylog.sources.tables import catalog_ddl, create_ddl

# Fixed value: rows per insert batch.
BATCH_SIZE = 1000


class JdbcTable(NamedTuple):
    url: str
    table: str
    properties: Mapping[str, str] = {}


def write_table(df: DataFrame, dst, batch_size=BATCH_SIZE, mode="append", format="parquet"):
    """Append rows to a JDBC table (in insert batches) or to a folder of files."""
    if isinstance(dst, JdbcTable):
        df.write.option("batchsize", batch_size).jdbc(dst.url, dst.table, mode, dict(dst.properties))
    else:
        df.write.mode(mode).format(format).save(dst)


STATUS = "table_name string, created boolean, error string"


def create_tables(spark: SparkSession, columns: DataFrame, database="default", drop=False,
                  format="parquet", types="spark") -> list[tuple]:
    """Create a catalog table per described table; one failure never stops the others.

    With ``types="mysql"`` the columns carry MySQL types, defaults and key flags.
    """
    if types not in ("spark", "mysql"):
        raise ValueError("types is 'spark' or 'mysql'")
    texts = catalog_ddl(columns) if types == "mysql" else create_ddl(columns).withColumn("properties", F.lit(""))
    results = []
    for row in texts.orderBy("table_name").collect():  # one row per table
        name = f"`{database}`.`{row.table_name}`"
        error: Optional[str] = None
        try:
            if drop:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            ddl = row.create_sql.replace(f"`{row.table_name}`", name, 1)
            noted = f" TBLPROPERTIES ({row.properties})" if row.properties else ""
            spark.sql(f"{ddl} USING {format}{noted}")
        except Exception as e:  # noqa: BLE001 - recorded per table
            error = first_line(e)
        results.append((row.table_name, error is None, error))
    return results


def create_target(spark: SparkSession, columns: DataFrame, database="default", drop=False,
                  format="parquet", types="spark") -> DataFrame:
    """``(table_name, created, error)`` of ``create_tables``."""
    return spark.createDataFrame(create_tables(spark, columns, database, drop, format, types), STATUS)


def copy_outcome(results: DataFrame) -> DataFrame:
    """Successes (result >= 0) and failures (< 0) per table, with a total line.

    The total line has a NULL table name.
    """
    return results.rollup("table_name").agg(
        F.count_if(F.col("result") >= 0).alias("success"),
        F.count_if(F.col("result") < 0).alias("failure"))
