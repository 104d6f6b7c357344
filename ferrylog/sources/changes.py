"""Change-event tables and the log position they reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrylog.operators.events import last_position
from ferrylog.schema import CHANGE_EVENTS


def read_change_events(spark: SparkSession, path: str, format="parquet", schema=CHANGE_EVENTS,
                       stream=False, **options) -> DataFrame:
    """The row-change feed as events, in batch or as a stream."""
    reader = spark.readStream if stream else spark.read
    return reader.format(format).schema(schema).options(**options).load(path)


def snapshot_position(events: DataFrame) -> DataFrame:
    """Current position and the latest transaction id, taken before a copy."""
    at = F.struct("file", "pos")
    top = last_position(events).select("file", "pos")
    gtid = events.agg(F.max_by("gtid", F.when(F.col("gtid").isNotNull(), at))).scalar()
    return top.withColumn("gtid", gtid)
