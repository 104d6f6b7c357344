"""Watch an export folder and replay it; bounded runs; stream deduplication."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ferrylog.functions.position import Position, after_checkpoint, position_key
from ferrylog.operators.events import last_position
from ferrylog.plans.capture import ENTRY_ORDER, changes_of_entries
from ferrylog.session import delete_path, materialize, scratch_scope
from ferrylog.sinks.applied import AppliedTable
from ferrylog.sinks.ledger import read_checkpoint, save_checkpoint
from ferrylog.sources.exports import HEADERS, carry_headers, entries_of_blocks, parse_ranges, read_export_files, span_ends
from ferrylog.sources.files import child_names
from ferrylog.sources.growing import RANGE, stream_growing_exports

# Fixed value: pause between two looks at the folder.
SCAN_INTERVAL = "5 seconds"


def stream_sql_export(spark: SparkSession, folder: str, max_files: Optional[int] = None) -> DataFrame:
    """New export files as they appear, each once and whole; ``max_files`` bounds a micro-batch.

    For files that are complete when they appear: what is added to one later is not read.
    """
    limit = {} if max_files is None else {"maxFilesPerTrigger": max_files}
    return read_export_files(spark, folder, stream=True, **limit)


def stream_dedup(events: DataFrame, key="entry_id", watermark: Optional[tuple] = None) -> DataFrame:
    """Each id once. With ``(time column, delay)`` old ids are forgotten; else never.

    State is partitioned by id and lives in RocksDB, checkpointed by Spark.
    """
    if watermark is None:
        return events.dropDuplicates([key])
    return events.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])


#: Room for the offsets of one log file on the time line of positions.
FILE_SPAN = 1 << 33


def dedup_by_frontier(events: DataFrame, key="entry_id", file="file", pos="pos") -> DataFrame:
    """Each id once, in a stream that arrives in log order; ids before the frontier are forgotten.

    The frontier is the greatest position of the batches before. An id belongs to one
    position, so what lies before the frontier was seen: it is dropped, and its state
    goes. Positions are event times here, a millisecond an offset and files by the number
    their name ends in; the frontier's own position stays open, as its event may go on.
    Rows without a position count by id alone and are kept for ever.
    """
    number = position_key(file, pos, numeric_suffix=True).getField("number")
    at = F.timestamp_millis(number * F.lit(FILE_SPAN) + F.col(pos))
    return events.withColumn("__at", at).withWatermark("__at", "1 millisecond").dropDuplicates([key, "__at"]).drop("__at")


class Replay:
    """Replays micro-batches of export files onto an applied table.

    A batch is named by the stream and Spark's batch id, so a batch that is run
    again after a crash is applied once. The checkpoint moves after the table.

    Files may come whole or in blocks as they grow. Of files that were read in part, the
    headers in force at the end of a batch are kept under ``headers_path/batch=<id>``,
    one row a file, and seed the next batch; an event whose entries began in the batch
    before goes on, although its position is the checkpoint, also at the beginning of the
    next file.
    """

    KEPT = 10

    def __init__(self, spark: SparkSession, table: AppliedTable, schema: T.StructType,
                 stream_id: str, checkpoint_path: str, rejected_path: str,
                 table_name: Optional[str] = None, headers_path: Optional[str] = None):
        self.spark, self.table, self.schema = spark, table, schema
        self.stream_id, self.checkpoint_path = stream_id, checkpoint_path
        self.rejected_path, self.table_name = rejected_path, table_name
        self.headers_path = headers_path or f"{rejected_path.rstrip('/')}-headers"

    def __call__(self, files: DataFrame, batch_id: int):
        with scratch_scope(files.sparkSession):
            self._run(files.sparkSession, files, batch_id)

    def _seed(self, spark: SparkSession, batch_id: int) -> Optional[DataFrame]:
        past = sorted(n for n in (int(n.partition("=")[2]) for n in child_names(spark, self.headers_path) if n.startswith("batch=")) if n < batch_id)
        for n in past[:-self.KEPT]:
            delete_path(spark, f"{self.headers_path}/batch={n}")
        return spark.read.parquet(f"{self.headers_path}/batch={past[-1]}") if past else None

    def _entries(self, spark: SparkSession, files: DataFrame, batch_id: int) -> DataFrame:
        """Entries of the batch; ``goes_on`` marks those of the event that its file's last batch, or for a new file the files before, ended in."""
        if "text" in files.columns:
            return carry_headers(files).withColumn("goes_on", F.lit(False))
        blocks, seed = parse_ranges(files), self._seed(spark, batch_id)
        ends = span_ends(blocks, HEADERS)
        if seed is not None:
            ends = ends.unionByName(seed)
        last = [F.max_by(h, F.when(F.col(h).isNotNull(), F.col("span"))).alias(h) for h in HEADERS]
        (ends.groupBy("path").agg(*last, F.sum("blocks").alias("blocks")).withColumn("span", F.lit(-1).cast("bigint"))
             .write.mode("overwrite").parquet(f"{self.headers_path}/batch={batch_id}"))
        entries = materialize(entries_of_blocks(blocks, seed), "entries")
        if seed is None:
            return entries.withColumn("goes_on", F.lit(False))
        before = seed.select(F.element_at(F.split("path", "/"), -1).alias("__file"), F.col("file").alias("__f"), F.col("pos").alias("__p"))
        top = seed.where("file IS NOT NULL").agg(F.max(F.struct("file", F.coalesce("pos", F.lit(-1)).alias("pos"))).alias("__top"))
        begins = entries.where("NOT orphan").groupBy("source_file").agg(F.min(F.struct("file", "pos")).alias("__at"))
        new = begins.join(before, F.col("source_file") == F.col("__file"), "left_anti").join(top, F.col("__at") == F.col("__top"))
        before = before.unionByName(new.select(F.col("source_file").alias("__file"), F.col("__at.file").alias("__f"), F.col("__at.pos").alias("__p"))).distinct()
        same = (F.col("source_file") == F.col("__file")) & (F.col("file") == F.col("__f")) & (F.col("pos") == F.col("__p"))
        return entries.join(before.where("__f IS NOT NULL"), same, "left").withColumn("goes_on", F.col("__f").isNotNull()).drop("__file", "__f", "__p")

    def _run(self, spark: SparkSession, files: DataFrame, batch_id: int):
        batch = f"{self.stream_id}-{batch_id}"
        entries = self._entries(spark, files, batch_id)
        known = entries.where("NOT orphan").drop("orphan")
        if not self.table.is_applied(batch):
            checkpoint = read_checkpoint(spark, self.checkpoint_path, self.stream_id)
            fresh = after_checkpoint(known.where("NOT goes_on"), checkpoint).unionByName(known.where("goes_on")).drop("goes_on")
            parsed = changes_of_entries(fresh, self.schema, self.table_name)
            orphans = entries.where("orphan").drop("orphan", "goes_on").withColumn(
                "error", F.lit("text before the first header"))
            # Named by batch, so a repeated batch replaces its own rows.
            (parsed.rejected.unionByName(orphans).write.mode("overwrite")
                   .parquet(f"{self.rejected_path}/batch={batch_id}"))
            self.table.apply(parsed.changes, batch, ENTRY_ORDER)
        top = last_position(known).first()
        if top.file is not None:
            save_checkpoint(spark, self.checkpoint_path, self.stream_id,
                            Position(top.file, top.pos, top.gtid))


def watch_exports(spark: SparkSession, folder: str, replay: Replay, state_path: str,
                  interval: Optional[str] = SCAN_INTERVAL, max_files: Optional[int] = None,
                  range_bytes: int = RANGE) -> StreamingQuery:
    """Replay what is in the folder, then keep watching it, also files that go on growing.

    ``interval=None`` drains what is there and ends. New bytes are read in ranges of
    ``range_bytes``; an entry that is still being written waits for its end. With
    ``max_files``, which bounds the export files of one micro-batch, files are taken once
    and whole instead: they must be complete when they appear.
    """
    stream = (stream_growing_exports(spark, folder, range_bytes=range_bytes) if max_files is None
              else stream_sql_export(spark, folder, max_files))
    writer = stream.writeStream.foreachBatch(replay).option("checkpointLocation", state_path)
    writer = (writer.trigger(availableNow=True) if interval is None
              else writer.trigger(processingTime=interval))
    return writer.start()


def bounded_run(query: StreamingQuery, seconds: Optional[float] = None) -> bool:
    """Run until the query ends or the time is up; True if it ended by itself."""
    ended = query.awaitTermination(seconds) if seconds is not None else query.awaitTermination()
    if seconds is not None and not ended:
        query.stop()
    return bool(ended) or seconds is None
