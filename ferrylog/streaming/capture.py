"""Capture a change-event stream and hand it to handlers and listeners."""

from __future__ import annotations

import logging
from collections import deque
from typing import Callable, NamedTuple, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ferrylog.errors import first_line
from ferrylog.functions.position import Position, start_from
from ferrylog.operators.events import (classify_events, filter_databases, filter_tables,
                                       fill_gtid, resolve_table_map, skip_ddl)
from ferrylog.session import delete_path, materialize, scratch_scope
from ferrylog.sources.files import child_names, exists

log = logging.getLogger(__name__)


class Handler(NamedTuple):
    """Rows it supports, and what it does with them in each micro-batch."""

    name: str
    supports: Column
    handle: Callable[[DataFrame, int], None]


class Handlers:
    """Registered handlers, run in the order they were added.

    With ``failed_path`` a handler sees every batch once and in order: the events of a
    batch it failed on are kept in its queue there, and so are those of all later batches
    until the queue has been worked off (``recover``). The other handlers go on. The
    oldest batch in its queue is how far a handler has come; it survives a restart.
    With ``recover_first`` every batch tries the queues before it runs. Without
    ``failed_path`` a failed batch is only recorded. Up to ``MOST_ERRORS`` errors are kept.
    """

    MOST_ERRORS = 1000

    def __init__(self, handlers: Sequence[Handler] = (), failed_path: Optional[str] = None, recover_first: bool = False):
        self.handlers, self.failed_path, self.recover_first = list(handlers), failed_path, recover_first
        self.errors: deque[tuple[int, str, str]] = deque(maxlen=self.MOST_ERRORS)

    def register(self, handler: Handler):
        self.handlers.append(handler)

    def remove(self, name: str):
        self.handlers = [h for h in self.handlers if h.name != name]

    def _place(self, handler: str, batch_id: int) -> str:
        return f"{self.failed_path}/{handler}/{batch_id:012d}"

    def queued(self, spark: SparkSession, handler: str) -> list[int]:
        """Batches that a handler has still to see, oldest first."""
        if not self.failed_path:
            return []
        names = child_names(spark, f"{self.failed_path}/{handler}")
        return [int(n) for n in names if exists(spark, f"{self.failed_path}/{handler}/{n}/_SUCCESS")]

    def run(self, events: DataFrame, batch_id: int):
        """A handler that throws is recorded and does not stop the others."""
        spark = events.sparkSession
        if self.recover_first:
            self.recover(spark)
        for handler in self.handlers:
            own = events.where(handler.supports)
            # A batch that runs again after a crash may stand in the queue itself.
            if any(n < batch_id for n in self.queued(spark, handler.name)):
                self._keep(own, handler, batch_id)
            elif self._handled(handler, own, batch_id):
                self._forget(spark, handler, batch_id)
            elif self.failed_path:
                self._keep(own, handler, batch_id)

    def _handled(self, handler: Handler, events: DataFrame, batch_id: int) -> bool:
        try:
            handler.handle(events, batch_id)
            return True
        except Exception as e:  # noqa: BLE001 - isolation is the contract
            log.exception("handler %s failed in batch %s", handler.name, batch_id)
            self.errors.append((batch_id, handler.name, first_line(e)))
            return False

    def _keep(self, events: DataFrame, handler: Handler, batch_id: int):
        events.write.mode("overwrite").parquet(self._place(handler.name, batch_id))

    def _forget(self, spark: SparkSession, handler: Handler, batch_id: int):
        if self.failed_path and exists(spark, self._place(handler.name, batch_id)):
            delete_path(spark, self._place(handler.name, batch_id))

    def failed(self, spark: SparkSession) -> list[tuple[int, str, str]]:
        """``(batch, handler, folder of its events)`` of what waits, by batch."""
        if not self.failed_path:
            return []
        return sorted((n, name, self._place(name, n)) for name in child_names(spark, self.failed_path) for n in self.queued(spark, name))

    def recover(self, spark: SparkSession) -> bool:
        """Work off the queues, each in the order of its batches up to the first that fails again; True if nothing waits."""
        for handler in self.handlers:
            for n in self.queued(spark, handler.name):
                if not self._handled(handler, spark.read.parquet(self._place(handler.name, n)), n):
                    break
                self._forget(spark, handler, n)
        return not self.failed(spark)


class CallbackListener(StreamingQueryListener):
    """Forwards stream life-cycle events to plain callbacks."""

    def __init__(self, on_connect=None, on_event=None, on_error=None, on_disconnect=None):
        self._connect, self._event = on_connect, on_event
        self._error, self._disconnect = on_error, on_disconnect

    def onQueryStarted(self, event):
        if self._connect:
            self._connect(event)

    def onQueryProgress(self, event):
        if self._event:
            self._event(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception and self._error:
            self._error(event.exception)
        if self._disconnect:
            self._disconnect(event)


class Capture:
    """Context, class and include lists for each micro-batch, then the handlers.

    The table map and transaction id in force at the end of a batch are saved
    under ``context_path/batch=<id>`` and seed the next batch: one row per table
    id, not per event. A repeated batch starts from the same seed. Only the last batch
    can be repeated, so contexts older than ``KEPT`` batches go.
    """

    KEPT = 10

    def __init__(self, context_path: str, handlers: Handlers, databases=None, tables=None,
                 start: Optional[Position] = None):
        self.context_path, self.handlers = context_path.rstrip("/"), handlers
        self.databases, self.tables, self.start = databases, tables, start

    def _seed(self, spark: SparkSession, batch_id: int) -> Optional[DataFrame]:
        past = [int(n.split("=")[1]) for n in child_names(spark, self.context_path)
                if n.startswith("batch=")]
        past = sorted(n for n in past if n < batch_id)
        for n in past[:-self.KEPT]:
            delete_path(spark, f"{self.context_path}/batch={n}")
        return spark.read.parquet(f"{self.context_path}/batch={max(past)}") if past else None

    def __call__(self, events: DataFrame, batch_id: int):
        with scratch_scope(events.sparkSession):
            self._run(events.sparkSession, events, batch_id)

    def _run(self, spark: SparkSession, events: DataFrame, batch_id: int):
        batch = materialize(start_from(events, self.start), "capture")
        seed = self._seed(spark, batch_id)
        seeded = batch if seed is None else batch.unionByName(seed, allowMissingColumns=True)
        is_seed = F.lit(False) if seed is None else F.coalesce("seed", F.lit(False))
        seeded = seeded.withColumn("seed", is_seed)

        maps = seeded.where("event_type = 'TABLE_MAP'")
        gtids = seeded.where("event_type = 'GTID'")
        whole = F.struct(*[c for c in seeded.columns if c != "seed"])
        keep = (maps.groupBy("table_id").agg(F.max_by(whole, "seq").alias("e")).select("e.*")
                    .unionByName(gtids.agg(F.max_by(whole, "seq").alias("e"))
                                      .where("e IS NOT NULL").select("e.*")))
        (keep.withColumn("seed", F.lit(True)).write.mode("overwrite")
             .parquet(f"{self.context_path}/batch={batch_id}"))

        with_gtid = fill_gtid(seeded)
        rows = resolve_table_map(with_gtid, ("database", "table"))
        rows = filter_tables(classify_events(rows.where("NOT seed")), self.databases, self.tables)
        # DDL has no table; it passes by database and goes to an audit handler.
        ddl = classify_events(with_gtid.where("NOT seed")).where("event_class = 'DDL'")
        ddl = skip_ddl(filter_databases(ddl, self.databases))
        out = rows.unionByName(ddl, allowMissingColumns=True).drop("seed")
        self.handlers.run(materialize(out, "captured"), batch_id)


def capture(events: DataFrame, job: Capture, state_path: str,
            interval: Optional[str] = "5 seconds") -> StreamingQuery:
    """Run a capture job on a streaming change feed; ``interval=None`` drains it."""
    writer = events.writeStream.foreachBatch(job).option("checkpointLocation", state_path)
    writer = (writer.trigger(availableNow=True) if interval is None
              else writer.trigger(processingTime=interval))
    return writer.start()
