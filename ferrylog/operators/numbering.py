"""Global row numbers and batches without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ferrylog.session import materialize

_SLOT = "__slot"


def number_rows(df: DataFrame, order_by, out="row_number") -> DataFrame:
    """Number rows 1..N in a total order.

    Rows are range-partitioned on the whole order key and sorted inside the
    partitions, so one hot file or key value still spreads over many tasks.
    The sorted rows are written once together with their partition slot; the
    offset of a partition is the row count of those before it (one small row
    per partition, which bounds both the window and the broadcast below).
    ``order_by`` must name a unique key.
    """
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn(_SLOT, F.monotonically_increasing_id()))
    placed = materialize(placed, "numbered")
    part, index = F.shiftright(_SLOT, 33), F.col(_SLOT) % F.lit(1 << 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part",
                            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return (placed.withColumn("__part", part)
                  .join(F.broadcast(offsets), "__part")
                  .withColumn(out, F.col("__offset") + index + 1)
                  .drop("__part", "__offset", _SLOT))


def block_number(row_number, size) -> Column:
    """Zero-based block of a one-based row number."""
    return F.floor((F.col(row_number) - 1) / F.lit(size)).cast("bigint")


def assign_batches(df: DataFrame, key, size=1000) -> DataFrame:
    """Copy batches in key order: row n belongs to batch (n-1) div size."""
    return number_rows(df, key, "row_no").withColumn("batch_no", block_number("row_no", size))


def progress_trail(batched: DataFrame, key) -> DataFrame:
    """Rows copied so far and last key after each batch.

    Row numbers are global, so the running total is the greatest number seen in
    the batch: one aggregation, no running window.
    """
    return batched.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.max("row_no").alias("migrated_rows"),
        F.max(key).alias("last_migrated_id"))


# Progress log steps of the copy and of the ledger.
COPY_STEP, LEDGER_STEP = 10000, 1000


def progress_milestones(trail: DataFrame, total, step=COPY_STEP) -> DataFrame:
    """Trail rows at a multiple of ``step`` or at the total (a value or a scalar column)."""
    total = total if isinstance(total, Column) else F.lit(total)
    done = F.col("migrated_rows")
    return trail.where((done % step == 0) | (done == total))


# Fixed value: statements in one export file.
STATEMENTS_PER_FILE = 10000


def roll_files(statements: DataFrame, order_by=("file", "pos", "row_no"),
               size=STATEMENTS_PER_FILE) -> DataFrame:
    """File number from 1, a new file after every ``size`` statements in log order."""
    return (number_rows(statements, list(order_by), "statement_no")
            .withColumn("file_no", block_number("statement_no", size) + 1))


# Fixed value: executed entries between two checkpoints.
CHECKPOINT_STEP = 100


def checkpoint_marks(entries: DataFrame, order_by=("file", "pos", "entry_no"),
                     step=CHECKPOINT_STEP) -> DataFrame:
    """Entries after which a checkpoint is saved: every ``step``-th and the last."""
    numbered = number_rows(entries, list(order_by), "executed")
    last = numbered.select(F.max("executed").alias("executed")).scalar()
    return numbered.where((F.col("executed") % step == 0) | (F.col("executed") == last))
