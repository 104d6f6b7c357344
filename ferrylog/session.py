"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # RocksDB keeps streaming state off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app="ferrylog", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor shares, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="ferrylog-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/ferrylog/{label}-{uuid.uuid4().hex}"


_scope = threading.local()


def delete_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete what is materialized inside once the scope ends.

    For work whose results are written out within it, such as a micro-batch; a
    stream would otherwise fill the shared folder.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            delete_path(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors, and unlike a cached plan the
    result can be read many times with column pruning.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_while(df: DataFrame, label: str, open_rows) -> tuple[DataFrame, bool]:
    """Materialize one round of an iteration and tell whether rows remain open.

    The count is observed while the rows are written, so it costs no job. A task
    that runs twice can only count too many, which at worst adds a round.
    """
    seen = Observation()
    out = materialize(df.observe(seen, F.count_if(open_rows).alias("open")), label)
    return out, bool(seen.get.get("open"))


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Materialize and count the rows as they are written; a task that runs twice may count too many."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return out, int(seen.get.get("n") or 0)


#: Rows of a few numbers that one task writes with ease.
ROWS_PER_TASK = 50_000


def gathered(df: DataFrame, most: int) -> DataFrame:
    """``df``, of at most about ``most`` narrow rows, in no more tasks than these are worth.

    A round over few rows costs what its tasks and files cost, not its rows.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // ROWS_PER_TASK)))


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).isEmpty()
