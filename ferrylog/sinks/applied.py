"""A keyed table that changes are applied to, in hash buckets of its key.

A batch of changes is written as a run: its own rows, numbered in log order, and nothing
else. Readers fold the runs over the buckets they touch. Runs of like size are merged,
so there are only as many as the logarithm of their rows; once they come up to
``MERGE_SHARE`` of the buckets they touch, these are written anew with the runs folded
in. Buckets without changes are never read or written for that.

A version of the table is a small manifest: for each bucket the folder that holds its
rows, the runs, and the names of all batches that were applied. A batch publishes a
manifest named after itself; a reader sees the version before or the one after, and a
batch that is run again finds its name or writes its folder anew. One writer at a time.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple, Optional

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ferrylog.functions.images import align
from ferrylog.operators.fold import HOT_LIMIT, ORDER, apply_changes
from ferrylog.operators.numbering import number_rows
from ferrylog.session import delete_path, scratch_path
from ferrylog.sources.files import child_names, exists, folder_bytes

_BUCKET, _LOG = "__bucket", "__log"
#: Tasks that may write one bucket, and the size of a bucket when the table is created.
SHARES, BUCKET_BYTES = 8, 512 << 20
#: Bytes of runs, as a share of the buckets they touch, from which on these are written anew.
MERGE_SHARE = 0.25
#: Bytes of a file of a run, and manifests that are kept.
RUN_FILE, KEPT = 128 << 20, 10


class Run(NamedTuple):
    """Changes in log order, written but not yet folded: their folder, bytes and batches."""

    folder: str
    bytes: int
    first: int
    last: int


class BatchNames:
    """Names of applied batches; numbered ones, ``stream-7``, as ranges of their numbers."""

    def __init__(self, known=None):
        known = known or {"ranges": {}, "names": []}
        self.ranges, self.names = known["ranges"], known["names"]

    @staticmethod
    def _split(name: str):
        found = re.fullmatch(r"(.*)-(0|[1-9]\d{0,17})", name, re.S)
        return (found[1], int(found[2])) if found else None

    def __contains__(self, name: str) -> bool:
        split = self._split(name)
        return name in self.names if split is None else any(a <= split[1] <= b for a, b in self.ranges.get(split[0], ()))

    def plus(self, name: str) -> dict:
        split = self._split(name)
        if split is None:
            return {"ranges": self.ranges, "names": [*self.names, name]}
        out = []
        for a, b in sorted([*self.ranges.get(split[0], ()), [split[1], split[1]]]):
            if out and a <= out[-1][1] + 1:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return {"ranges": self.ranges | {split[0]: out}, "names": self.names}


class Version(NamedTuple):
    """A published state: folder and bytes of each bucket that has rows, number of buckets, columns,
    runs and the buckets they touch, applied batches."""

    number: int
    folders: dict
    buckets: int
    schema: T.StructType
    bytes: dict
    runs: tuple = ()
    touched: frozenset = frozenset()
    applied: dict = None


def _merged(runs: list[Run]) -> int:
    """How many of the last runs make up one: as long as a run is no more than twice what follows it."""
    taken, total = 1, runs[-1].bytes
    while taken < len(runs) and runs[-taken - 1].bytes <= 2 * total:
        total += runs[-taken - 1].bytes
        taken += 1
    return taken


class AppliedTable:
    def __init__(self, spark: SparkSession, root: str, keys, buckets: Optional[int] = None, null_match="safe",
                 hot_limit=HOT_LIMIT, merge_share: float = MERGE_SHARE):
        """``buckets`` counts for ``create`` only; by default it follows from the size of the rows."""
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.buckets = list(keys), buckets
        self.null_match, self.hot_limit, self.merge_share = null_match, hot_limit, merge_share
        self.data, self.versions = f"{self.root}/data", f"{self.root}/versions"

    # --- versions -----------------------------------------------------------

    def _latest(self) -> Optional[str]:
        """Name of the latest manifest that was written to its end."""
        return next((n for n in reversed(child_names(self.spark, self.versions)) if exists(self.spark, f"{self.versions}/{n}/_SUCCESS")), None)

    def _current(self) -> Version:
        name = self._latest()
        if name is None:
            raise RuntimeError(f"{self.root} holds no table")
        rows = self.spark.read.parquet(f"{self.versions}/{name}").collect()  # a row per bucket
        head = next(r for r in rows if r.bucket < 0)
        spec = json.loads(head.folder)
        own = [r for r in rows if r.bucket >= 0]
        return Version(int(name.split("-")[0]), {r.bucket: r.folder for r in own if r.folder is not None}, spec["buckets"],
                       T.StructType.fromJson(spec["schema"]), {r.bucket: r.bytes for r in own}, tuple(Run(*r) for r in spec["runs"]),
                       frozenset(r.bucket for r in own if r.touched), spec["applied"])

    def _publish(self, name, version: Version):
        spec = json.dumps({"buckets": version.buckets, "schema": version.schema.jsonValue(), "runs": version.runs, "applied": version.applied})
        rows = [(-1, spec, 0, False)] + [(b, version.folders.get(b), version.bytes.get(b, 0), b in version.touched)
                                         for b in sorted({*version.folders, *version.touched})]
        (self.spark.createDataFrame(rows, "bucket int, folder string, bytes long, touched boolean").coalesce(1)
             .write.mode("overwrite").parquet(f"{self.versions}/{name}"))
        for old in child_names(self.spark, self.versions)[:-KEPT]:
            delete_path(self.spark, f"{self.versions}/{old}")

    def is_applied(self, batch: str) -> bool:
        return self._latest() is not None and batch in BatchNames(self._current().applied)

    def vacuum(self):
        """Delete the buckets and runs that the current version does not use; readers of older ones must be done."""
        now = self._current()
        runs = {r.folder for r in now.runs}
        for folder in child_names(self.spark, self.data):
            for part in child_names(self.spark, f"{self.data}/{folder}"):
                bucket = part.startswith(f"{_BUCKET}=") and now.folders.get(int(part.partition("=")[2])) != folder
                if bucket or part == _LOG and folder not in runs:
                    delete_path(self.spark, f"{self.data}/{folder}/{part}")

    # --- rows ---------------------------------------------------------------

    def _bucket(self, columns, buckets):
        return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")

    def _rows(self, version: Version, wanted=None) -> DataFrame:
        paths = [f"{self.data}/{folder}/{_BUCKET}={b}" for b, folder in sorted(version.folders.items())
                 if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*paths)

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> list[int]:
        """Write rows by bucket, several tasks each; returns the buckets that got rows.

        The share of a row comes from a hash of its own, independent of the bucket's.
        """
        share = F.pmod(F.xxhash64(F.lit("share"), *self.keys), F.lit(SHARES))
        (rows.withColumn(_BUCKET, self._bucket(self.keys, buckets)).repartition(_BUCKET, share)
             .write.partitionBy(_BUCKET).mode("overwrite").parquet(f"{self.data}/{folder}"))
        names = child_names(self.spark, f"{self.data}/{folder}")
        return [int(n.partition("=")[2]) for n in names if n.startswith(f"{_BUCKET}=")]

    def _sizes(self, written, folder) -> dict:
        return {b: folder_bytes(self.spark, f"{self.data}/{folder}/{_BUCKET}={b}") for b in written}

    def create(self, rows: DataFrame):
        """Replace the table by ``rows``."""
        buckets, staged = self.buckets, None
        if buckets is None:
            staged = scratch_path(self.spark, "applied")
            rows.write.parquet(staged)
            rows = self.spark.read.schema(rows.schema).parquet(staged)
            buckets = max(8, -(-folder_bytes(self.spark, staged) // BUCKET_BYTES))
        latest = self._latest()
        number = int(latest.split("-")[0]) + 1 if latest else 0
        folder = f"{number:012d}"
        written = self._write(rows, folder, buckets)
        applied = self._current().applied if latest else None
        self._publish(folder, Version(number, dict.fromkeys(written, folder), buckets, rows.schema, self._sizes(written, folder), applied=applied))
        if staged:
            delete_path(self.spark, staged)

    def _log(self, version: Version, runs) -> DataFrame:
        image = version.schema.simpleString()
        return self.spark.read.schema(f"batch long, n long, op string, before {image}, after {image}").parquet(
            *[f"{self.data}/{r.folder}/{_LOG}" for r in runs])

    def _folded(self, version: Version, runs, touched) -> DataFrame:
        """The touched buckets with the runs folded in; batches one after another, each in log order."""
        rows = apply_changes(self._rows(version, touched), self._log(version, runs), self.keys, self.null_match, ("batch", "n"), self.hot_limit)
        return rows.select(*version.schema.names)

    def read(self) -> DataFrame:
        now = self._current()
        if not now.runs:
            return self._rows(now)
        clean = self._rows(now, set(now.folders) - now.touched)
        return clean.unionByName(self._folded(now, now.runs, now.touched))

    def apply(self, changes: DataFrame, batch: str, order=ORDER):
        """Apply one named batch once; repeating the name is a no-op."""
        now = self._current()
        names = BatchNames(now.applied)
        if batch in names:
            return
        # Images get the stored types first: a hash of a key depends on its type.
        typed = changes.select(*order, "op", align("before", now.schema).alias("before"), align("after", now.schema).alias("after"))
        number = now.number + 1
        folder = f"{number:012d}"
        # The folder of the run is not that of the buckets, which may be written from it.
        run_folder = f"{folder}r"
        run = self._write_run(number_rows(typed, list(order), "n").select(F.lit(number).cast("long").alias("batch"), "n", "op", "before", "after"), run_folder)
        runs = [*now.runs, Run(run_folder, folder_bytes(self.spark, f"{self.data}/{run_folder}/{_LOG}"), number, number)]
        keys = [[F.col(image).getField(k) for k in self.keys] for image in ("before", "after")]
        hit = (run.select(F.explode(F.array(*[F.when(F.col(image).isNotNull(), self._bucket(k, now.buckets))
                                              for image, k in zip(("before", "after"), keys)])).alias("b"))
               .where("b IS NOT NULL").distinct())
        touched = now.touched | {r.b for r in hit.collect()}  # at most one row per bucket
        after = now._replace(number=number, runs=tuple(runs), touched=touched, applied=names.plus(batch))
        fold = sum(r.bytes for r in runs) >= self.merge_share * sum(now.bytes.get(b, 0) for b in touched)
        after = self._fold_in(after, folder) if fold else self._merge_runs(after, folder)
        self._publish(f"{folder}-{batch}", after)
        if run_folder not in {r.folder for r in after.runs}:
            delete_path(self.spark, f"{self.data}/{run_folder}")  # no version has it

    def _write_run(self, rows: DataFrame, folder: str) -> DataFrame:
        path = f"{self.data}/{folder}/{_LOG}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _merge_runs(self, version: Version, folder: str) -> Version:
        """The last runs of like size as one. It lies in a folder of its own: the batch may be run again."""
        taken = _merged(list(version.runs))
        if taken == 1:
            return version
        own = version.runs[-taken:]
        name, total = f"{folder}m", sum(r.bytes for r in own)
        self._write_run(self._log(version, own).coalesce(max(1, total // RUN_FILE)), name)
        merged = Run(name, folder_bytes(self.spark, f"{self.data}/{name}/{_LOG}"), own[0].first, own[-1].last)
        return version._replace(runs=(*version.runs[:-taken], merged))

    def _fold_in(self, version: Version, folder: str) -> Version:
        """Write the touched buckets anew with all runs folded in."""
        written = self._write(self._folded(version, version.runs, version.touched), folder, version.buckets)
        if not version.touched.issuperset(written):
            delete_path(self.spark, f"{self.data}/{folder}")
            raise RuntimeError(f"rows belong to buckets that were not read: {sorted(set(written) - version.touched)}")
        keep = {b: f for b, f in version.folders.items() if b not in version.touched}
        return version._replace(folders=keep | dict.fromkeys(written, folder), runs=(), touched=frozenset(),
                                bytes={b: version.bytes[b] for b in keep} | self._sizes(written, folder))

    def compact(self):
        """Fold all runs in now."""
        now = self._current()
        if now.runs:
            folder = f"{now.number + 1:012d}"
            self._publish(folder, self._fold_in(now._replace(number=now.number + 1), folder))
