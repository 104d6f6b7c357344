"""Export files back to entries.

A file is a sequence of blocks, each opened by a ``[POSITION]`` line and holding
an optional ``[GTID]`` line and a statement. A file is cut into blocks once, so
there is one row per statement, not one per line. Files are read in byte ranges;
the headers in force at the start of a range come from a scan over the ranges' ends.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ferrylog.functions.text import colon_parts, part, strip, to_bigint
from ferrylog.session import is_empty, materialize

# Line marks of the export format.
POSITION, GTID, COMMENT = "[POSITION]", "[GTID]", "--"
# Characters that may stand before a mark on its line.
LINE_BLANKS = r"[\x00-\x09\x0b\x0c\x0e-\x20]*"
_BLOCK_START = rf"(?:^|(?<=[\n\r]))(?={LINE_BLANKS}\[POSITION\])"


def read_export_files(spark: SparkSession, path: str, stream=False, glob="*.sql", **options) -> DataFrame:
    """Whole export files ``(source_file, text)``; the exporter's roll size bounds them."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    return (reader.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
                  .select(F.col("_metadata.file_name").alias("source_file"),
                          F.col("value").alias("text")))


def _headers(block: Column, lines: Column) -> dict:
    """Headers and statement of a block; ``lines`` are its own, stripped, without blank and comment lines.

    The position line opens its block; a later one cannot occur inside it. An empty
    transaction id marks a reset until it is turned into NULL by what carries it.
    """
    headed = F.coalesce(F.get(lines, F.lit(0)), F.lit("")).startswith(POSITION)
    gtids = F.filter(lines, lambda s: s.startswith(GTID))
    body = F.filter(lines, lambda s: ~s.startswith(GTID) & ~s.startswith(POSITION))
    mark = colon_parts(strip(F.substring(F.get(lines, F.lit(0)), len(POSITION) + 1, 1 << 30)))
    valid = headed & (F.size(mark) == 2)
    return {"file": F.when(valid, part(mark, 0)), "pos": F.when(valid, to_bigint(part(mark, 1))),
            "gtid": F.when(F.size(gtids) > 0, strip(F.substring(F.element_at(gtids, -1), len(GTID) + 1, 1 << 30))),
            "sql": F.array_join(body, " ")}


def _parse_blocks(blocks: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns and the headers and statement of ``block``."""
    lines = F.filter(F.transform(F.split("block", r"\r\n|\r|\n"), strip), lambda s: (s != "") & ~s.startswith(COMMENT))
    cut = blocks.select(*kept, "block", lines.alias("lines"))
    return cut.select(*kept, *[c.alias(n) for n, c in _headers(F.col("block"), F.col("lines")).items()])


def carry_headers(files: DataFrame) -> DataFrame:
    """Whole files to entries, one per block, with the headers in force.

    A malformed position keeps the previous file and offset. A transaction id
    holds until the next ``[GTID]`` line; an empty one resets it. ``orphan``
    marks text before the first header, which belongs to no entry.
    """
    blocks = (files.select("source_file", F.posexplode(F.split("text", _BLOCK_START)).alias("entry_no", "block"))
                   .withColumn("entry_no", F.col("entry_no").cast("bigint")))
    upto = (Window.partitionBy("source_file").orderBy("entry_no")
                  .rowsBetween(Window.unboundedPreceding, 0))
    carried = _parse_blocks(blocks, "source_file", "entry_no").withColumns({
        "file": F.last("file", ignorenulls=True).over(upto),
        "pos": F.coalesce(F.last("pos", ignorenulls=True).over(upto), F.lit(-1)),
        "gtid": F.nullif(F.last("gtid", ignorenulls=True).over(upto), F.lit("")),
    })
    return _told(carried)


def _told(carried: DataFrame) -> DataFrame:
    return (carried.where("sql <> ''")
                   .select("source_file", "entry_no", "file", "pos", "gtid", "sql", F.col("file").isNull().alias("orphan")))


# --- byte ranges ------------------------------------------------------------

HEADERS = ("file", "pos", "gtid")
#: Bytes of text that a task reads at least, in one range or several, once all cores have work.
TASK_BYTES = 16 << 20


def span_ends(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """``(path, span, values, blocks)``: the last value of each kind in a range, and its number of rows."""
    last = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col("place"))).alias(v) for v in values]
    return rows.groupBy("path", "span").agg(*last, F.count(F.lit(1)).alias("blocks"))


def carry_over_spans(rows: DataFrame, values: Sequence[str], seed: Optional[DataFrame] = None) -> DataFrame:
    """The latest value at or before each row of its file, and ``entry_no``, the rows before it.

    Rows ``(path, span, place, ..)`` lie in byte ranges of bounded size, so a window
    inside a range bounds its group; what reaches a range from those before it is
    carried on one row per range. ``seed`` holds such rows for files that were read in part.
    """
    ends = span_ends(rows, values)
    if seed is not None:
        ends = ends.unionByName(seed.select("path", F.lit(-1).cast("bigint").alias("span"), *values, "blocks"))
    before = Window.partitionBy("path").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    reach = ends.select(F.col("path").alias("__path"), F.col("span").alias("__span"),
                        *[F.last(v, ignorenulls=True).over(before).alias(f"__{v}") for v in values],
                        F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("__blocks"))
    inside = Window.partitionBy("path", "span").orderBy("place")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns({v: F.last(v, ignorenulls=True).over(upto) for v in values}
                           | {"entry_no": F.row_number().over(inside).cast("bigint") - 1})
    met = own.join(reach, (F.col("path") == F.col("__path")) & (F.col("span") == F.col("__span")))
    return met.withColumns({v: F.coalesce(v, f"__{v}") for v in values} | {"entry_no": F.col("entry_no") + F.col("__blocks")}).drop(
        "__path", "__span", "__blocks", *[f"__{v}" for v in values])


def entries_of_blocks(parsed: DataFrame, seed: Optional[DataFrame] = None) -> DataFrame:
    """Entries of parsed blocks ``(path, source_file, span, place, file, pos, gtid, sql)``, as ``carry_headers`` gives them."""
    carried = carry_over_spans(parsed, HEADERS, seed)
    return _told(carried.withColumns({"pos": F.coalesce("pos", F.lit(-1)), "gtid": F.nullif("gtid", F.lit(""))}))


def parse_ranges(blocks: DataFrame) -> DataFrame:
    """Blocks ``(path, source_file, span, place, block)`` parsed once, and written once."""
    return materialize(_parse_blocks(blocks, "path", "source_file", "span", "place"), "export-blocks")


def _tasks(spark: SparkSession, path: str) -> int:
    """As many tasks as the bytes of all files under ``path`` ask for."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    size = sum(files.getContentSummary(x.getPath()).getLength() for x in files.globStatus(pattern) or [])
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def _read_records(spark: SparkSession, path: str, glob: str, tasks: int) -> DataFrame:
    """What lies between two marks, in at most so many tasks.

    The mark is the reader's line end, so a task finds the first one in its range and
    reads the last record on beyond it. ``first``: the record is the first of its range.
    """
    raw = (spark.read.text(path, lineSep=POSITION, pathGlobFilter=glob, recursiveFileLookup=True)
                .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source_file"),
                        F.col("_metadata.file_block_start").alias("span"), F.col("value").alias("text")))
    # Ranges may be small; a task takes several one after another, and none is cut.
    raw = raw.coalesce(tasks).withColumn("place", F.monotonically_increasing_id())
    inside = Window.partitionBy("path", "span").orderBy("place")
    # A mark opens a block only where a line begins.
    at_line = F.col("text").rlike(rf"[\n\r]{LINE_BLANKS}\z")
    blank = F.col("text").rlike(rf"\A{LINE_BLANKS}\z")
    first = F.row_number().over(inside) == 1
    return (raw.withColumns({"first": first, "prefix": first & (F.col("span") == 0), "at_line": at_line, "blank": blank})
               .withColumn("at_line", F.col("at_line") | (F.col("prefix") & F.col("blank"))).drop("blank")
               .withColumn("opens", F.lag("at_line").over(inside)))


def read_export_blocks(spark: SparkSession, path: str, glob="*.sql") -> DataFrame:
    """Parsed blocks of export files ``(path, source_file, span, place, file, pos, gtid, sql)``.

    A file is read in byte ranges by several tasks and each block is parsed once, where
    it is read. The text is kept of the few records that may belong to the block before
    them: the first of a range, and those around a mark that no line begins with. A mark
    that is the very end of a file, without a line end, is not seen.
    """
    tasks = _tasks(spark, path)
    records = _read_records(spark, path, glob, tasks).where(~(F.col("prefix") & (F.col("text") == "")))
    block = F.when(F.col("prefix"), F.col("text")).otherwise(F.concat(F.lit(POSITION), F.col("text")))
    doubtful = F.col("first") | ~F.col("at_line") | ~F.coalesce("opens", F.lit(True))
    kept = ("path", "source_file", "span", "place", "prefix", "first", "at_line", "opens", "text")
    staged = materialize(_parse_blocks(
        records.withColumns({"block": block, "text": F.when(doubtful, F.col("text"))}), *kept), "export-records").coalesce(tasks)
    # Whether the first record of a range opens a block is known from the last one of the ranges before.
    reach = span_ends(staged.select("path", "span", "place", "at_line"), ["at_line"])
    before = Window.partitionBy("path").orderBy("span")
    reach = reach.select(F.col("path").alias("__path"), F.col("span").alias("__span"), F.lag("at_line").over(before).alias("__opens"))
    known = staged.join(reach, F.col("first") & (F.col("path") == F.col("__path")) & (F.col("span") == F.col("__span")), "left")
    known = known.withColumn("opens", F.coalesce(F.when(F.col("first"), F.col("__opens")).otherwise(F.col("opens")), F.lit(True)))
    known = known.drop("__path", "__span", "__opens")
    names = ["path", "source_file", "span", "place", *HEADERS, "sql"]
    if is_empty(known.where(~F.col("opens"))):
        return known.select(*names)
    # A record that opens nothing continues the block before it.
    known = known.withColumn("start", F.when(F.col("opens"), F.struct("span", "place")))
    known = carry_over_spans(known, ["start"])
    torn = known.where(~F.col("opens")).select("path", "start").distinct()
    whole = known.join(torn, ["path", "start"], "left_anti").select(*names)
    parts = known.join(torn, ["path", "start"], "left_semi").groupBy("path", "source_file", "start").agg(
        F.bool_or("prefix").alias("prefix"), F.array_sort(F.collect_list(F.struct("span", "place", "text"))).alias("parts"))
    joined = F.array_join(F.col("parts.text"), POSITION)
    joined = F.when(F.col("prefix"), joined).otherwise(F.concat(F.lit(POSITION), joined))
    mended = _parse_blocks(parts.select("path", "source_file", "start.span", "start.place", joined.alias("block")),
                           "path", "source_file", "span", "place")
    return whole.unionByName(mended)


def read_sql_export(spark: SparkSession, path: str) -> DataFrame:
    """Entries of every ``*.sql`` file under a folder; large files are read by many tasks."""
    return entries_of_blocks(read_export_blocks(spark, path)).where("NOT orphan").drop("orphan")


def order_files(files: DataFrame) -> DataFrame:
    return files.orderBy("source_file")


def union_entries(*entries: DataFrame) -> DataFrame:
    out = entries[0]
    for more in entries[1:]:
        out = out.unionByName(more)
    return out


def dedup_entries(entries: DataFrame, key="entry_id",
                  order=("file", "pos", "source_file", "entry_no")) -> DataFrame:
    """First entry of each id. One grouped aggregate, so copies fold before the shuffle."""
    whole = F.struct(*entries.columns)
    return (entries.groupBy(key).agg(F.min_by(whole, F.struct(*order)).alias("e"))
                   .select("e.*"))


def number_repeats(entries: DataFrame) -> DataFrame:
    """``repeat_no``: which of the equal statements of one event in its file this is."""
    same = Window.partitionBy("source_file", "file", "pos", F.sha2("sql", 256)).orderBy("entry_no")
    return entries.withColumn("repeat_no", F.row_number().over(same))


def drop_processed(entries: DataFrame, done: DataFrame, key="entry_id") -> DataFrame:
    return entries.join(done.select(key), key, "left_anti")
