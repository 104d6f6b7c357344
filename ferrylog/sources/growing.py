"""A folder of export files that still grow, as a stream.

The stream's offset is a byte per file: all blocks before it were read. New bytes are
read in ranges by many tasks; small ranges share one. A task looks for the first
``[POSITION]`` line of a range and reads its last block on beyond it. A block that is still being written waits:
the offset only moves to where a block begins, or behind one whose statement has ended.
"""

from __future__ import annotations

import json
import re
from fnmatch import fnmatch
from itertools import groupby
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, source_file string, span long, place long, block string"
_ARROW = pa.schema([("path", pa.string()), ("source_file", pa.string()), ("span", pa.int64()), ("place", pa.int64()), ("block", pa.string())])
#: Bytes of a range, and of one look for a mark.
RANGE, LOOK = 32 << 20, 1 << 16
#: Bytes of the ranges that share a task, once all cores have work.
TASK_BYTES = 16 << 20

# A mark at the beginning of a line, and a literal or quoted name of a statement.
_START = re.compile(rb"(?:\A|(?<=[\n\r]))[\x00-\x09\x0b\x0c\x0e-\x20]*\[POSITION\]")
_MARK, _BLANKS = b"[POSITION]", bytes(b for b in range(0x21) if b not in b"\n\r")
_QUOTED = re.compile(rb"'(?:[^'\\]|\\.|'')*'|`[^`]*`", re.S)


class Span(NamedTuple):
    """Bytes ``[start, stop)`` of a file whose blocks are known up to ``end``; ``whole``: a block begins at ``start``."""

    path: str
    start: int
    stop: int
    end: int
    whole: bool


class Spans(InputPartition):
    """Ranges that one task reads one after another."""

    def __init__(self, spans: list[Span]):
        super().__init__([tuple(s) for s in spans])


def shared(spans: list[Span], most: int) -> list[Spans]:
    """The ranges in tasks of no more than ``most`` bytes, or of one range."""
    out, held = [], 0
    for span in spans:
        size = span.stop - span.start
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(span)
        held += size
    return [Spans(own) for own in out]


class _Listed(NamedTuple):
    size: int
    changed: object
    closed: int


def has_ended(block: bytes) -> bool:
    """Is the statement of a block written to its end: a terminator outside of literals, and the line is ended?"""
    bare = _QUOTED.sub(b"", block)
    return block[-1:] in (b"\n", b"\r") and bare.strip().endswith(b";") and b"'" not in bare and b"`" not in bare


def closed_end(file, size: int) -> int:
    """Where the blocks end that are written for sure: at the last mark, or behind its block if that has ended."""
    at, tail = size, b""
    while True:
        a = max(0, at - max(LOOK, len(tail)))  # back in doubling steps
        tail, at = _read(file, a, at) + tail, a
        # A mark at the very start of what was read may stand inside a line.
        marks = [m.start() for m in _START.finditer(tail) if a == 0 or m.start() > 0]
        if marks or a == 0:
            break
    last = marks[-1] if marks else 0
    return size if has_ended(tail[last:]) else a + last


def _read(file, a: int, b: int) -> bytes:
    file.seek(a)
    return file.read(b - a)


def _cut_off(data: bytes) -> bool:
    """May the last line be the beginning of a mark?"""
    line = data[max(data.rfind(b"\n"), data.rfind(b"\r")) + 1:].lstrip(_BLANKS)
    return len(line) < len(_MARK) and _MARK.startswith(line)


def blocks_of(file, span) -> Iterator[tuple[int, bytes]]:
    """``(offset, bytes)`` of the blocks that begin in a range."""
    _, start, stop, end, whole = span
    low = max(start - 1, 0)
    data = _read(file, low, stop)
    while low + len(data) < end and _cut_off(data):  # the range may end inside a mark
        data += _read(file, low + len(data), min(end, low + len(data) + LOOK))
    marks = [low + m.start() for m in _START.finditer(data)]
    marks = [m for m in marks if start <= m < stop and (m > low or low == 0)]
    if whole and (not marks or marks[0] > start):
        marks.insert(0, start)
    if not marks:
        return
    # On from the range's end to the next mark.
    seen = max(marks[-1] + 1, stop - 1)
    while True:
        tail = data[seen - low:]
        ahead = next((seen + m.start() for m in _START.finditer(tail) if m.start() > 0 and seen + m.start() >= stop), None)
        if ahead is not None or low + len(data) >= end:
            break
        # A mark may be cut off: look again from the beginning of the last line.
        seen = max(seen, low + max(data.rfind(b"\n", seen - low), data.rfind(b"\r", seen - low)))
        data += _read(file, low + len(data), min(end, low + len(data) + max(LOOK, len(data))))
    marks.append(end if ahead is None else ahead)
    for a, b in zip(marks, marks[1:]):
        yield a, data[a - low:b - low]


class GrowingReader(DataSourceStreamReader):
    def __init__(self, folder: str, glob: str, range_bytes: int, tasks: int = 1):
        self.folder, self.glob, self.range_bytes, self.tasks, self.listed = folder, glob, range_bytes, tasks, {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        store, root = arrow_fs.FileSystem.from_uri(self.folder)
        found = store.get_file_info(arrow_fs.FileSelector(root, recursive=True, allow_not_found=True))
        ends = {}
        for info in sorted(found, key=lambda i: i.path):
            if info.type != arrow_fs.FileType.File or info.base_name[:1] in "._" or not fnmatch(info.base_name, self.glob):
                continue
            known = self.listed.get(info.path)
            if known is None or (known.size, known.changed) != (info.size, info.mtime_ns):
                with store.open_input_file(info.path) as file:
                    known = self.listed[info.path] = _Listed(info.size, info.mtime_ns, closed_end(file, info.size))
            ends[info.path] = known.closed
        return {"files": json.dumps(ends)}

    def partitions(self, start: dict, end: dict):
        known, out = json.loads(start["files"]), []
        for path, stop in json.loads(end["files"]).items():
            a = known.get(path, 0)
            if stop < a:
                raise ValueError(f"{path} was read up to byte {a} and now ends at {stop}: a file that was cut or written anew can't be replayed")
            out += [Span(path, at, min(at + self.range_bytes, stop), stop, at == a) for at in range(a, stop, self.range_bytes)]
        # All cores have work before ranges share a task.
        return shared(out, min(TASK_BYTES, sum(s.stop - s.start for s in out) // self.tasks))

    def read(self, partition: Spans):
        store, _ = arrow_fs.FileSystem.from_uri(self.folder)
        rows, held = [], 0
        for path, spans in groupby(partition.value, lambda s: s[0]):
            with store.open_input_file(path) as file:
                for span in spans:
                    for at, block in blocks_of(file, span):
                        rows.append((path, path.rpartition("/")[2], span[1], at, block.decode(errors="replace")))
                        held += len(block)
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class GrowingExports(DataSource):
    """``spark.readStream.format("growing_exports")`` with options ``path``, ``glob``, ``range_bytes`` and ``tasks``."""

    @classmethod
    def name(cls):
        return "growing_exports"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return GrowingReader(self.options["path"], self.options.get("glob", "*.sql"), int(self.options.get("range_bytes", RANGE)),
                             int(self.options.get("tasks", 1)))


def stream_growing_exports(spark: SparkSession, folder: str, glob="*.sql", range_bytes=RANGE) -> DataFrame:
    """Blocks ``(path, source_file, span, place, block)`` of export files as they are written.

    ``folder`` is an absolute path or a URI that pyarrow's file systems know. The offset
    has an entry per file of the folder.
    """
    spark.dataSource.register(GrowingExports)
    return (spark.readStream.format("growing_exports").option("path", folder).option("glob", glob)
                 .option("range_bytes", range_bytes).option("tasks", spark.sparkContext.defaultParallelism).load())
