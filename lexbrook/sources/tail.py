"""A streaming source that follows files of lines byte by byte.

Landing folders take files that never change. Here files may grow: progress is a byte offset a file, kept in the query's
checkpoint, so a run reads what was added since the last one and nothing else. Files are opened through
``pyarrow.fs``, so a path may be local, or a URI of a store that it knows; what was added is cut in ranges, one a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, position long, value string"
#: Bytes that a task reads, and bytes that are read or sent at a time.
RANGE, CHUNK = 64 << 20, 1 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):  # as Hadoop writes local paths
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    """Lines that begin in [start, end) of a file whose known bytes end at ``limit``."""

    path: str
    start: int
    end: int
    limit: int


def end_of_lines(file, size: int) -> int:
    """The place after the last line feed within the first ``size`` bytes, looked for from the end."""
    at = size
    while at > 0:
        start = max(0, at - CHUNK)
        found = file.read_at(at - start, start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return 0


def lines_of(file, part: Range):
    """(position, line) of lines that begin in the range. A line that began before the range is left out, be it one of
    another range or the rest of a line whose beginning was read by an earlier run."""
    at, held = part.start, b""
    skip = at > 0 and file.read_at(1, at - 1) != b"\n"
    position = at
    while at < part.limit and position < part.end:
        data = file.read_at(min(CHUNK, part.limit - at), at)
        if not data:  # the file has shrunk since; the next run reads it anew
            return
        at += len(data)
        lines = (held + data).split(b"\n")
        held = lines.pop()
        for line in lines:
            if skip:
                skip = False
            elif position < part.end:
                yield position, line
            else:
                return
            position += len(line) + 1
    if held and not skip and position < part.end:
        yield position, held


class TailReader(DataSourceStreamReader):
    """Offsets are {file: [size, read to]}. A file of the same size is not looked at, a smaller one was written anew
    and is read from its beginning, a larger one is read from where it was read to."""

    def __init__(self, options):
        self.path, self.suffix, self.unfinished = options["path"], options.get("suffix", ".jsonl"), options.get("unfinished", "wait") == "read"
        self.range = int(options.get("rangeBytes", RANGE))
        self.known: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, root = opened(self.path)
        found = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type != fs.FileType.File or not info.base_name.endswith(self.suffix) or info.base_name.startswith(("_", ".")):
                continue
            if (old := self.known.get(info.path)) is None or old[0] != info.size:
                with system.open_input_file(info.path) as f:
                    old = [info.size, info.size if self.unfinished else end_of_lines(f, info.size)]
            found[info.path] = old
        self.known = found
        return found

    def partitions(self, start: dict, end: dict) -> list[Range]:
        parts = []
        for path, (size, limit) in end.items():
            old_size, at = start.get(path, (0, 0))
            if size == old_size:
                continue
            if size < old_size:
                at = 0
            parts += [Range(path, a, min(a + self.range, limit), limit) for a in range(at, limit, self.range)]
        return parts

    def read(self, partition: Range):
        system, _ = opened(self.path)
        with system.open_input_file(partition.path) as f:
            rows, size = [], 0

            def batch():
                positions, values = zip(*rows, strict=True)
                return pa.record_batch([pa.array([partition.path] * len(rows)), pa.array(positions, pa.int64()), pa.array(values)], names=["file", "position", "value"])

            for position, line in lines_of(f, partition):
                text = line.decode("utf-8", "replace").strip()
                if text:
                    rows.append((position, text))
                    size += len(text)
                if size > CHUNK:
                    yield batch()
                    rows, size = [], 0
            if rows:
                yield batch()


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def tail(spark: SparkSession, path: str, suffix: str = ".jsonl", unfinished: str = "wait", range_bytes: int = RANGE) -> DataFrame:
    """A stream (file, position, value) of the lines that files below a folder have, and of those that they get.

    ``position`` is the byte where a line begins; with its file it names the line. Empty lines are left out, lines are trimmed.
    The last line of a file, if no line feed follows it, waits for the run that finds one; with ``unfinished="read"`` it is read as
    it is and what is added to it later is left out. No whole line is ever left out. Lines of a file that was written anew come
    again, so write them by ``insert_or_ignore`` or another rule that takes a row once. A file that is gone is forgotten.
    """
    spark.dataSource.register(Tail)
    return spark.readStream.format("tail").option("suffix", suffix).option("unfinished", unfinished).option("rangeBytes", str(range_bytes)).load(path)
