"""A source that asks a service for pages: in parallel, again if a page fails, and from where the last run stopped.

What is asked for has keys (a collection and a year, say), and of each key so many rows in a fixed order. ``fetch(key, offset, size)``
gives rows and ``count(key)`` their number. A batch reads ranges of pages, one a task. A stream keeps how many
rows of each key it has had, so a later run asks for what was added since.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


@dataclass
class Span(InputPartition):
    """Rows [start, end) of a key; end None: until a page is short. at: what the service's ``locate`` says of them, if it has one."""

    key: str
    start: int
    end: int | None
    at: object = None


class Pages:
    """Rows of a span, page by page; a page that fails is asked for ``tries`` times in all before its task fails, and with it the whole span is asked for again."""

    def __init__(self, fetch: Callable, size: int, tries: int, wait: float):
        self.fetch, self.size, self.tries, self.wait = fetch, size, tries, wait

    def page(self, key: str, offset: int, size: int, at: object = None) -> list:
        for k in range(self.tries):
            try:
                return list(self.fetch(key, offset, size) if at is None else self.fetch(key, offset, size, at))
            except Exception:
                if k == self.tries - 1:
                    raise
                time.sleep(self.wait * 2**k)
        return []

    def rows(self, span: Span):
        at = span.start
        while span.end is None or at < span.end:
            size = self.size if span.end is None else min(self.size, span.end - at)
            got = self.page(span.key, at, size, span.at)
            yield from (tuple(r) for r in got)
            at += len(got)
            if len(got) < size:
                return


def spans(key: str, start: int, end: int, size: int, pages: int, locate: Callable | None = None) -> list[Span]:
    step = size * pages
    return [Span(key, a, min(a + step, end), locate and locate(key, a, min(a + step, end))) for a in range(start, end, step)]


def paged(fetch: Callable, keys: list[str], schema: str, count: Callable | None = None, size: int = 1000, pages: int = 10, tries: int = 3, wait: float = 1.0) -> type[DataSource]:
    """A source named ``paged`` over some keys: a task has at most ``pages`` pages of ``size`` rows of a key. Without ``count`` a key is one task, which
    reads until a page is short, and there is no stream. fetch and count must be importable or closures that can be sent. If fetch has an attribute
    ``locate``, what locate(key, start, end) says of a task's rows where spans are cut is sent with them and given to fetch(key, offset, size, at)."""
    asked, locate = Pages(fetch, size, tries, wait), getattr(fetch, "locate", None)

    class Reader(DataSourceReader):
        def partitions(self):
            if count is None:
                return [Span(k, 0, None) for k in keys]
            return [s for k in keys for s in spans(k, 0, count(k), size, pages, locate)] or [Span("", 0, 0)]

        def read(self, partition):
            return asked.rows(partition)

    class StreamReader(DataSourceStreamReader):
        def initialOffset(self):
            return {}

        def latestOffset(self):
            return {k: count(k) for k in keys}

        def partitions(self, start, end):
            return [s for k, n in end.items() for s in spans(k, start.get(k, 0), n, size, pages, locate)]

        def read(self, partition):
            return asked.rows(partition)

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return "paged"

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

        def streamReader(self, schema):
            if count is None:
                raise ValueError("a stream needs to know how many rows there are")
            return StreamReader()

    return Paged


def load(spark: SparkSession, source: type[DataSource], stream: bool = False) -> DataFrame:
    spark.dataSource.register(source)
    return (spark.readStream if stream else spark.read).format("paged").load()


#: Bytes of a file that are read at a time, and lines from one mark to the next.
CHUNK, MARKED = 1 << 18, 50


def folder_of_pages(path: str):
    """(keys, fetch, count) over a folder of files key=.../page=.../*.json of lines, as a service would serve them; pages of any size are cut from those of
    the files. Files are not changed once they are there, so their lines are counted and marked once, where spans are cut, and a task reads the bytes of its own rows."""
    from pyarrow import fs

    from .tail import opened

    marks: dict[str, tuple[int, list[int]]] = {}

    def files(key: str) -> list[str]:
        system, root = opened(path)
        found = system.get_file_info(fs.FileSelector(f"{root}/key={key}", recursive=True, allow_not_found=True))
        own = [(int(f.path.rsplit("page=", 1)[1].split("/")[0]), f.path) for f in found if f.type == fs.FileType.File and f.base_name.endswith(".json")]
        return [f for _, f in sorted(own)]

    def marked(file: str) -> tuple[int, list[int]]:
        """How many lines a file has, and where each MARKED-th of them begins."""
        if file not in marks:
            system, _ = opened(path)
            n, at, begins, last = 0, 0, [0], b"\n"
            with system.open_input_stream(file) as f:
                while chunk := f.read(CHUNK):
                    end = -1
                    while (end := chunk.find(b"\n", end + 1)) >= 0:
                        n += 1
                        if n % MARKED == 0:
                            begins.append(at + end + 1)
                    at, last = at + len(chunk), chunk[-1:]
            marks[file] = (n + (last != b"\n"), begins)
        return marks[file]

    def lines(file: str, begin: int, skip: int, n: int):
        """n lines of a file, those after ``skip`` lines from a place."""
        system, _ = opened(path)
        with system.open_input_file(file) as f:
            f.seek(begin)
            at, rest = -skip, b""
            while at < n:
                chunk = f.read(CHUNK)
                *whole, rest = (rest + chunk).split(b"\n")
                if not chunk and rest:
                    whole, rest = [rest], b""
                for line in whole[: n - at]:
                    if at >= 0:
                        yield line
                    at += 1
                if not chunk:
                    return

    def locate(key: str, start: int, end: int) -> list[tuple]:
        """(file, row of its first line, its lines, first mark, marks) for each file that has some of the rows."""
        out, before = [], 0
        for f in files(key):
            n, begins = marked(f)
            if max(start, before) < min(end, before + n):
                first = max(0, start - before) // MARKED
                out.append((f, before, n, first, begins[first : (end - before - 1) // MARKED + 1]))
            before += n
        return out

    def keys() -> list[str]:
        system, root = opened(path)
        return sorted(f.base_name.removeprefix("key=") for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("key="))

    def count(key: str) -> int:
        return sum(marked(f)[0] for f in files(key))

    def fetch(key: str, offset: int, size: int, at: list[tuple] | None = None) -> list[tuple]:
        out = []
        for file, before, n, first, begins in locate(key, offset, offset + size) if at is None else at:
            start, end = max(0, offset - before), min(n, offset + size - before)
            if start < end:
                mark = start // MARKED
                rows = map(json.loads, lines(file, begins[mark - first], start - mark * MARKED, end - start))
                out += [(key, row["id"], row["value"]) for row in rows]
        return out

    fetch.locate = locate
    return keys, fetch, count
