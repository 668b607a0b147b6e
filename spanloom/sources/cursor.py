"""A cursor-paged source as a Python Data Source (S14): pages with retries, offsets as cursors; works in streams.

``pages`` names a module-level callable ``fetch(cursor, size) -> (rows, next cursor or None)``, as ``module:name``. The
one here serves a made-up collection, so that everything runs without a network.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "id bigint, title string, year int"


def collection(cursor: int, size: int, total: int = 2_500) -> tuple[list[tuple], int | None]:
    """Works of a made-up collection."""
    stop = min(cursor + size, total)
    return [(i, f"work {i}", 2000 + i % 25) for i in range(cursor, stop)], stop if stop < total else None


def fetch_with_retries(fetch: Callable, cursor: int, size: int, tries: int = 5, wait: float = 0.5):
    """One page; a failing call waits twice as long each time before it is tried again."""
    for attempt in range(tries):
        try:
            return fetch(cursor, size)
        except (OSError, TimeoutError):
            if attempt == tries - 1:
                raise
            time.sleep(wait * 2**attempt)


def _named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Pages(InputPartition):
    def __init__(self, start: int, stop: int):
        super().__init__(start)
        self.start, self.stop = start, stop


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[_Pages]:
        total, share = int(self.options.get("total", 2_500)), int(self.options.get("share", 1_000))
        return [_Pages(a, min(a + share, total)) for a in range(0, total, share)]

    def read(self, part: _Pages) -> Iterator[tuple]:
        fetch, size, cursor = _named(self.options.get("pages", f"{__name__}:collection")), int(self.options.get("size", 200)), part.start
        while cursor is not None and cursor < part.stop:
            rows, cursor = fetch_with_retries(fetch, cursor, min(size, part.stop - cursor))
            yield from rows


class _StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.fetch, self.size = _named(options.get("pages", f"{__name__}:collection")), int(options.get("size", 200))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"cursor": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, after = fetch_with_retries(self.fetch, start["cursor"], self.size)
        return iter(rows), {"cursor": start["cursor"] + len(rows)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter(fetch_with_retries(self.fetch, start["cursor"], end["cursor"] - start["cursor"])[0])


class CursorSource(DataSource):
    """``spark.read.format("cursor")`` after ``spark.dataSource.register(CursorSource)``."""

    @classmethod
    def name(cls) -> str:
        return "cursor"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _StreamReader(dict(self.options))
