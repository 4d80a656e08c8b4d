"""A cursor-paged source as a Spark data source: pages follow each other, so it is one partition; what it yields is spread by the caller."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Statuses after which a request is worth repeating.
AGAIN = (429, 500, 502, 503, 504)


class Refused(Exception):
    """A page that was refused with a status."""

    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


def pages(fetch: Callable[[str | None], tuple[list[str], str | None]], interval: float, tries: int, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[int, str]]:
    """(position, body) of every item of all pages. Requests keep ``interval`` seconds apart; a page that stays refused is an error, never a shorter result."""
    cursor, position, last = None, 0, None
    while True:
        for attempt in range(tries):
            if last is not None:
                sleep(max(0.0, last + interval * 2**attempt - time.monotonic()))
            last = time.monotonic()
            try:
                items, following = fetch(cursor)
                break
            except Refused as e:
                if e.status not in AGAIN or attempt == tries - 1:
                    raise
        for body in items:
            yield position, body
            position += 1
        if not following or following == cursor:
            return
        cursor = following


class PagedSource(DataSource):
    """``spark.read.format("paged").option("fetch", "module:function")``: rows (position long, body string).

    The function takes a cursor (None at first) and gives a page's items as JSON texts and the next cursor.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "position long, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.target = options["fetch"]
        self.interval = float(options.get("interval", "0.1"))
        self.tries = int(options.get("tries", "5"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, name = self.target.split(":")
        yield from pages(getattr(importlib.import_module(module), name), self.interval, self.tries)
