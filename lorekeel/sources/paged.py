"""A Python data source for paged HTTP APIs: one partition per range of pages."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Seconds between requests of one reader, tries of a request, and states that are tried again.
SPACING, TRIES, AGAIN = 3600 / 5000, 5, (429, 500, 502, 503, 504)


def fetch(url: str, get: Callable[[str], bytes], tries: int = TRIES, wait: Callable[[float], None] = time.sleep) -> bytes:
    """``get(url)``, tried again after 1, 2, 4 ... seconds on a broken connection or a state that may pass."""
    for k in range(tries):
        try:
            return get(url)
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN or k + 1 == tries:
                raise
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if k + 1 == tries:
                raise
        wait(2.0**k)
    raise AssertionError("unreachable")


def _http(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as answer:  # noqa: S310
        return answer.read()


class PagedSource(DataSource):
    """``spark.read.format("paged")`` with options url, items (key of the list), page_size, max_items (0: all) and total_key.

    Rows are (offset, value): the place of an item and its JSON. Pages are dealt to tasks in runs; without a known
    total there is one run, which ends at the first page that is not full.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "offset long, value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(dict(self.options))


class Pages(InputPartition):
    def __init__(self, start: int, end: int | None) -> None:
        self.start, self.end = start, end


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], get: Callable[[str], bytes] = _http) -> None:
        self.url, self.items, self.get = options["url"], options.get("items", "items"), get
        self.size, self.most = int(options.get("page_size", 250)), int(options.get("max_items", 0))
        self.total_key, self.pages_each = options.get("total_key"), int(options.get("pages_per_partition", 20))

    def _page(self, offset: int) -> dict:
        mark = "&" if "?" in self.url else "?"
        return json.loads(fetch(self.url + mark + urllib.parse.urlencode({"limit": self.size, "offset": offset}), self.get))

    def partitions(self) -> list[Pages]:
        if not self.total_key:
            return [Pages(0, self.most or None)]
        found = self._page(0)
        for key in self.total_key.split("."):
            found = found[key]
        total = min(int(found), self.most) if self.most else int(found)
        step = self.size * self.pages_each
        return [Pages(a, min(a + step, total)) for a in range(0, total, step)] or [Pages(0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple[int, str]]:
        at = partition.start
        while partition.end is None or at < partition.end:
            items = self._page(at).get(self.items) or []
            for k, item in enumerate(items):
                if partition.end is not None and at + k >= partition.end:
                    return
                yield at + k, json.dumps(item, sort_keys=True)
            if len(items) < self.size:
                return
            at += self.size
            time.sleep(SPACING)
