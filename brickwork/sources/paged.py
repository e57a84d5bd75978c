"""Paged web sources as Spark data sources: a search index by page, a REST table by offset.

Pages are partitions, read in parallel by executors, with retries and a pause after each request. Rows are
the JSON text of each hit; `tables.parsed_hits` or `from_json` gives them their schema.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition


class Span(InputPartition):
    """Pages or rows from start to end, end excluded."""

    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def request(url: str, body: dict | None = None, headers: dict | None = None, retries: int = 3, pause: float = 0.0) -> tuple[dict | list, dict]:
    """The JSON that the address gives, and the headers. Failures are tried again, after longer and longer pauses."""
    for attempt in range(1, retries + 1):
        try:
            ask = urllib.request.Request(url, None if body is None else json.dumps(body).encode(), {"Content-Type": "application/json", **(headers or {})})
            with urllib.request.urlopen(ask, timeout=15) as answer:
                found = json.loads(answer.read()), {k.lower(): v for k, v in answer.headers.items()}
            time.sleep(pause)
            return found
        except (urllib.error.URLError, TimeoutError, ValueError):
            if attempt == retries:
                raise
            time.sleep(min(2 * attempt, 30) * min(1.0, pause or 1.0))
    raise AssertionError


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.headers = json.loads(options.get("headers", "{}"))
        self.size = int(options.get("pageSize", "25"))
        self.pause = float(options.get("pause", "1.0"))
        self.retries = int(options.get("retries", "3"))
        self.spans = int(options.get("spans", "8"))

    def _dealt(self, n: int) -> list[Span]:
        step = max(1, -(-n // self.spans))
        return [Span(a, min(a + step, n)) for a in range(0, n, step)]


class SearchReader(_Reader):
    """POST {page, hitsPerPage, filters}; answers have hits and nbPages. No hit at all raises."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.filters = [x for x in (options.get("filters", ""),) if x]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equalities on purpose and category go to the index; others stay with Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("purpose",), ("category",)):
                name = "purpose" if f.attribute == ("purpose",) else "category.slug"
                self.filters.append(f'{name}:"{f.value}"')
            else:
                yield f

    def _page(self, page: int) -> dict:
        return request(self.url, {"page": page, "hitsPerPage": self.size, "filters": " AND ".join(self.filters)}, self.headers, self.retries, self.pause)[0]

    def partitions(self) -> list[Span]:
        first = self._page(0)
        if not first["hits"]:
            raise RuntimeError("the search gave no hits; its structure or filters may have changed")
        return self._dealt(first["nbPages"])

    def read(self, partition: Span) -> Iterator[tuple]:
        for page in range(partition.start, partition.end):
            for hit in self._page(page)["hits"]:
                category = hit.get("category") or []
                yield json.dumps(hit, ensure_ascii=False), hit.get("purpose"), (category[-1].get("slug") if category else None)


class SearchSource(DataSource):
    """Options: url, filters, pageSize, pause, retries, headers (JSON), spans. Columns: value, purpose, category."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "value string, purpose string, category string"

    def reader(self, schema) -> DataSourceReader:
        return SearchReader(self.options)


class TableReader(_Reader):
    """GET with select, offset and limit; the Content-Range of the first answer tells the number of rows. None raises."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.columns = options.get("columns", "*")

    def _rows(self, start: int, n: int) -> tuple[list, dict]:
        ask = urllib.parse.urlencode({"select": self.columns, "offset": start, "limit": n})
        return request(f"{self.url}?{ask}", None, {"Prefer": "count=exact", **self.headers}, self.retries, self.pause)

    def partitions(self) -> list[Span]:
        rows, headers = self._rows(0, 1)
        if not rows:
            raise ValueError(f"{self.url} gave no rows")
        if self.columns != "*" and (missing := [c for c in self.columns.split(",") if c not in rows[0]]):
            raise ValueError(f"missing columns: {missing}")
        total = headers.get("content-range", "").rpartition("/")[2]
        return self._dealt(int(total)) if total.isdigit() else [Span(0, 2**62)]

    def read(self, partition: Span) -> Iterator[tuple]:
        at = partition.start
        while at < partition.end:
            n = min(self.size, partition.end - at)
            rows, _ = self._rows(at, n)
            for row in rows:
                yield (json.dumps(row, ensure_ascii=False),)
            if len(rows) < n:
                return
            at += n


class TableSource(DataSource):
    """Options: url, columns, pageSize, pause, retries, headers (JSON), spans. Column: value."""

    @classmethod
    def name(cls) -> str:
        return "paged_table"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return TableReader(self.options)


def register(spark) -> None:
    """Makes both sources known, with filters pushed to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (SearchSource, TableSource):
        spark.dataSource.register(source)
