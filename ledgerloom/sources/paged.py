"""A paged source as a Python data source: one input partition a page, with retries.

The transport is a parameter, so the reader runs over HTTP, files or a fake alike. Option ``pages`` says how many there are; without it
the first page's total and size do, or, where it names no total, pages are asked for until one is empty. Each
page is fetched by the executor that reads it, a failed fetch is tried again, and a page that stays away fails the job. ``check_complete`` compares
what came with the total. ``session_numbers`` lists the sessions a source has.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.operators.ingest import incomplete


class Page(InputPartition):
    """One page, counted from 1."""

    def __init__(self, number: int):
        self.number = number


class PagedReader(DataSourceReader):
    """Reads pages of JSON envelopes; a row is (page, place, payload, claimed_total)."""

    def __init__(self, options: dict):
        self.url = options["url"]
        self.pages = int(options["pages"]) if "pages" in options else None
        self.total = options.get("total", "total")
        self.records = options.get("records", "records")
        self.tries = int(options.get("tries", 4))
        self.wait = float(options.get("wait", 1.0))

    def partitions(self) -> list[Page]:
        return [Page(n) for n in range(1, (self._count() if self.pages is None else self.pages) + 1)]

    def _body(self, number: int) -> dict:
        body = self._fetch(self.url.format(page=number))
        if isinstance(body, list):
            body = body[0] if len(body) == 1 and isinstance(body[0], dict) and self.records in body[0] else {self.records: body}
        return body

    def _count(self) -> int:
        """How many pages there are."""
        first = self._body(1)
        size, total = len(first.get(self.records) or []), first.get(self.total)
        if not size:
            return 0
        if total is not None:
            return -(-int(total) // size)
        # No total: double until a page is empty, then halve the gap.
        full, empty = 1, 2
        while self._body(empty).get(self.records):
            full, empty = empty, 2 * empty
        while empty - full > 1:
            middle = (full + empty) // 2
            full, empty = (middle, empty) if self._body(middle).get(self.records) else (full, middle)
        return full

    def read(self, partition: Page) -> Iterator[tuple]:
        body = self._body(partition.number)
        claimed = body.get(self.total)
        for place, record in enumerate(body.get(self.records) or []):
            yield partition.number, place, json.dumps(record, ensure_ascii=False), None if claimed is None else int(claimed)

    def _fetch(self, url: str):
        for attempt in range(1, self.tries + 1):
            try:
                with urllib.request.urlopen(url, timeout=60) as answer:
                    return json.loads(answer.read())
            except (OSError, ValueError):
                if attempt == self.tries:
                    raise
                time.sleep(self.wait * attempt)


class PagedSource(DataSource):
    """``spark.dataSource.register(PagedSource)``, then ``spark.read.format("paged_json")`` with url ({page}) and pages."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, place int, payload string, claimed_total bigint"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def check_complete(rows: DataFrame) -> DataFrame:
    """The rows of a paged source without claimed_total; raises where fewer or more came than any page claims."""
    odd = incomplete(rows).first()
    if odd:
        raise IOError(f"{odd.received} records, {odd.claimed} claimed")
    return rows.drop("claimed_total")


def session_numbers(rows: DataFrame, payload: str = "payload", number: str = "sessionNo") -> DataFrame:
    """The distinct session numbers of a source's records, ascending: number."""
    found = rows.select(F.get_json_object(payload, f"$.{number}").try_cast("int").alias("number"))
    return found.where("number is not null").distinct().orderBy("number")
