"""Paginated listings: a Spark data source with one partition a listing, and the same scan over stored pages.

Register with ``spark.dataSource.register(PaginatedSource)`` and read with ``format("paginated")``; the option
``fetch`` names a function ``module:name`` that takes (listing, page) and returns (rows, total, has_next), pages from 1.
Beside the rows stands one coverage row a listing: why the scan stopped, and whether it saw all that was advertised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from importlib import import_module

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Why a scan stops.
REASONS = (
    "request_failed", "known_result_window_limit", "empty_page", "advertised_total_reached", "configured_record_limit",
    "repeated_page", "last_page", "configured_page_limit",
)

Fetch = Callable[[int], tuple[list[tuple[str, str]], int | None, bool | None]]


@dataclass
class Coverage:
    """What a scan saw; rows are (id, payload), the first of each id."""

    rows: dict[str, str] = field(default_factory=dict)
    reason: str = "request_failed"
    complete: bool = False
    pages: int = 0
    total: int | None = None
    error: str | None = None


class FirstPageFailed(RuntimeError):
    """No page could be read, which is no empty listing."""


def cover(fetch: Fetch, max_pages: int | None = None, max_records: int | None = None, window: Callable[[int, Exception], bool] | None = None) -> Coverage:
    """Pages until one says that it is the last; there is no limit unless one is given.

    The largest advertised total counts, as later pages may advertise none.  An end is complete if no total was advertised or all
    of it was seen.  A later page that fails ends the scan incomplete and keeps the rows so far; it is a complete end only if
    ``window`` (pages read, exception) knows it as the source's limit.  A total that is reached tells more than a limit that
    is met at the same row.
    """
    out = Coverage()

    def end(reason: str, complete: bool) -> Coverage:
        out.reason, out.complete = reason, complete
        return out

    def whole() -> bool:
        return out.total is None or len(out.rows) >= out.total

    def full() -> bool:
        return max_records is not None and len(out.rows) >= max_records

    while True:
        try:
            batch, total, more = fetch(out.pages + 1)
        except Exception as e:  # whatever it raised, the request failed
            if window is not None and window(out.pages, e):
                return end("known_result_window_limit", True)
            out.error = f"{type(e).__name__}: {e}"
            return end("request_failed", False)
        out.pages += 1
        if total is not None and total > 0:
            out.total = max(total, out.total or 0)
        if not batch:
            return end("empty_page", whole())
        before = len(out.rows)
        for k, v in batch:
            if full():
                break
            out.rows.setdefault(k, v)
        if out.total is not None and whole():
            return end("advertised_total_reached", True)
        if full():
            return end("configured_record_limit", False)
        if len(out.rows) == before:
            return end("repeated_page", False)
        if more is False:
            return end("last_page", whole())
        if max_pages is not None and out.pages >= max_pages:
            return end("configured_page_limit", False)


def paginate(fetch: Fetch, **limits) -> tuple[list[tuple[str, str]], str, bool]:
    """``cover`` as (rows, why it stopped, whether all was seen); raises if the first page fails."""
    c = cover(fetch, **limits)
    if c.reason == "request_failed" and not c.pages:
        raise FirstPageFailed(c.error)
    return list(c.rows.items()), c.reason, c.complete


STORED = "listing string, ord int, id string, payload string, stop_reason string, complete boolean, pages int, advertised_total long, error string"


def scan_stored(pages: DataFrame, max_pages: int | None = None, max_records: int | None = None) -> DataFrame:
    """The scan over stored responses (listing, page, rows array<struct<id, payload>>, total, has_next, error).

    A listing is scanned in one task, as its pages follow each other; a listing whose first page failed has its coverage row only.
    """

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        by = {int(r.page): r for r in group.itertuples()}

        def fetch(n):
            r = by.get(n)
            if r is None:
                return [], None, None
            if isinstance(r.error, str):
                raise RuntimeError(r.error)
            rows = [] if r.rows is None else [(x["id"], x["payload"]) for x in r.rows]
            return rows, None if pd.isna(r.total) else int(r.total), None if pd.isna(r.has_next) else bool(r.has_next)

        c = cover(fetch, max_pages, max_records)
        out = [(key[0], i, k, v, None, None, None, None, None) for i, (k, v) in enumerate(c.rows.items())]
        out.append((key[0], None, None, None, c.reason, c.complete, c.pages, c.total, c.error))
        frame = pd.DataFrame(out, columns=[x.split()[0] for x in STORED.split(", ")], dtype=object)
        return frame

    return pages.groupBy("listing").applyInPandas(run, STORED)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [InputPartition(x) for x in self.options["listings"].split(",")]

    def read(self, partition) -> Iterator[tuple]:
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(import_module(module), name)
        limit = lambda x: int(self.options.get(x, 0)) or None
        rows, why, complete = paginate(lambda p: fetch(partition.value, p), max_records=limit("limit"), max_pages=limit("pages"))
        for i, (k, v) in enumerate(rows):
            yield partition.value, i, k, v, None, None
        yield partition.value, None, None, None, why, complete  # the coverage row


class PaginatedSource(DataSource):
    @classmethod
    def name(cls):
        return "paginated"

    def schema(self):
        return "listing string, ord int, id string, payload string, stop_reason string, complete boolean"

    def reader(self, schema):
        return _Reader(self.options)


def demo_fetch(listing: str, page: int):
    """A listing of pages of three, for tests and examples: its name tells how many rows it has."""
    n = int(listing.rpartition("-")[2])
    rows = [(f"{listing}:{i}", f"row {i}") for i in range((page - 1) * 3, min(page * 3, n))]
    return rows, None, page * 3 < n
