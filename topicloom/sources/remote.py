"""Sources behind a network, with the network left to callables: listings by day and outlet, counts, pages, feeds.

Nothing here opens a connection by itself. A fetcher is given by the caller, is pickled to
the executors, and is called once for each partition of work.
"""

from __future__ import annotations

import gzip
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from topicloom.schema import SCRAPED_ARTICLE, URL_LISTING

#: Waits in seconds, doubled up to the last.
LISTING_WAITS, PAGE_WAITS = (40, 600), (1, 60)


def backoff(attempt: int, waits: tuple[int, int]) -> int:
    """Seconds to wait before the next try after ``attempt`` failures."""
    return min(waits[0] * 2 ** (attempt - 1), waits[1])


def with_retries(call: Callable, tries: int, waits: tuple[int, int], sleep: Callable[[float], None] = time.sleep):
    for attempt in range(1, tries + 1):
        try:
            return call()
        except Exception:
            if attempt == tries:
                raise
            sleep(backoff(attempt, waits))


def gunzipped(raw: bytes) -> bytes:
    """Decompressed if it is gzip, else as it is."""
    return gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw


#: What a listing gives: where it was found, and the record.
LISTED = f"day string, outlet string, {URL_LISTING}"
#: Numbered pages that a task of a stream reads.
TOGETHER = 50


class DayOutlet(InputPartition):
    """A day and outlet; of numbered pages only those from ``first`` to before ``last``."""

    def __init__(self, day: str, outlet: str, first: int | None = None, last: int | None = None):
        self.day, self.outlet, self.first, self.last = day, outlet, first, last


class _Pages:
    """What both readers do in a task: ask for pages, each one again if it fails."""

    def records(self, part: DayOutlet) -> Iterator[tuple]:
        names = [f.split()[0] for f in URL_LISTING.split(", ")]
        page = part.first or 0
        while page is not None and (part.last is None or page < part.last):  # a fetcher gives a page's records and the next page's token
            found, following = with_retries(lambda page=page: self.fetch(part.day, part.outlet, page), self.tries, self.waits)
            for r in found:
                yield part.day, part.outlet, *[r.get(n) for n in names]
            page = following if part.last is None else page + 1


class _Reader(DataSourceReader, _Pages):
    def __init__(self, fetch: Callable, pairs: Callable, count: bool, tries: int, waits: tuple[int, int]):
        self.fetch, self.pairs, self.count, self.tries, self.waits = fetch, pairs, count, tries, waits
        self.wanted: dict[str, set[str]] = {}

    def partitions(self) -> list[DayOutlet]:
        allowed = lambda **given: all(v in self.wanted.get(k, (v,)) for k, v in given.items())
        return [DayOutlet(d, o) for d, o in self.pairs() if allowed(day=d, outlet=o)]

    def read(self, part: DayOutlet) -> Iterator[tuple]:
        if not self.count:
            yield from self.records(part)
            return
        try:
            found = with_retries(lambda: self.fetch(part.day, part.outlet), self.tries, self.waits)
            yield part.day, part.outlet, counted(found)
        except Exception:  # an unknown count, which is asked for again another time
            yield part.day, part.outlet, -1


class _Filtered(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Days and outlets that are named bound the partitions."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if column in ("day", "outlet"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f


class _Stream(DataSourceStreamReader, _Pages):
    """An offset is the last pair of day and outlet that was read and, with numbered pages, how many of its pages."""

    def __init__(self, fetch: Callable, pairs: Callable, pages: Callable | None, tries: int, waits: tuple[int, int]):
        self.fetch, self.pairs, self.pages, self.tries, self.waits = fetch, pairs, pages, tries, waits

    def initialOffset(self) -> dict:  # noqa: N802
        return {"day": "", "outlet": "", "page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        day, outlet = max(self.pairs(), default=("", ""))
        return {"day": day, "outlet": outlet, "page": self.pages(day, outlet) if self.pages and day else 0}

    def partitions(self, start: dict, end: dict) -> list[DayOutlet]:
        first, last = ((x["day"], x["outlet"]) for x in (start, end))
        out = []
        for pair in sorted(set(self.pairs())):
            if self.pages is None and first < pair <= last:
                out.append(DayOutlet(*pair))
            elif self.pages and first <= pair <= last:
                a, b = start["page"] if pair == first else 0, end["page"] if pair == last else self.pages(*pair)
                out += [DayOutlet(*pair, k, min(k + TOGETHER, b)) for k in range(a, b, TOGETHER)]
        return out

    def read(self, part: DayOutlet) -> Iterator[tuple]:
        return self.records(part)

    def commit(self, end: dict) -> None:
        """Nothing is kept here: the query's checkpoint has the offset."""


def counted(found: dict | int) -> int:
    """A count as services give it: a number, or an object with ``relevant`` or ``count``."""
    return int(found.get("relevant") or found.get("count") or 0) if isinstance(found, dict) else int(found)


def listing_source(name: str, fetch: Callable, pairs: list[tuple[str, str]] | Callable, count: bool = False, pages: Callable | None = None, filters: bool = False, tries: int = 3, waits: tuple[int, int] = LISTING_WAITS) -> type[DataSource]:
    """A data source of listings, page by page, or of counts (-1: unknown), with a partition for each (day, outlet) of ``pairs`` (a list, or a
    function that gives it anew). A page or count that fails is asked for ``tries`` times in all.

    filters: in a batch, filters on day and outlet leave out partitions; ``spark.sql.python.filterPushdown.enabled`` must be set. As a
    stream, listings go on after the last pair by (day, outlet). pages: (day, outlet) -> how many numbered pages there are now, so that
    the last pair goes on too; without it a pair is read once, whole, by its pages' tokens. A batch that is tried again asks
    again, so records should be stored by their id."""
    listed = pairs if callable(pairs) else lambda: pairs

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "day string, outlet string, expected long" if count else LISTED

        def reader(self, schema) -> DataSourceReader:
            return (_Filtered if filters else _Reader)(fetch, listed, count, tries, waits)

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return _Stream(fetch, listed, pages, tries, waits)

    return Listing


def scrape(urls: DataFrame, fetch: Callable[[str], tuple[str, str, int]], topic: str, scraped_at: str, tries: int = 5) -> DataFrame:
    """Page metadata of each row's ``url``: success rows and error rows. fetch: url -> (html, final URL, status); 400 and above are errors."""
    from topicloom.functions.udf import page_metadata

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                try:
                    page, final, status = with_retries(lambda u=url: fetch(u), tries, PAGE_WAITS)
                    if status >= 400:
                        raise RuntimeError(f"HTTP {status}")
                    title, description = page_metadata(page)
                    rows.append((url, final, status, description, title, True, None, scraped_at, topic))
                except Exception as e:
                    rows.append((url, None, None, None, None, False, str(e), scraped_at, topic))
            frame = pd.DataFrame(rows, columns=[f.split()[0] for f in SCRAPED_ARTICLE.split(", ")])
            frame["http_status"] = frame["http_status"].astype("Int32")
            yield frame

    return urls.select("url").mapInPandas(run, SCRAPED_ARTICLE)


def whole_content(revisions: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    """Revisions whose cut content (``truncated``) is fetched whole from ``raw_url``; other rows, and their columns, stay as they are."""

    @F.pandas_udf("string")
    def follow(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: None if u is None else with_retries(lambda: fetch(u), 3, PAGE_WAITS))

    cut = F.coalesce("truncated", F.lit(False)) & F.col("raw_url").isNotNull()
    return revisions.withColumn("content", F.coalesce(follow(F.when(cut, F.col("raw_url"))), F.col("content")))


def at_version(revisions: DataFrame, version: str, file: str) -> DataFrame:
    """A file's content at a version of a snapshot table."""
    return revisions.where((F.col("version") == version) & (F.col("file") == file))
