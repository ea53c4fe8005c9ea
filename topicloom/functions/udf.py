"""Steps that need Python, as Arrow-batched UDFs: detectors of the caller's, page metadata."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.text import trim

def is_english(title: Column, description: Column, detector: Callable[[str], str | None]) -> Column:
    """Detected as English by a detector of the caller's (``operators.languages`` has one without Python); texts under 20 characters, and those that no language is found for, pass."""

    @F.pandas_udf("boolean")
    def check(text: pd.Series) -> pd.Series:
        return text.map(lambda t: len(t) < 20 or detector(t) in ("en", None))

    return check(trim(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))))


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.title: str | None = None
        self.inside = self.extra = False

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag == "meta":
            for kind in ("name", "property"):
                if found.get(kind):
                    self.meta.setdefault(f"{kind}={found[kind]}", found.get("content") or "")
        elif tag == "title" and self.title is None:
            self.inside, self.title = True, ""
        elif self.inside:
            self.extra = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "title":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.title += data


def page_metadata(page: str | None) -> tuple[str | None, str | None]:
    """(title, description): of each kind of tag the first one counts, if it isn't blank; a title element only if it is text alone."""
    parser = _Page()
    parser.feed(page or "")
    pick = lambda *keys: next((parser.meta[k].strip() for k in keys if parser.meta.get(k, "").strip()), None)
    plain = (parser.title or "").strip() if not parser.extra else ""
    return pick("property=og:title", "name=twitter:title") or plain or None, pick("name=description", "property=og:description", "name=twitter:description")


def html_metadata(page: Column) -> Column:
    """Struct (title, description) of a page."""

    @F.pandas_udf("struct<title:string,description:string>")
    def read(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_metadata(p) for p in pages], columns=["title", "description"])

    return read(page)
