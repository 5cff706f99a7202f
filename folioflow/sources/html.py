"""Fields of HTML pages: meta elements, links and texts, read in Python workers a batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names under which pages give an article's fields, in order of preference.
TITLE_NAMES = ("citation_title", "dc.title", "og:title")
AUTHOR_NAMES = ("citation_author", "dc.creator.personalname")
ABSTRACT_NAMES = ("citation_abstract", "dc.description", "description", "og:description")


def _parsed(page: str | None) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """Meta values by lower-case name, in order, and links as (address, text)."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.meta, self.links, self.open = {}, [], None

        def handle_starttag(self, tag, attrs):
            given = {k.lower(): v or "" for k, v in attrs}
            if tag == "meta" and (name := given.get("name") or given.get("property")):
                value = " ".join(given.get("content", "").split())
                if value:
                    self.meta.setdefault(name.lower(), []).append(value)
            elif tag == "a" and given.get("href"):
                self.open = [given["href"], ""]

        def handle_data(self, data):
            if self.open is not None:
                self.open[1] += data

        def handle_endtag(self, tag):
            if tag == "a" and self.open is not None:
                self.links.append((self.open[0], " ".join(self.open[1].split())))
                self.open = None

    reader = Reader()
    reader.feed(page or "")
    reader.close()
    return reader.meta, reader.links


def meta_values(page: Column, name: str) -> Column:
    """All values of a meta element, in order, regardless of the name's case; empty for null."""
    return F.pandas_udf(lambda pages: pages.map(lambda p: _parsed(p)[0].get(name.lower(), [])), "array<string>")(page)


def first_meta(page: Column, names: Sequence[str]) -> Column:
    """The first value of the first of the names that the page has; empty where it has none."""
    wanted = [n.lower() for n in names]

    def of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: next((m[n][0] for m in (_parsed(p)[0],) for n in wanted if n in m), ""))

    return F.pandas_udf(of, "string")(page)


def links(page: Column) -> Column:
    """Links as (href, text), distinct by address, in order."""

    def of(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            first: dict[str, str] = {}
            for href, words in _parsed(page)[1]:
                first.setdefault(href, words)
            out.append([{"href": h, "text": t} for h, t in first.items()])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(of, "array<struct<href:string,text:string>>")(page)


def article(page: Column) -> Column:
    """``title, authors, abstract`` of an article page, from its meta elements."""

    def of(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            meta = _parsed(page)[0]
            rows.append((next((meta[n][0] for n in TITLE_NAMES if n in meta), ""), next((meta[n] for n in AUTHOR_NAMES if n in meta), []), next((meta[n][0] for n in ABSTRACT_NAMES if n in meta), "")))
        return pd.DataFrame(rows, columns=["title", "authors", "abstract"])

    return F.pandas_udf(of, "title string, authors array<string>, abstract string")(page)


def escaped(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def rendered(title: Column, authors: Column, abstract: Column) -> Column:
    """An article page with meta elements, for tests and exports."""
    people = F.array_join(F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.concat(F.lit('<meta name="citation_author" content="'), escaped(a), F.lit('">'))), "")
    return F.concat(F.lit('<html><head><meta name="Citation_Title" content="'), escaped(title), F.lit('">'), people, F.lit('<meta name="citation_abstract" content="'), escaped(abstract), F.lit('"></head><body></body></html>'))
