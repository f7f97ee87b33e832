"""Stored pages and model answers parsed into rows. Fetching is not done here: pages come as files or columns."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_FIELDS = "title string, date string, body string"
ROSTER_FIELDS = "section string, pos int, cells array<string>"
_BLOCKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "table", "article", "section"}
_DROPPED = {"script", "style", "nav", "header", "footer", "aside", "form", "noscript", "iframe", "button", "figure"}


class _Page(HTMLParser):
    """Title, date, paragraphs, links and tables of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.date, self.text, self.links, self.tables = "", None, [], [], []
        self._skip, self._in_title, self._link, self._cell, self._headings, self._heading = 0, False, None, None, [], None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in _DROPPED:
            self._skip += 1
        elif tag == "title":
            self._in_title = True
        elif tag == "meta" and (a.get("property") or a.get("name") or "") in ("pubdate", "article:published_time", "date"):
            self.date = self.date or a.get("content")
        elif tag == "time":
            self.date = self.date or a.get("datetime")
        elif tag == "a" and a.get("href"):
            self._link = [a["href"], ""]
        elif tag in ("h1", "h2", "h3", "h4"):
            self._heading = ""
        elif tag == "table":
            self.tables.append({"section": self._headings[-1] if self._headings else None, "rows": []})
        elif tag == "tr" and self.tables:
            self.tables[-1]["rows"].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]["rows"]:
            self._cell = [tag, ""]
        if tag in _BLOCKS:
            self.text.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in _DROPPED:
            self._skip = max(0, self._skip - 1)
        elif tag == "title":
            self._in_title = False
        elif tag == "a" and self._link:
            self.links.append(tuple(self._link))
            self._link = None
        elif tag in ("h1", "h2", "h3", "h4") and self._heading is not None:
            self._headings.append(self._heading.strip())
            self._heading = None
        elif tag in ("td", "th") and self._cell:
            self.tables[-1]["rows"][-1].append((self._cell[0], re.sub(r"\s+", " ", self._cell[1]).strip()))
            self._cell = None

    def handle_data(self, data: str) -> None:
        if self._in_title:
            self.title += data
        elif not self._skip:
            if self._link is not None:
                self._link[1] += data
            if self._heading is not None:
                self._heading += data
            if self._cell is not None:
                self._cell[1] += data
            self.text.append(data)


def parse_page(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    return page


def page_body(page: _Page, least: int = 10) -> str | None:
    """Paragraphs longer than ``least``; null where they make up no more than 100 characters."""
    parts = [re.sub(r"\s+", " ", p).strip() for p in "".join(page.text).split("\n")]
    body = "\n".join(p for p in parts if len(p) > least)
    return body if len(body) > 100 else None


def page_title(page: _Page) -> str:
    """Title without the site's name and a trailing bracket."""
    bare = re.split(r"\s*[|｜]\s*| - (?=[^-]*$)", page.title.strip())[0]
    return re.sub(r"[（(][^（）()]*[）)]\s*$", "", bare).strip()


def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with title, date and body; a null page has an empty title and nulls."""
    keys = [c for c in pages.columns if c != html]
    schema = ", ".join(f"`{c}` {dict(pages.dtypes)[c]}" for c in keys) + f", {PAGE_FIELDS}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [parse_page(h) for h in b[html]]
            yield b[keys].assign(title=[page_title(p) for p in got], date=[p.date for p in got], body=[page_body(p) for p in got])

    return pages.mapInPandas(run, schema)


def page_links(pages: DataFrame, base: str, prefix: str = "", contains: str = "", not_ending: str | None = None) -> DataFrame:
    """(url, link, pos): links of a page in order, each once, made absolute and filtered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for url, html in zip(b["url"], b["html"], strict=True):
                seen = dict.fromkeys(urljoin(base, h) for h, _ in parse_page(html).links)
                kept = [x for x in seen if x.startswith(prefix) and contains in x and not (not_ending and x.endswith(not_ending))]
                out += [(url, x, i) for i, x in enumerate(kept)]
            yield pd.DataFrame(out, columns=["url", "link", "pos"])

    return pages.select("url", "html").mapInPandas(run, "url string, link string, pos int")


def feed_items(feeds: DataFrame, most: int | None = None, exclude: str | None = None) -> DataFrame:
    """(url, pos, link, title, date): items of RSS and Atom feeds (url, xml) in their order, the first ``most`` of each
    feed, without those whose link holds ``exclude``. A feed that is no XML has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for url, xml in zip(b["url"], b["xml"], strict=True):
                try:
                    items = [x for x in ElementTree.fromstring(xml or "").iter() if x.tag.rsplit("}")[-1] in ("item", "entry")]
                except ElementTree.ParseError:
                    continue
                for pos, item in enumerate(items[:most]):
                    own = {c.tag.rsplit("}")[-1]: (c.text or c.get("href") or "").strip() for c in item}
                    if own.get("link") and not (exclude and exclude in own["link"]):
                        out.append((url, pos, own["link"], own.get("title", ""), own.get("pubDate") or own.get("published") or own.get("date")))
            yield pd.DataFrame(out, columns=["url", "pos", "link", "title", "date"])

    return feeds.select("url", "xml").mapInPandas(run, "url string, pos int, link string, title string, date string")


def roster_rows(pages: DataFrame, required: tuple[str, ...] = ("氏名", "学校")) -> DataFrame:
    """(url, table_id, section, pos, cells): data rows of the tables whose header has all required words; rows of
    headings only are skipped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for url, html in zip(b["url"], b["html"], strict=True):
                for k, t in enumerate(parse_page(html).tables):
                    if not t["rows"] or not all(any(w in c for _, c in t["rows"][0]) for w in required):
                        continue
                    data = [r for r in t["rows"][1:] if any(tag == "td" for tag, _ in r)]
                    out += [(url, k, t["section"], i, [c for _, c in r]) for i, r in enumerate(data)]
            yield pd.DataFrame(out, columns=["url", "table_id", "section", "pos", "cells"])

    return pages.select("url", "html").mapInPandas(run, "url string, table_id int, section string, pos int, cells array<string>")


def joined_pages(pages: DataFrame) -> DataFrame:
    """(url, body): bodies of a story's pages joined in page order."""
    lines = F.array_sort(F.collect_list(F.struct("page", "body")))
    return pages.groupBy("url").agg(F.array_join(F.transform(lines, lambda x: x["body"]), "\n").alias("body"))


def answer_json(text: str | None) -> list[dict]:
    """Objects of a model's answer: fences dropped, else the first bracketed span; [] where none is valid."""
    bare = re.sub(r"^\s*```[a-z]*|```\s*$", "", text or "", flags=re.M).strip()
    for part in (bare, *(m[0] for p in (r"\[.*\]", r"\{.*\}") if (m := re.search(p, bare, re.S)))):
        try:
            got = json.loads(part)
        except ValueError:
            continue
        return [x for x in (got if isinstance(got, list) else [got]) if isinstance(x, dict)]
    return []


def answer_csv(text: str | None, columns: int = 7, wide: int = 4) -> list[list[str]]:
    """Rows of a model's CSV answer: fences and header dropped; surplus commas belong to column ``wide``."""
    lines = [x for x in (text or "").splitlines() if x.strip() and not x.strip().startswith("```")]
    out = []
    for row in csv.reader(io.StringIO("\n".join(lines)), skipinitialspace=True):
        if len(row) > columns:
            extra = len(row) - columns
            row = [*row[:wide], ",".join(row[wide : wide + extra + 1]), *row[wide + extra + 1 :]]
        if len(row) == columns and row[0].strip() not in ("選手名", "player_name"):
            out.append([c.strip() for c in row])
    return out


def answers(df: DataFrame, key: str, text: str, names: list[str]) -> DataFrame:
    """(key, pos, names): rows of CSV answers as columns; unknown names are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, i, *r) for k, t in zip(b[key], b[text], strict=True) for i, r in enumerate(answer_csv(t, len(names))) if r[0] not in ("", "不明", "unknown")]
            yield pd.DataFrame(out, columns=[key, "pos", *names])

    return df.select(key, text).mapInPandas(run, f"`{key}` {dict(df.dtypes)[key]}, pos int, " + ", ".join(f"`{n}` string" for n in names))
