"""Tables of HTML pages as rows."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self.table = self.row = -1
        self.cells: list[str] | None = None
        self.said: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table, self.row = self.table + 1, -1
        elif tag == "tr":
            self.row, self.cells = self.row + 1, []
        elif tag in ("td", "th"):
            self.said = []

    def handle_data(self, data):
        if self.said is not None:
            self.said.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.said is not None and self.cells is not None:
            self.cells.append(" ".join("".join(self.said).split()))
            self.said = None
        elif tag == "tr" and self.cells is not None:
            self.rows.append((self.table, self.row, self.cells))
            self.cells = None


def tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, table, row, cells: every row of every table; null pages have none."""

    def run(batches):
        for batch in batches:
            out = []
            for k, h in zip(batch["k"], batch["h"], strict=True):
                p = _Tables()
                p.feed(h or "")
                out += [(k, t, r, c) for t, r, c in p.rows]
            yield pd.DataFrame(out, columns=[key, "table", "row", "cells"])

    kind = dict(pages.dtypes)[key]
    return pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInPandas(run, f"`{key}` {kind}, table int, row int, cells array<string>")


def plain_text(html: Column) -> Column:
    """What a page says: scripts, styles, comments and tags off, entities of markup resolved."""
    s = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    s = F.regexp_replace(s, r"<[^>]*>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(s, r"\s+", " "))
