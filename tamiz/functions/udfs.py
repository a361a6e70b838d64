"""Functions that Spark lacks, as Arrow-batched pandas UDFs: exact Unicode normal forms and HTML to text."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _each(f, column: Column | str) -> Column:
    """A string function of Python over a column; made when used, as a UDF needs a session."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(f)

    return run(column)


def nfc(column: Column | str) -> Column:
    return _each(lambda x: None if x is None else unicodedata.normalize("NFC", x), column)


def fold_exact(column: Column | str) -> Column:
    """Compatibility decomposition without combining marks, lower case; null gives the empty string."""
    return _each(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x or "") if not unicodedata.combining(c)).lower(), column)


class _Paragraphs(HTMLParser):
    """The texts of paragraphs outside of scripts, styles, navigation, headers and footers."""

    SKIPPED = frozenset(("script", "style", "nav", "header", "footer"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []
        self.parts: list[str] | None = None
        self.skipping = 0

    def close_paragraph(self):
        if self.parts is not None:
            self.found.append(" ".join(p for p in (x.strip() for x in self.parts) if p))
            self.parts = None

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIPPED:
            self.skipping += 1
        elif tag == "p":
            self.close_paragraph()
            self.parts = []

    def handle_endtag(self, tag):
        if tag in self.SKIPPED and self.skipping:
            self.skipping -= 1
        elif tag == "p":
            self.close_paragraph()

    def handle_data(self, data):
        if self.parts is not None and not self.skipping:
            self.parts.append(data)


def paragraphs(html: str | None, longer_than: int = 40, least: int = 500) -> tuple[str, str]:
    """(text, source): paragraphs of more than ``longer_than`` characters, if they sum to more than ``least``, else a failure."""
    p = _Paragraphs()
    p.feed(html or "")
    p.close()
    p.close_paragraph()
    text = "\n\n".join(x for x in p.found if len(x) > longer_than)
    return (text, "parrafos") if len(text) > least else ("", "fallo_extraccion")


def html_to_text(html: Column, longer_than: int = 40, least: int = 500) -> Column:
    @F.pandas_udf("texto string, fuente string")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([paragraphs(x, longer_than, least) for x in s], columns=["texto", "fuente"])

    return run(html)
