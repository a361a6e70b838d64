"""Topic relevance of titles, and tests for case reports and for English."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.text import WS, fold, let


def any_term(folded: Column, terms: tuple[str, ...]) -> Column:
    """Whether a folded text contains one of the terms, as a part of a word too. False for null."""
    return F.coalesce(folded.rlike("|".join(re.escape(t) for t in terms)), F.lit(False))


def relevance(title: Column, abstract: Column | None = None, strong: tuple[str, ...] = D.ONCOLOGY_STRONG, weak: tuple[str, ...] = D.ONCOLOGY_WEAK) -> Column:
    """'alta' for a strong stem in the title, 'media' for a weak one or a strong one in the abstract, else null."""
    t = fold(title)
    out = F.when(any_term(t, strong), "alta").when(any_term(t, weak), "media")
    return out.when(any_term(fold(abstract), strong), "media") if abstract is not None else out


def is_case_report(title: Column, kind: Column, phrases: tuple[str, ...] = D.CASE_PHRASES) -> Column:
    return any_term(fold(title), phrases) | (fold(kind) == "case-report")


def english_title(title: Column, words: tuple[str, ...] = D.ENGLISH_TITLE_WORDS) -> Column:
    """An English word in the folded title and no small accented letter in the title itself."""
    return fold(title).rlike(rf"(?U)\b(?:{'|'.join(words)})\b") & ~F.coalesce(title, F.lit("")).rlike("[áéíóúñ]")


def english_body(text: Column, headings: tuple[str, ...] = D.ENGLISH_HEADINGS, head: int = 4000) -> Column:
    """At least two English headings at line starts of the first ``head`` characters, without 'discusion' there. Null texts are not."""


    def two(t: Column) -> Column:
        hits = reduce(lambda a, b: a + b, (F.concat(F.lit("\n"), t).rlike(rf"(?U)\n{WS}*\Q{h}\E\b").cast("int") for h in headings))
        return ~F.contains(t, F.lit("discusion")) & (hits >= 2)

    return F.coalesce(F.when(text.isNotNull(), let(fold(F.substring(text, 1, head)), two)), F.lit(False))


def looks_spanish(text: Column) -> Column:
    """Spanish letters or signs, or three function words."""
    words = r"(?U)\b(?:de|la|el|en|los|las|una|con|por|que|del|se|un)\b"
    return text.rlike("[áéíóúñ¿¡ÁÉÍÓÚÑ]") | (F.regexp_count(F.lower(text), F.lit(words)) >= 3)
