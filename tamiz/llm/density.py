"""Problem 3: page boilerplate mixed with main content. Composite text density over the DOM of each page (see ``pages``).

1. One pass counts, for each site and line (folded, numbers as 0), the pages that hold it; counts are summed before they are shuffled.
   Lines in ``site_pm`` thousandths of a site's pages, or in ``all_pm`` of all pages and in at least ``sites`` sites, are recurring: link text.
2. A second pass reads each page's DOM and decides line by line by its densities.

The recurring lines are few: a page of L lines on average gives at most 1000 L / site_pm for each site. They are sent to all tasks if
there are at most MOST_LINES of them (8 bytes each), else each page's own are joined to it by its key.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, journal, scan
from .lines import signed
from .pages import line_key, page_lines, repair

MOST_LINES = 2_000_000
_FLUSH = 200_000


_hash = xxhash.xxh64_intdigest  # of a key; with its site by exclusive or


def _keys(text: str) -> set[str]:
    return {line_key(s) for x in repair(text).split("\n") if (s := x.strip())} - {""}


def recurring(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text", site_pm: int = 20, all_pm: int = 2, sites: int = 3, least: int = 5) -> DataFrame:
    """(h): hashes of the recurring lines, with their site or, for lines of several sites, without. A page counts a line once."""

    def rows(it):
        n: Counter = Counter()
        pages: Counter = Counter()

        def flush():
            for (site, k), c in n.items():
                h = _hash(k)
                yield site, signed(h ^ _hash(site)), signed(h), c
            for site, c in pages.items():
                yield site, None, None, c
            n.clear()
            pages.clear()

        for p, t in it:
            site = p[1:10] if p else ""
            pages[site] += 1
            n.update((site, k) for k in _keys(t))
            if len(n) > _FLUSH:
                yield from flush()
        yield from flush()

    counted = cut(scan(df.where(F.length(F.trim(text)) > 0).select(pid, text), "site string, h bigint, g bigint, c bigint", rows).groupBy("site", "h", "g").agg(F.sum("c").alias("c")))
    lines, pages = counted.where("h is not null"), counted.where("h is null").select("site", F.col("c").alias("pages"))
    per_site = lines.where(F.col("c") >= least).join(pages, "site").where(F.col("c") * 1000 >= F.col("pages") * site_pm).select("h")
    whole = pages.agg(F.sum("pages").alias("whole"))  # one row
    across = (
        lines.groupBy("g").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).where((F.col("n") >= sites) & (F.col("c") >= least))
        .join(F.broadcast(whole)).where(F.col("c") * 1000 >= F.col("whole") * all_pm).select(F.col("g").alias("h"))
    )
    return per_site.unionByName(across).distinct()


def _member(has: frozenset[int], site: str):
    """Whether a line's key is one of the recurring ones, by hash, of several sites or of its own."""
    own = _hash(site)

    def known(key: str) -> bool:
        h = _hash(key)
        return h in has or h ^ own in has

    return known


def _decided(df: DataFrame, key: str, pid: str, text: str, schema: str, emit) -> DataFrame:
    """``emit`` of (key, text, lines) for each page, its lines decided with the recurring ones."""
    found = cut(recurring(df, key, pid, text))
    texts = df.select(key, F.coalesce(journal(F.col(pid)), F.lit("")).alias("site"), text)
    if found.count() <= MOST_LINES:
        known = np.sort(found.toArrow()["h"].to_numpy())  # at most MOST_LINES numbers

        def each(it):
            has = frozenset(known.view(np.uint64).tolist())
            for k, site, t in it:
                yield from emit(k, t, page_lines(t, _member(has, site)))

        return scan(texts, schema, each)
    kind = df.schema[key].dataType.simpleString()
    own = scan(texts.where(F.length(F.trim(text)) > 0), f"k {kind}, site string, h bigint", lambda it: ((k, site, h) for k, site, t in it for x in map(_hash, _keys(t)) for h in (signed(x), signed(x ^ _hash(site)))))
    per = own.join(found, "h").groupBy(F.col("k").alias(key), "site").agg(F.collect_set("h").alias("hs"))

    def mine(it):
        for k, site, t, hs in it:
            yield from emit(k, t, page_lines(t, _member(frozenset(h & (1 << 64) - 1 for h in hs or ()), site)))

    return scan(texts.join(per, [key, "site"], "left").select(key, "site", text, "hs"), schema, mine)


def page_parts(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text") -> DataFrame:
    """One row (key, line_no) for each non-blank line that is not part of the article.

    Null, empty and blank texts give no row; repeated rows give one row each (keys are unique in preanot); a null pid belongs to no
    site; other columns are not read; a text of any length is read whole; an empty table gives an empty result.
    """
    kind = df.schema[key].dataType.simpleString()

    def emit(k, t, lines):
        return ((k, x.no) for x in lines if x.kind == "page") if t and t.strip() else ()

    return _decided(df, key, pid, text, f"{key} {kind}, line_no int", emit)


def main_content(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text") -> DataFrame:
    """(key, main, kept, dropped): the article's lines, without tags, joined by LF, and how many lines were kept and left out.

    Null text: main is null with 0 and 0. Blank text: main is empty.
    """
    kind = df.schema[key].dataType.simpleString()

    def emit(k, t, lines):
        keep = [x.text for x in lines if x.kind != "page"]
        n = sum(x.kind not in ("page", "blank") for x in lines)
        yield k, None if t is None else "\n".join(keep).strip(), n, sum(x.kind == "page" for x in lines)

    return _decided(df, key, pid, text, f"{key} {kind}, main string, kept int, dropped int", emit)
