"""Problem 8: evaluation texts leaking into training text. A distributed positional inverted index.

1. The test items are few and fixed in number (``MOST_ITEMS``); their words are the index' vocabulary. A vocabulary word is only indexed
   if some window of ``run`` item words needs it: function words are left out unless a window has fewer than ``anchors`` others.
2. One pass over the corpus writes postings (term, document, positions) of the indexed words.
3. Document frequencies come from the postings. Each window of an item takes its ``anchors`` rarest terms. Their postings are shifted by
   the term's place in the item; where all anchors of a window meet at one shift, the document may hold the window.
4. Those documents' words are compared at that shift, whole runs at a time: exact phrase matches of at least ``run`` words.
A hot word is no hot group: postings meet by (document, item, shift).
5. ``proximity`` counts the same anchors within a few words of their places: passages with words changed or put in.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import cut, narrowed, scan
from .pages import FUNCTION, fold

MOST_ITEMS = 100_000
RUN = 12
ANCHORS = 2
_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> list[str]:
    """Maximal runs of letters and digits, without case and accents."""
    return _WORD.findall(fold(text))


def item_terms(items: DataFrame, key: str = "item_id", text: str = "texto") -> dict[int, list[str]]:
    """The words of each test item, on the driver. There may be at most MOST_ITEMS items; more are refused, none are left out."""
    rows = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text).limit(MOST_ITEMS + 1).collect()
    if len(rows) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} test items")
    return {k: t for k, t in ((r[0], terms(r[1])) for r in rows) if t}


def vocabulary(items: dict[int, list[str]], run: int = RUN, anchors: int = ANCHORS) -> dict[str, int]:
    """The terms to index, numbered: all but function words, and those too in windows with fewer than ``anchors`` others."""
    out: set[str] = set()
    for t in items.values():
        for i in range(len(t) - run + 1):
            window = set(t[i:i + run])
            rare = window - FUNCTION
            out |= rare if len(rare) >= anchors else window
    return {w: i for i, w in enumerate(sorted(out))}


def index(corpus: DataFrame, words: dict[str, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, doc, positions) postings of the numbered words; null texts have none."""
    kind = corpus.schema[key].dataType.simpleString()

    def rows(it):
        get = words.get
        for k, t in it:
            places = defaultdict(list)
            for i, w in enumerate(terms(t)):
                n = get(w)
                if n is not None:
                    places[n].append(i)
            for n, at in places.items():
                yield n, k, at

    return scan(corpus.where(F.col(text).isNotNull()).select(key, text), f"term int, doc {kind}, at array<int>", rows)


def windows(items: dict[int, list[str]], words: dict[str, int], df: dict[int, int], run: int, anchors: int) -> dict[int, list[tuple[int, ...]]]:
    """For each item the different sets of places of its windows' rarest terms. A window with a term that no document has is left out."""
    out: dict[int, list[tuple[int, ...]]] = {}
    for k, t in items.items():
        sets = set()
        for i in range(len(t) - run + 1):
            known = [j for j in range(i, i + run) if t[j] in words]
            if not known or any(words[t[j]] not in df for j in known):
                continue
            sets.add(tuple(sorted(sorted(known, key=lambda j: (df[words[t[j]]], j))[:anchors])))
        if sets:
            out[k] = sorted(sets)
    return out


def longest_run(a: list[str], b: list[str], shift: int) -> tuple[int, int]:
    """(words, start in b) of the longest run with a[shift + j] == b[j]."""
    best = start = n = 0
    for j in range(max(0, -shift), min(len(b), len(a) - shift)):
        n = n + 1 if a[shift + j] == b[j] else 0
        if n > best:
            best, start = n, j - n + 1
    return best, start


def _postings(corpus: DataFrame, tests: dict[int, list[str]], key: str, text: str, run: int, anchors: int) -> tuple[DataFrame, dict[int, list[tuple[int, ...]]], DataFrame | None]:
    """(postings, anchor places of each item's windows, postings shifted by the anchors' places as (doc, item, j, p))."""
    words = vocabulary(tests, run, anchors)
    postings = cut(index(corpus, words, key, text))
    df = {r.term: r.n for r in postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the vocabulary
    sets = windows(tests, words, df, run, anchors)
    if not sets:
        return postings, sets, None
    places = sorted({(words[tests[k][j]], k, j) for k, s in sets.items() for x in s for j in x})
    wanted = corpus.sparkSession.createDataFrame([Row(term=t, item=k, j=j) for t, k, j in places], "term int, item bigint, j int")  # bounded by the items
    return postings, sets, postings.join(F.broadcast(wanted), "term").select("doc", "item", "j", F.explode("at").alias("p"))


def leaks(corpus: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, anchors: int = ANCHORS) -> DataFrame:
    """(key, item_id, words, item_start) of each document and item that share at least ``run`` consecutive words: their longest run.

    Null, empty and short texts and items match nothing. Repeated rows count once. An empty corpus gives an empty result.
    """
    kind = corpus.schema[key].dataType.simpleString()
    spark = corpus.sparkSession
    out = f"{key} {kind}, item_id bigint, words int, item_start int"
    tests = item_terms(items)
    _, sets, placed = _postings(corpus, tests, key, text, run, anchors)
    if placed is None:
        return spark.createDataFrame([], out)
    shifted = (
        placed.groupBy("doc", "item", (F.col("p") - F.col("j")).alias("shift")).agg(F.collect_set("j").alias("js"))
        .where(F.size("js") >= min(anchors, min(len(x) for s in sets.values() for x in s)))
    )

    def meet(it):
        for doc, item, shift, js in it:
            have = set(js)
            if any(have.issuperset(x) for x in sets[item]):
                yield doc, item, shift

    near = scan(shifted.select("doc", "item", "shift", "js"), f"doc {kind}, item bigint, shift int", meet)
    per = cut(near.groupBy("doc").agg(F.collect_set(F.struct("item", "shift")).alias("s")))

    def confirm(it):
        for k, t, s in it:
            a = terms(t)
            best: dict[int, tuple[int, int]] = {}
            for x in s:
                found = longest_run(a, tests[x["item"]], x["shift"])
                if found[0] >= run:
                    best[x["item"]] = max(best.get(x["item"], (0, 0)), found)
            for item, (n, at) in best.items():
                yield k, item, n, at

    both = narrowed(corpus.select(F.col(key).alias("doc"), text), per, "doc").join(per, "doc")
    return scan(both.select("doc", text, "s"), out, confirm).groupBy(key, "item_id").agg(F.max("words").alias("words"), F.min("item_start").alias("item_start"))


def proximity(corpus: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, anchors: int = 4, slack: int = 8, least: int = 5, most: int = 12) -> DataFrame:
    """(key, item_id, terms, span) of documents that hold an item's rare terms near where the item has them: proximity matches.

    Of the item's anchor terms, the rarest of its windows, half, but at least ``least`` and no more than ``most``, have to stand in one
    stretch of the document, each at most ``slack`` words before or after its place in the item, so words may have been put in, left out
    or changed between them. ``terms`` counts them, ``span`` is how many words of the item they cover. It needs the postings alone; no text is read again.
    """
    kind = corpus.schema[key].dataType.simpleString()
    out = f"{key} {kind}, item_id bigint, terms int, span int"
    _, sets, placed = _postings(corpus, item_terms(items), key, text, run, anchors)
    if placed is None:
        return corpus.sparkSession.createDataFrame([], out)
    half = [(k, min(max(least, (len({j for x in s for j in x}) + 1) // 2), most)) for k, s in sets.items()]
    need = corpus.sparkSession.createDataFrame(half, "item bigint, need int")  # a row for each item
    shift = F.col("p") - F.col("j")
    # two grids, half a cell apart: shifts that differ by no more than slack share a cell of one of them
    cells = placed.withColumn("cell", F.explode(F.array(F.floor(shift / (2 * slack)) * 2, F.floor((shift + slack) / (2 * slack)) * 2 + 1)))
    met = cells.groupBy("doc", "item", "cell").agg(F.count_distinct("j").alias("terms"), (F.max("j") - F.min("j") + 1).alias("span"))
    met = met.where(F.col("terms") >= least).join(F.broadcast(need), "item").where(F.col("terms") >= F.col("need"))
    return met.groupBy(F.col("doc").alias(key), F.col("item").alias("item_id")).agg(F.max("terms").cast("int").alias("terms"), F.max_by("span", "terms").cast("int").alias("span"))


def item_report(found: DataFrame) -> DataFrame:
    """(item_id, documents, longest) of each leaked item."""
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("words").alias("longest"))
