"""Problem 4: per-document text statistics and outlier scores from exact ranks (empirical-cumulative tails, "ECOD").

1. One pass takes the statistics of a text's article lines and its language (most function words). Ratios are rounded to 3 places, other
   values to 3 digits, so a statistic has at most some thousand different values however many texts there are.
2. Values are pre-aggregated to (language, statistic, value, count). They are range-partitioned and sorted; each partition
   accumulates its counts, the partitions' totals become offsets, so every value has its exact rank within its language.
3. The tails -ln P(X <= x) and -ln P(X >= x) of a document's statistics are summed: left, right, and by the side to which each
   statistic is skewed; the outlier score is the largest of the three sums. ``unprose`` sums the tails on the sides where lists, tables
   and junk lie: few lines that end in a stop, few common words, short lines, many list lines.
4. Tails of unrelated statistics are exponential, so their sum is a gamma variable, whose quantiles are the bounds: a text beyond the
   upper one is not prose; one between both is if its sentences have most of the characters (the exact check); one below is prose.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lexicon as X
from .common import cut, running_total, scan
from .pages import Line, page_lines

STATISTICS = ("mean_word", "symbols", "digits", "ended_lines", "common_words", "loose_share", "line_words", "length")
#: the sides on which a statistic speaks against prose
AGAINST = {"ended_lines": "left_", "common_words": "left_", "line_words": "left_", "loose_share": "right_"}
_LETTERS = bytes(b for b in range(256) if chr(b).isalpha())
_ENDED = re.compile(r"[.!?…][\"”»')\]]*$")
_LANG = {lang: frozenset(ws.split()) for lang, ws in X.FUNCTION_WORDS.items()}
_ALL = frozenset().union(*_LANG.values())


def three(x: float) -> float:
    """A number to three digits."""
    return float(f"{x:.3g}")


def gamma_bound(shape: int, beyond: float) -> float:
    """The value that a sum of ``shape`` exponential variables exceeds with the probability ``beyond``."""
    low, high = 0.0, 1e3
    for _ in range(80):
        x = (low + high) / 2
        term = total = math.exp(-x)
        for i in range(1, shape):
            term *= x / i
            total += term
        low, high = (x, high) if total > beyond else (low, x)
    return low


def shares(lines: list[Line]) -> tuple[int, int]:
    """Characters of sentences, and of lists, tables and junk; headings, references, captions and the like count as neither."""
    prose = sum(len(x.text) for x in lines if x.kind == "prose")
    return prose, sum(len(x.text) for x in lines if x.kind == "list")


def statistics(lines: list[Line], words_in_text: int) -> tuple:
    """(lang, words, values of STATISTICS, prose and loose characters) of an article, rounded.

    Words are blank-separated; letters beyond Latin-1 count as symbols.
    """
    body = [x for x in lines if x.kind not in ("page", "blank")]
    text = "\n".join([x.text for x in body])
    words = text.lower().split()
    n, chars = max(len(words), 1), max(len(text), 1)
    votes = Counter(filter(_ALL.__contains__, words))
    lang = "?"
    if sum(votes.values()) >= 0.12 * n:
        lang = max(_LANG, key=lambda k: (sum(c for w, c in votes.items() if w in _LANG[k]), k == "es"))
    raw = text.encode("latin-1", "replace")
    letters, digits, blanks = (len(raw) - len(raw.translate(None, x)) for x in (_LETTERS, b"0123456789", b" \t\n\r\xa0"))
    prose, loose = shares(lines)
    return (
        lang, words_in_text,
        [
            three(letters / n), round((chars - letters - digits - blanks) / chars, 3), round(digits / chars, 3),
            round(sum(1 for x in body if _ENDED.search(x.text)) / max(len(body), 1), 3), round(sum(votes.values()) / n, 3),
            round(loose / max(prose + loose, 1), 3), three(round(n / max(len(body), 1))), three(words_in_text),
        ],
        prose, loose,
    )


def text_statistics(df: DataFrame, key: str = "task_id", text: str = "text") -> DataFrame:
    """(key, lang, words, one DOUBLE column for each of STATISTICS, prose_chars, loose_chars).

    ``words`` counts the blank-separated words of the whole text. Null and blank texts: lang '?', 0 words, null statistics.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(it):
        for k, t in it:
            if t is None or not t.strip():
                yield (k, "?", 0, *[None] * len(STATISTICS), 0, 0)
                continue
            lang, n, values, prose, loose = statistics(page_lines(t), len(t.split()))
            yield (k, lang, n, *values, prose, loose)

    return scan(df.select(key, text), f"{key} {kind}, lang string, words int, {', '.join(f'{s} double' for s in STATISTICS)}, prose_chars int, loose_chars int", rows)


def exact_ranks(values: DataFrame) -> DataFrame:
    """From (lang, stat, value) rows: (lang, stat, value, at_most, at_least, n, skew) for each different value.

    ``at_most`` and ``at_least`` count the rows of (lang, stat) with a value up to, and from, this one. Nulls are left out.
    """
    counts = values.where("value is not null").groupBy("lang", "stat", "value").agg(F.count(F.lit(1)).alias("c"))
    ranked = cut(running_total(counts.withColumn("g", F.concat_ws("/", "stat", "lang")), "g", ["value"], "c"))
    moments = ranked.groupBy("g").agg(F.sum("c").alias("n"), *(F.sum(F.col("c") * F.pow("value", F.lit(k))).alias(f"m{k}") for k in (1, 2, 3)))
    m = F.col("m1") / F.col("n")
    third = F.col("m3") / F.col("n") - 3 * m * F.col("m2") / F.col("n") + 2 * m * m * m
    # moments has a row for each language and statistic
    return ranked.join(F.broadcast(moments), "g").select(
        "lang", "stat", "value", (F.col("before") + F.col("c")).alias("at_most"), (F.col("n") - F.col("before")).alias("at_least"), "n", F.signum(third).alias("skew"),
    )


def outlier_scores(stats: DataFrame, key: str = "task_id") -> DataFrame:
    """(key, score, unprose) for texts with statistics: see the module. Ties share a rank.

    Texts with too few function words for a language, and languages of less than one text in a hundred, are ranked among the texts of
    the commonest language: a group of nothing but odd texts would hide them. A single text scores 0.
    """
    size = {r.lang: r.n for r in stats.where(F.col(STATISTICS[0]).isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    main = max((k for k in size if k != "?"), key=lambda k: (size[k], k), default="?")
    own = [k for k, n in size.items() if k != "?" and 100 * n >= sum(size.values())]
    texts = stats.where(F.col(STATISTICS[0]).isNotNull()).withColumn("among", F.when(F.col("lang").isin(own), F.col("lang")).otherwise(main))
    long = texts.select(F.col("among").alias("lang"), F.inline(F.array(*(F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in STATISTICS))))
    ranks = cut(exact_ranks(long))
    out = texts
    for s in STATISTICS:  # rounding bounds the values, so that the ranks of a statistic fit in every task
        side = lambda n: (-F.log(F.col(n) / F.col("n")))
        t = ranks.where(F.col("stat") == s).select(
            F.col("lang").alias("among"), F.col("value").alias(s), F.struct(side("at_most").alias("left_"), side("at_least").alias("right_"), F.col("skew").alias("skew")).alias(f"_{s}")
        )
        out = out.join(F.broadcast(t), ["among", s])
    total = lambda xs: sum(xs, F.lit(0.0))
    left, right = (total([F.col(f"_{s}.{x}") for s in STATISTICS]) for x in ("left_", "right_"))
    skewed = total([F.when(F.col(f"_{s}.skew") < 0, F.col(f"_{s}.left_")).otherwise(F.col(f"_{s}.right_")) for s in STATISTICS])
    unprose = total([F.col(f"_{s}.{x}") for s, x in AGAINST.items()])
    return out.select(key, F.round(F.greatest(left, right, skewed), 6).alias("score"), F.round(unprose, 6).alias("unprose"), "prose_chars", "loose_chars")


def not_prose(df: DataFrame, key: str = "task_id", text: str = "text", beyond: tuple[float, float] = (0.05, 0.001)) -> DataFrame:
    """(key, unprose) of the texts that are for more than half a list, a table or junk.

    ``beyond`` are the probabilities of the bounds. Null and blank texts are none; repeated rows give repeated rows.
    """
    low, high = (gamma_bound(len(AGAINST), x) for x in beyond)
    scored = outlier_scores(cut(text_statistics(df, key, text)), key)
    return scored.where((F.col("unprose") > high) | (F.col("unprose") > low) & (F.col("loose_chars") > F.col("prose_chars"))).select(key, "unprose")
