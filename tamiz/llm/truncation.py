"""Problem 5: text cut off by field limits. A pushdown automaton over the article, and terminators against each source's baseline.

1. One pass runs the automaton over a text's article lines (``pages``). An open sentence, bracket or quote is on its stack until its
   terminator or closing sign, a paragraph's end clears it; a marked-up text adds the elements that stay open in its tags. At the end of
   the article the state is read: broken (a half multibyte sequence, escape, entity or tag, or a mark such as "Read more"), something open
   inside the sentence, or only the sentence itself.
2. Whether an open sentence is the author's habit or a cut follows from corpus counts: how often the last words stand before a terminator
   elsewhere, or from the source's baseline, the share of its paragraphs that have no terminator, which also smooths the former.
3. Lengths that pile up are field limits: a source's texts of a length that many of its texts have are cut if their sentence is open.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, journal, scan
from .pages import Line, page_lines
from .quality import shares

_NUMBER = re.compile(r"\d[\d.,]*(?<=\d)")
_TERMINATED = re.compile(r"[.!?][\"”»')\]]*$")
# Marks that a site or field limit leaves where it cut.
_MARK = re.compile(r"(?:\.\.\.|…|\(\.\.\.\)|\(…\)|\[\.\.\.\]|\[…\])\s*$|(?:leer|ver|read|seguir|lire|leia)\s+(?:m\S{1,3}s|more|leyendo|la suite|mais)\s*\W*$", re.I)
_TABULAR = re.compile(r"\t| {3,}|\s\.{3,}\s|;\S|\s\|\s|^\+[-+]+|\.{4,}|^[-*•»·]\s|^\d{1,3}[.)]\s|^[^:.]{3,40}: \S+(?: \S+)?$")
_CLOSES = {")": "(", "]": "[", "}": "{", "»": "«", "”": "“"}
_SIGN = re.compile(r"[()\[\]{}«»“”\"]|[.!?…]+(?=[\"”»')\]]*(?:\s|$))")
_WORD = re.compile(r"[^\W_]")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b[^<>]*?(/?)>")
_HALF_TAG = re.compile(r"</?[a-zA-Z][^<>]*$")
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9a-f]+|[a-z]{2,8});", re.I)
# Elements without an end tag, and those whose end tag may be left out.
_LOOSE = frozenset("area base br col embed hr img input link meta source track wbr p li dt dd tr td th thead tbody tfoot option html head body".split())
_FLUSH = 400_000
SENTENCE = "S"
PRIOR = 4  # how many observations the baseline of the next wider count is worth
PILE = 5  # open sentences of one length, with different last words, that make it a field limit, if they are three times as many as around it


class End(NamedTuple):
    """The automaton's state at the end of an article: what is open, outermost first, and the last paragraph."""

    stack: str
    paragraph: str


def automaton(paragraphs: list[list[str]]) -> End:
    """Runs over the lines of paragraphs. Closing signs without an opening one are skipped; a terminator ends a sentence, not a bracket."""
    stack: list[str] = []
    whole = ""
    for lines in paragraphs:
        stack.clear()  # what a paragraph left open stays there
        whole = " ".join(lines)
        at, ended = 0, 0
        for m in _SIGN.finditer(whole):
            c = m.group()
            if SENTENCE not in stack and _WORD.search(whole, at, m.start()):
                stack.insert(0, SENTENCE)
            at = m.end()
            if c in _CLOSES:
                if _CLOSES[c] in stack:
                    while stack.pop() != _CLOSES[c]:
                        pass
            elif c == '"':
                if c in stack:
                    while stack.pop() != c:
                        pass
                else:
                    stack.append(c)
            elif c[0] in ".!?…":
                ended = at
                if stack[:1] == [SENTENCE]:
                    del stack[0]
            else:
                stack.append(c)
        if SENTENCE not in stack and _WORD.search(whole, max(at, ended)):
            stack.insert(0, SENTENCE)
    return End("".join(stack), whole)


def open_at_end(text: str) -> str:
    """What the automaton has on its stack at the end of one paragraph."""
    return automaton([[text]]).stack if text else ""


def open_elements(text: str) -> list[str]:
    """The elements of a marked-up text without end tag; tags that close nothing are skipped."""
    stack: list[str] = []
    for m in _TAG.finditer(text):
        name = m.group(2).lower()
        if name in _LOOSE or m.group(3):
            continue
        if not m.group(1):
            stack.append(name)
        elif name in stack:
            while stack.pop() != name:
                pass
    return stack


def broken_end(text: str) -> bool:
    """Whether a text stops within a multibyte sequence, an escape, a tag, or, if it has entities, within one."""
    tail = text[-12:]
    if re.search(r"�$|\\$|\\u[0-9a-fA-F]{0,3}$|\\x[0-9a-fA-F]?$", tail):
        return True
    return "&" in tail and re.search(r"&#?\w{0,7}$", tail) is not None and _ENTITY.search(text) is not None or "<" in text and _HALF_TAG.search(text) is not None


def tokens(text: str) -> list[str]:
    """Blank-separated words in lower case, with 0 for numbers."""
    return _NUMBER.sub("0", text.lower()).split()


def paragraphs(body: list[Line]) -> list[list[str]]:
    """The article's lines as paragraphs; a line of prose without terminator goes on in the next one."""
    out: list[list[str]] = []
    goes_on = False
    for x in body:
        if goes_on and x.kind == "prose":
            out[-1].append(x.text)
        else:
            out.append([x.text])
        goes_on = x.kind == "prose" and not _TERMINATED.search(x.text)
    return out


def ending(lines: list[Line], raw: str = "") -> tuple[str, str, str]:
    """(verdict, last word pair, last word): verdict is complete, cut or open, which the corpus decides; blank without article."""
    body = [x for x in lines if x.kind not in ("page", "blank")]
    if not body:
        return "blank", "", ""
    prose, loose = shares(lines)
    last = body[-1]
    s = last.text
    if "<" in raw and (_HALF_TAG.search(raw) or "</" in raw and open_elements(raw)):
        return "cut", "", ""
    if loose > prose or last.kind not in ("prose", "list") or last.kind == "list" and (_TABULAR.search(s) or len(body) < 2 or body[-2].kind not in ("prose", "heading")):
        return "complete", "", ""
    parts = paragraphs(body)
    if last.kind == "list" and len(parts) > 1 and body[-2].kind == "prose" and not _TERMINATED.search(body[-2].text):
        parts[-2:] = [parts[-2] + parts[-1]]  # the line where the prose stopped
    end = automaton(parts)
    if _MARK.search(s) or broken_end(s) or s[-1] in ",;-–(" or end.stack.strip(SENTENCE):
        return "cut", "", ""
    if not end.stack:
        return "complete", "", ""
    t = tokens(end.paragraph)[-2:]
    return "open", " ".join(t), t[-1] if t else ""


def endings(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text") -> DataFrame:
    """(key, pid, verdict, complete_share, at_limit, paragraphs, unended) for each row; verdict blank, complete or cut.

    Null and blank texts are blank; a null pid has a null journal of its own. ``complete_share`` is what decided an open sentence.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(it):
        seen: Counter = Counter()

        def flush():
            for t, n in seen.items():
                yield None, None, None, t, n, 0, None, None
            seen.clear()

        for k, p, text_ in it:
            lines = page_lines(text_) if text_ and text_.strip() else []
            verdict, two, one = ending(lines, text_ or "")
            pars = [x.text for x in lines if x.kind == "prose" and len(x.text) >= 260]
            yield k, p, verdict, two, len(pars), sum(not _TERMINATED.search(x) for x in pars[:-1]), one, len(text_ or "")
            t = tokens("\n".join([x.text for x in lines if x.kind == "prose"]))
            seen.update(map(" ".join, zip(t, t[1:])))
            if len(seen) > _FLUSH:
                yield from flush()
        yield from flush()

    # one pass gives both the documents and the corpus counts; it is written once and read for each
    both = cut(scan(df.select(key, pid, text), f"k {kind}, p string, verdict string, two string, n bigint, e bigint, one string, size int", rows))
    docs = both.where("verdict is not null").select(
        F.col("k").alias(key), F.col("p").alias("pid"), F.coalesce(journal(F.col("p")), F.lit("")).alias("j"), "verdict", "two", "one", "size", F.col("n").alias("paragraphs"), F.col("e").alias("unended")
    )
    stop = r"[.!?]+[\"”»')\]]*$"
    pairs = (
        both.where("verdict is null").groupBy(F.regexp_replace("two", stop, "").alias("two"))
        .agg(F.sum("n").alias("n2"), F.sum(F.when(F.col("two").rlike(stop), F.col("n")).otherwise(0)).alias("e2"))
    )
    words = pairs.groupBy(F.element_at(F.split("two", " "), -1).alias("one")).agg(F.sum("n2").alias("n1"), F.sum("e2").alias("e1"))
    habit = docs.where("verdict <> 'blank'").groupBy("j").agg((F.sum("unended") / F.greatest(F.sum("paragraphs"), F.lit(1))).alias("habit"))
    lengths = docs.where("verdict = 'open'").groupBy("j", "size", "two").agg(F.count(F.lit(1)).alias("c")).groupBy("j", "size").agg(F.count(F.lit(1)).alias("c"))  # different ends: copies are no pile
    near = lengths.select("j", F.explode(F.array(*(F.col("size") + d for d in (-3, -2, 2, 3)))).alias("size"), "c").groupBy("j", "size").agg(F.sum("c").alias("around"))
    piles = lengths.where(F.col("c") >= PILE).join(near, ["j", "size"], "left").where(F.col("c") * 4 >= 3 * F.coalesce("around", F.lit(0))).select("j", "size", F.lit(True).alias("pile"))
    # only the open ones meet the counts: the others have no last words to look up, and would all have the same key
    open_ = docs.where("verdict = 'open'")
    smooth = lambda e, n, wider: (F.coalesce(F.col(e), F.lit(0)) + PRIOR * wider) / (F.coalesce(F.col(n), F.lit(0)) + PRIOR)
    judged = (
        open_.join(pairs.join(open_.select("two").distinct(), "two", "left_semi"), "two", "left")
        .join(words.join(open_.select("one").distinct(), "one", "left_semi"), "one", "left").join(habit, "j", "left").join(piles, ["j", "size"], "left")
        .withColumn("share", F.greatest(F.coalesce("habit", F.lit(0.0)), smooth("e2", "n2", smooth("e1", "n1", F.coalesce("habit", F.lit(0.0)))))).withColumn("at_limit", F.coalesce("pile", F.lit(False)))
        .select(key, "pid", F.when(~F.col("at_limit") & (F.col("share") >= 0.5), "complete").otherwise("cut").alias("verdict"), F.round("share", 4).alias("complete_share"), "at_limit", "paragraphs", "unended")
    )
    sure = docs.where("verdict <> 'open'").select(key, "pid", "verdict", F.lit(None).cast("double").alias("complete_share"), F.lit(False).alias("at_limit"), "paragraphs", "unended")
    return sure.unionByName(judged)


def source_rates(ended: DataFrame, triage: DataFrame | None = None) -> DataFrame:
    """(journal, texts, cut, rate) from ``endings``, and with ``triage`` (pid, calidad_recorte) also ``reported``: texts whose triage says cut.

    Blank texts are not counted as texts; a text is reported if any row of its pid says so.
    """
    seen = ended.where("verdict <> 'blank'").withColumn("journal", journal(F.col("pid")))
    counts = [F.count(F.lit(1)).alias("texts"), F.count_if(F.col("verdict") == "cut").alias("cut")]
    if triage is not None:
        said = triage.where(F.lower(F.trim("calidad_recorte")) == "truncado").select("pid").distinct().withColumn("said", F.lit(True))
        seen = seen.join(said, "pid", "left")
        counts.append(F.count_if("said").alias("reported"))
    return seen.groupBy("journal").agg(*counts).withColumn("rate", F.round(F.col("cut") / F.col("texts"), 4))
