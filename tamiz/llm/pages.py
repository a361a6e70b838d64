"""Lines of a fetched page: which belong to the article, and what kind they are.

The page is read as a DOM. Marked-up pages have one in their tags; a plain text page gets one from its blank lines, each line a
leaf with one tag. Every node has characters C, tags T, link characters LC and link tags LT, and the composite density

    CTD = C/T * log_b( C/LC * T/LT ),   b = ln( C/(C-LC) * LC + LC_body/C_body * C + e )

The subtree with the largest sum of its children's densities is the main one. Plain text has no <a>: a line that recurs in the pages of
its site or of several sites is link text (``repeated``, from corpus counts), unless it has the form of a heading, date, author, keyword,
caption, reference or table line; a line that reads like navigation, a prompt or a notice (``lexicon``) is so in part, as is a recurring sentence. A
line is page if its density, as a share of what it would be without link text and scaled by its block's share, is below half the least
share on the path from the main subtree to the body; in marked-up pages also if its container is. Pure Python without Spark, one pass a text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable
from typing import NamedTuple

from . import lexicon as X


class Line(NamedTuple):
    """One line: number from 1, visible text, and kind.

    Kinds: blank, page (around the article), title, heading, meta (dates, authors), keywords, caption, ref, prose, list.
    """

    no: int
    text: str
    kind: str


def _fold_table() -> dict[int, str]:
    """Single characters of the Latin blocks to their lower-case letter without accent, made by rule."""
    out: dict[int, str] = {}
    for c in range(0x41, 0x250):
        d = unicodedata.normalize("NFKD", chr(c).lower())
        d = "".join(x for x in d if not unicodedata.combining(x))
        if d and d != chr(c) and chr(c).isalpha():
            out[c] = d
    out |= {c: "" for c in range(0x300, 0x370)}
    return out


FOLD = _fold_table()
_LETTER = {chr(c): x for c, x in FOLD.items()}.get
_NON_ASCII = re.compile(r"[^\x00-\x7f]")


def fold(s: str) -> str:
    """Lower case without accents, by single characters; only what is not ASCII costs."""
    return _NON_ASCII.sub(lambda m: _LETTER(c := m.group(), c), s.lower())


FUNCTION = frozenset(x for ws in X.FUNCTION_WORDS.values() for w in ws.split() for x in (w, w.translate(FOLD)))
_SUSPECT = re.compile("[ÃÂÔ├┬√ГВâ�]")
_RUN = re.compile(r"[^\x00-\x7f]{2,}")
_CODECS = ("cp1252", "cp437", "cp1251", "mac_roman", "cp850")
_PAGE = re.compile(X.PAGE_PHRASES)
_NAV = frozenset(X.NAVIGATION.split("|"))
_NAVWORDS = frozenset(w for x in _NAV for w in x.split())
_TRIGGERS = frozenset(X.PAGE_TRIGGERS.split())
_SIDE = frozenset(X.SIDE_HEADINGS.split("|"))
_SEP = re.compile(r"\s*[|·›»«•\[\]<>^*/]+\s*|\s{2,}|\t| - |\.(?: |$)|[?¿!¡]|(?<=\S): ")
_COUNTER = re.compile(r"^(?:visitas?|descargas?|views?|downloads?|lecturas?|citas?) ?: ?\d[\d.,]*$|^\d+ comentarios?$|^\d+ comments?$|^[^\w]*[©®]|^\W*\(c\) ?\d{4}|^[^\w]*inicio ?>|^a[-+] ?a a[-+]$")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b([^<>]*?)(/?)>|<!--.*?-->|<([a-zA-Z][^<>]*)$")
_VOID = frozenset("br hr img meta link input".split())
_BULLET = re.compile(r"^[-*•»·▪–—]\s+")
_REF = re.compile(r"\[?\d{1,3}[.\])]\s+\S")
_REFTAIL = re.compile(r"(?:19|20)\d\d\s?;\s?\d+\s?(?:\(\d+\))?\s?:\s?\d+|\bdoi\.|https?://doi")
_KEY = re.compile(rf"^(?:{X.KEYWORD_OPENINGS})\b")
_CAPTION = re.compile(rf"^(?:{X.CAPTION_OPENINGS})\s*\d+[.:)\s-]")
_HEADS = frozenset(f"{X.SECTION_HEADINGS}|{X.REFERENCE_HEADINGS}".split("|"))
_REFHEADS = frozenset(X.REFERENCE_HEADINGS.split("|"))
_DATES = re.compile(r"^(?:recibido|received|recu|recebido|aceptado|accepted|aprobado|publicado)\b.*\d")
_AUTHORS = re.compile(r"^[A-ZÁÉÍÓÚÑÜ][\w'’-]+(?: [A-ZÁÉÍÓÚÑÜ][\w'’-]+)? [A-Z]{1,3}(?:, [A-ZÁÉÍÓÚÑÜ][\w'’-]+(?: [A-ZÁÉÍÓÚÑÜ][\w'’-]+)? [A-Z]{1,3})*\.?$")
_ROW = re.compile(r"\t| {3,}|\s\.{3,}\s|;\S|\s\|\s|^\+[-+]+\+?$|\.{4,}|\s\d{1,4}$")
_VOWELS = frozenset("aeiouyáéíóúãõâêôàèìòùäëïöüîûæœ")
_NUMBERED = re.compile(r"\d{1,3}[.)]\s")
_PAGED = re.compile(r"(?:\s|\.)\d{1,4}$")
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?:;…][\"”»')\]]*$")
_PAIR = re.compile(r"^[^\W\dA-ZÁÉÍÓÚÑ][^:.]{2,40}: (?:\S+)(?: \S+)?$")


_INSIDE = re.compile(r"(?<=[A-Za-z])[^\x00-\x7fáéíóúñüçãõâêôàèëïîùûÁÉÍÓÚÑÜÇÃÕÂÊÔÀ](?=[A-Za-z])|(?<=[a-z])[ÁÉÍÓÚÑÜÇÃÕÂÊÔÀÈÌÒÙÝÛ](?=[a-z])")
_STRANGE = re.compile(r"[^\x00-\x7fáéíóúñüçãõâêôàèëïîùûÁÉÍÓÚÑÜÇÃÕÂÊÔÀÉ«»…“”‘’–—•·©®ºª°±µβ²³½×¿¡´€\xa0\u0301\u0303]")
_SOLID = re.compile(r"\S*[^\x00-\x7f]\S*")
_HIGH = range(0x80, 0x100)
# character by character: Latin-1 read in an old code page, and an old code page read as Windows or Latin-1
_ONE_BYTE = [
    *({ord(bytes([b]).decode(c, "replace")): chr(b) for b in _HIGH if b > 0xA0} for c in ("cp850", "mac_roman", "cp437", "cp1251")),
    *({ord(x) if (x := bytes([b]).decode("cp1252", "ignore")) else b: bytes([b]).decode(c) for b in _HIGH} for c in ("cp850", "mac_roman")),
]
_WANTED = frozenset("áéíóúñãçêôâàõèÁÉÍÓÚÑÃÇÊÔÂ")


def _one_byte(text: str) -> str:
    """A text of one one-byte code that was read in another, read again if a pair of codes explains nearly all odd letters."""
    odd = "".join(_INSIDE.findall(text))
    if len(odd) < 3:
        return text
    best, most = None, 0.8 * len(odd)
    for table in _ONE_BYTE:
        n = sum(table.get(ord(x)) in _WANTED for x in odd)
        if n > most:
            best, most = table, n
    if best is None:
        return text
    table, signs = best, frozenset(odd)  # only words with such signs: other parts of the text may be whole


    def again(m: re.Match) -> str:
        w = m.group()
        if not signs.isdisjoint(w):
            return w.translate(table)
        return x if len(w) == 1 and (x := w.translate(table)) in "»«•·–—©®" else w  # a mark by itself

    return _SOLID.sub(again, text)


def _sloppy(s: str) -> bytes:
    """Windows-1252, its five unused bytes as the control characters of the same number."""
    return b"".join(bytes([ord(x)]) if ord(x) < 256 else x.encode("cp1252") for x in s)


def repair(text: str) -> str:
    """The text with letters of a wrong decoding read again; only to recognise phrases: no line is added, what stays odd is kept."""

    def again(m: re.Match) -> str:
        s = m.group()
        for c in _CODECS:
            try:
                out = (_sloppy(s) if c == "cp1252" else s.encode(c)).decode("utf-8")
            except UnicodeError:
                continue
            try:
                return _sloppy(out).decode("utf-8") if len(out) > 1 else out
            except UnicodeError:
                return out
        return s

    if text.isascii():
        return text
    if _SUSPECT.search(text):
        text = _RUN.sub(again, text)
    return _one_byte(text) if _STRANGE.search(text) else text


def _navigation(low: str) -> bool:
    """Whether a folded line is made of navigation labels alone."""
    if len(low) > 160:
        return False
    s = low.strip(" -*•»«·|[]<>^.:?¿!¡")
    if s in _NAV:
        return True
    parts = [p.strip(" -:.") for p in _SEP.split(low)]
    parts = [p for p in parts if p]
    if not parts:
        return False
    known = sum(p in _NAV for p in parts)
    if known == len(parts) or (len(parts) >= 3 and known >= 0.6 * len(parts)):
        return True
    if len(parts) == 1 or known:  # labels parted by single blanks
        left = s
        n = 0
        while left:
            for k in (3, 2, 1):
                head = " ".join(left.split(" ", k)[:k])
                if head.strip(" -:.,") in _NAV:
                    left, n = left[len(head):].lstrip(" -|·,"), n + 1
                    break
            else:
                return False
        return n > 0
    return False


def density(c: float, t: float, lc: float, lt: float, body_c: float, body_lc: float) -> float:
    """Composite text density of a node; 0 for an empty one."""
    if c <= 0:
        return 0.0
    lc = lc if lc < c - 0.5 else c - 0.5
    base = math.log(c / (c - lc) * lc + body_lc / (body_c or 1) * c + math.e)
    much = c / (lc if lc > 1 else 1) * (t or 1) / (lt or 1)
    return c / (t or 1) * math.log(much if much > 1.0001 else 1.0001) / math.log(base if base > 1.0001 else 1.0001)


def relative_density(c: float, t: float, lc: float, lt: float, body_c: float, body_lc: float) -> float:
    """A node's density as a share of what it would be without link text; 1 for an empty node."""
    whole = density(c, t, 0.0, 0.0, body_c, body_lc)
    return density(c, t, lc, lt, body_c, body_lc) / whole if whole > 0 else 1.0


_cache: dict[str, tuple[str, bool, list[str]]] = {}


_CLAUSES = re.compile(r"(?<=[.!?;])\s+")


def _notice(s: str) -> bool:
    """Whether sentences with phrases of notices make up most of a long line."""
    low = fold(s)
    if not any(t in low for t in _TRIGGERS):
        return False
    parts = [" ".join(x.split()) for x in _CLAUSES.split(low)]
    return 2 * sum(len(x) for x in parts if not _TRIGGERS.isdisjoint(_WORD.findall(x)) and _PAGE.search(x)) > sum(map(len, parts))


def _look(s: str) -> tuple[str, bool, list[str]]:
    """Folded line, whether it reads as part of the page, and its words; short lines recur, so they are kept.

    Lines of 260 characters and more are paragraphs: of the page if most of their sentences are notices.
    """
    if len(s) >= 260:
        low = s.lower()
        return low, _notice(s), low.split()
    hit = _cache.get(s)
    if hit is None:
        low = " ".join(fold(s).split())
        words = _WORD.findall(low)
        page = bool(_COUNTER.match(low)) or not _TRIGGERS.isdisjoint(words) and bool(_PAGE.search(low))
        if not page and words and len(words) <= 30 and sum(map(_NAVWORDS.__contains__, words)) >= 0.6 * len(words):
            page = _navigation(low)
        hit = (low, page, words)
        if len(s) < 120:
            if len(_cache) > 50_000:
                _cache.clear()
            _cache[s] = hit
    return hit


def _titleish(s: str, low: str) -> bool:
    """A line that can be another article's title: no stop at the end, some words, a capital first."""
    return bool(s) and len(s) < 130 and s[-1] not in ".;,:" and s[:1].isupper() and 2 <= low.count(" ") + 1 <= 18 and low not in _HEADS and not _AUTHORS.match(s) and not _DATES.match(low)


PRIOR = 0.6  # the part of a line's characters that are link text if it reads like one
RECURRING = 0.15  # the same of a sentence, or a piece of one, that recurs: a notice, or a statement of the article


def line_key(s: str) -> str:
    """What a line has in common with its like in other pages: its words without accents and case; a paragraph's are not folded."""
    return s.lower() if len(s) >= 260 else " ".join(_WORD.findall(fold(s)))


def recurs_by_form(s: str, low: str) -> bool:
    """Whether a line of this form may recur in articles: headings, dates, authors, keywords, captions, references and rows of tables."""
    return low.strip(" .:") in _HEADS or bool(_DATES.match(low) or _KEY.match(low) or _CAPTION.match(low) or _ROW.search(s) or _REFTAIL.search(s) or _AUTHORS.match(s) or _PAIR.match(s))


def _mass(s: str, low: str, words: list[str], reads: bool, repeated: Callable[[str], bool] | None) -> float:
    """The part of a line's characters that count as link text."""
    if repeated is not None and words and repeated(low if len(s) >= 260 else " ".join(words)) and (reads or not recurs_by_form(s, low)):
        sentence = s[:1].islower() or len(words) > 4 and prose_share(words) >= 0.2
        return RECURRING if sentence and not reads else 1.0
    return PRIOR if reads else 0.0


def prose_share(words: list[str]) -> float:
    return sum(map(FUNCTION.__contains__, words)) / len(words) if words else 0.0


def page_lines(text: str | None, repeated: Callable[[str], bool] | None = None) -> list[Line]:
    """Every line of a text with its kind; null gives no line, a blank text blank lines. ``repeated`` tells the keys of lines that recur in pages."""
    if text is None:
        return []
    raw = repair(text).split("\n")
    html = "</" in text and "<" in text
    n = len(raw)
    show, lows, page = [""] * n, [""] * n, [False] * n
    wordss: list[list[str]] = [[]] * n
    where: list[int] = [0] * n  # container of each line
    boxes = [[0.0, 0.0, 0.0, 0.0, -1]]  # C, T, LC, LT, parent; 0 is the body
    leaf: list[tuple[float, float, float, float]] = [(0, 1, 0, 0)] * n
    open_, names = [0], [""]
    after_blank = True
    inside_, link = "", 0  # the end of a script, style or comment, and a link, that go on from the line before
    ends = {e: max((i for i, r in enumerate(raw) if e in r.lower()), default=-1) for e in ("</script", "</style", "-->", "</a", ">")} if html else {}
    for i, r in enumerate(raw):
        tags = links = 0
        markup = False
        s = r.strip()
        if inside_:
            at = s.lower().find(inside_)
            if at < 0:
                where[i], page[i] = open_[-1], bool(s)
                continue
            s = s[at + {"-->": 3, ">": 1}.get(inside_, 0):]
            inside_ = ""
            if not s:
                where[i], page[i] = open_[-1], True
                continue
        if html and "<" in s:
            parts, at, lc, script = [], 0, 0, False
            links += link
            for m in _TAG.finditer(s):
                piece = s[at:m.start()]
                at = m.end()
                if not script:
                    parts.append(piece)
                    lc += len(piece) if link else 0
                tags, markup = tags + 1, True
                name = (m.group(2) or m.group(5) or "").lower()
                if m.group(5) and not script and ends[">"] > i:  # a tag over several lines
                    inside_ = ">"
                if name in ("script", "style"):
                    script = not m.group(1)
                    inside_ = f"</{name}" if script else ""
                elif name == "a":
                    link = 0 if m.group(1) else 1
                    links += 0 if m.group(1) else 1
                elif name in ("div", "nav", "ul", "aside", "section", "footer", "header", "table"):
                    if not m.group(1):
                        boxes.append([0.0, 0.0, 0.0, 0.0, open_[-1]])
                        open_.append(len(boxes) - 1)
                        names.append(name)
                    elif name in names[1:]:  # an end tag closes what it names and what is open in it; one without a start closes nothing
                        while names.pop() != name:
                            where[i] = open_.pop()
                        where[i] = open_.pop()
            rest = s[at:]
            if not script and "<!--" in rest and ends["-->"] > i:
                rest, inside_ = rest[:rest.index("<!--")], "-->"
            lc += len(rest) if link and not script and ends["</a"] > i else 0
            if inside_ and ends[inside_] <= i:  # never closed: only this line
                inside_ = ""
            if ends["</a"] <= i:
                link = 0
            parts.append("" if script else rest)
            v = " ".join(" ".join(parts).split()) if len(parts) > 2 else "".join(parts).strip()
            where[i] = where[i] or open_[-1]
        else:
            v, lc, links = s, len(s) if link else 0, link
            if not html:
                if not s:
                    after_blank = True
                elif after_blank:
                    boxes.append([0.0, 0.0, 0.0, 0.0, 0])
                    open_ = [len(boxes) - 1]
                    after_blank = False
            where[i] = open_[-1]
        show[i] = v
        if not v:
            page[i] = bool(s)
            continue
        low, is_page, wordss[i] = _look(v)
        lows[i] = low
        c = float(len(v))
        mass = _mass(v, low, wordss[i], is_page, repeated)
        lc = max(mass * c, float(lc))
        leaf[i] = (c, max(tags, 1), lc, links + mass)
        b = where[i]
        while b >= 0:
            box = boxes[b]
            box[0] += c
            box[1] += max(tags, 1)
            box[2] += lc
            box[3] += links + mass
            b = int(box[4])
    body_c, body_lc = boxes[0][0], boxes[0][2]
    if not html:
        body_c, body_lc = (sum(x[0] for x in boxes[1:]), sum(x[2] for x in boxes[1:])) if body_c == 0 else (body_c, body_lc)
    ctd = [density(*b[:4], body_c, body_lc) for b in boxes]
    sums = [0.0] * len(boxes)
    for i in range(n):
        if show[i]:
            sums[where[i]] += density(*leaf[i], body_c, body_lc)
    for k in range(1, len(boxes)):
        sums[int(boxes[k][4])] += ctd[k]
    main = max(range(len(boxes)), key=sums.__getitem__)
    bare = [relative_density(*b[:4], body_c, body_lc) for b in boxes]
    path, share, k = ctd[main], bare[main], main
    while k >= 0:
        path, share = min(path, ctd[k]), min(share, bare[k])
        k = int(boxes[k][4])
    inside = {main, 0}
    for k in range(1, len(boxes)):
        if int(boxes[k][4]) in inside and k != main and not html:
            inside.add(k)
    for i in range(n):
        if show[i] and not page[i]:
            out = html and where[i] not in inside and (ctd[where[i]] < path or boxes[where[i]][0] < 0.2 * body_c and prose_share(lows[i].split()) < 0.15)
            page[i] = out or leaf[i][2] > 0 and relative_density(*leaf[i], body_c, body_lc) * bare[where[i]] < 0.5 * share
    _sides(show, lows, page)
    return _kinds(show, lows, wordss, page)


def _sides(show: list[str], lows: list[str], page: list[bool]) -> None:
    """Side columns: their heading, and the titles, counters and share labels below it."""
    n = len(show)
    seen_text = False  # heading, dates or prose of the article so far
    for i in range(n):
        low = lows[i]
        if not low or (page[i] and low.strip(" :") not in _SIDE):
            continue
        if low.strip(" :") not in _SIDE:
            if low in _HEADS or _DATES.match(low) or len(low) > 150 or _AUTHORS.match(show[i]):
                seen_text = True
            continue
        page[i] = True
        j = i + 1
        if j < n and _BULLET.match(show[j]):
            while j < n and show[j] and _BULLET.match(show[j]) and len(show[j]) < 150:
                page[j] = True
                j += 1
            continue
        run = []
        while j < n and show[j] and not page[j] and _titleish(show[j], lows[j]) and prose_share(lows[j].split()) < 0.6 and not _ROW.search(show[j]) and not _BULLET.match(show[j]) and not _PAIR.match(show[j]):
            run.append(j)
            j += 1
        if run and not seen_text:  # the last of them may be the article's own title
            nxt = next((k for k in range(j, n) if show[k] and not page[k]), None)
            broke = j < n and not show[j]
            own = nxt is not None and not (broke and _titleish(show[nxt], lows[nxt])) and not (j < n and page[j] and _titleish(show[nxt], lows[nxt]))
            if own and len(run) > 1:
                run.pop()
        for k in run:
            page[k] = True


def _kinds(show: list[str], lows: list[str], wordss: list[list[str]], page: list[bool]) -> list[Line]:
    kinds = [""] * len(show)
    in_refs = False
    for i, (s, low) in enumerate(zip(show, lows)):
        if page[i]:
            kinds[i] = "page"
        elif not s:
            kinds[i] = "blank"
        elif low.strip(" .:") in _HEADS:
            kinds[i], in_refs = "heading", low.strip(" .:") in _REFHEADS
        elif _DATES.match(low) or (s[-1].isupper() or s[-2:-1].isupper()) and _AUTHORS.match(s):
            kinds[i] = "meta"
        elif _KEY.match(low):
            kinds[i] = "keywords"
        elif _CAPTION.match(low):
            kinds[i] = "caption"
        elif (in_refs or ";" in s or "doi" in s) and (_REFTAIL.search(s) or in_refs and _REF.match(s) and len(s) > 40):
            kinds[i] = "ref"
        else:
            words = wordss[i]
            share = prose_share(words)
            letters = sum(map(len, words))
            blanks, commas = s.count(" ") + 1, s.count(",")
            listed = commas * 4 > len(words) and not _END.search(s) or blanks < 0.7 * len(words)
            listed = listed or len(s) < 120 and sum(map(_VOWELS.isdisjoint, words)) > 0.12 * len(words) and sum(len(w) > 2 and _VOWELS.isdisjoint(w) for w in words) > 0.12 * len(words)
            if len(words) >= 5 and share >= 0.2 and letters >= 0.55 * len(s) and not listed and not (_BULLET.match(s) and not _END.search(s)):
                kinds[i] = "prose"
            else:
                kinds[i] = "list"
    # lines that begin large and end in a page number, one below another, are a table of contents
    paged = [i for i, s in enumerate(show) if kinds[i] in ("list", "prose") and s[-1].isdigit() and (s[0].isupper() or _BULLET.match(s)) and _PAGED.search(s)]
    for a, b in zip(paged, paged[1:]):
        if all(kinds[k] in ("blank", "page") for k in range(a + 1, b)):
            kinds[a] = kinds[b] = "list"
    # a hard-wrapped line with few function words goes with the prose before and after it
    last, joined = "", 0
    for i, s in enumerate(show):
        if kinds[i] == "page":
            continue
        joined = joined + 1 if kinds[i] == "list" else 0
        if kinds[i] == "list" and last == "prose" and joined < 3 and s.count(",") < 3 and not _NUMBERED.match(s) and not _END.search(prev) and not (_ROW.search(s) and not _PAGED.search(s)) and not _BULLET.match(s) and not _PAIR.match(s) and (s[:1].islower() or s[:1].isdigit() or s[:1] in "(%" or _END.search(s) or prev[-1:] == ","):
            kinds[i] = "prose"
        elif kinds[i] == "blank":
            last = ""
            continue
        last, prev = kinds[i], s
    for i in range(len(show) - 2, -1, -1):  # and the other way
        if kinds[i] == "list" and kinds[i + 1] == "prose" and show[i + 1][:1].islower() and not _ROW.search(show[i]) and not _BULLET.match(show[i]) and len(lows[i].split()) >= 4 and lows[i].count(",") < 4:
            kinds[i] = "prose"
    first = next((i for i, k in enumerate(kinds) if k not in ("blank", "page")), None)
    if first is not None and kinds[first] in ("list", "prose") and _titleish(show[first], lows[first]) and not _ROW.search(show[first]) and not _PAIR.match(show[first]):
        kinds[first] = "title"
    elif first is not None and kinds[first] == "heading":
        second = next((i for i in range(first + 1, len(kinds)) if kinds[i] not in ("blank", "page")), None)
        if second is not None and kinds[second] in ("list", "prose") and _titleish(show[second], lows[second]) and not _ROW.search(show[second]) and not _PAIR.match(show[second]):
            kinds[second] = "title"
    return [Line(i + 1, s, k) for i, (s, k) in enumerate(zip(show, kinds))]
