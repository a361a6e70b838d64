"""Text functions as Spark columns: code-generated in the JVM, null in, null out unless said otherwise.

White space is Unicode white space including the separators \\x1c to \\x1f; positions count code points.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space as a character class that Java and RE2 read alike
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}]"
NOT_WS = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}]"


def fold_pairs() -> tuple[str, str]:
    """Characters that fold to one ASCII character by compatibility decomposition without marks, and those characters; made by rule."""
    a, b = [], []
    for c in range(0x80, 0x2200):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))
        if len(base) == 1 and base.isascii() and base != chr(c) and base not in "'\\":
            a.append(chr(c))
            b.append(base)
    return "".join(a), "".join(b)


FOLD_FROM, FOLD_TO = fold_pairs()


def composed() -> tuple[list[tuple[str, str]], str, str]:
    """Pairs of letter and mark with the one letter they compose to, and single characters with their canonical form; made by rule."""
    pairs, a, b = [], [], []
    for c in range(0xA0, 0x2200):
        d = unicodedata.normalize("NFC", chr(c))
        if d != chr(c) and len(d) == 1:
            a.append(chr(c))
            b.append(d)
        parts = unicodedata.decomposition(chr(c)).split()
        if d == chr(c) and len(parts) == 2 and not parts[0].startswith("<"):
            pair = "".join(chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", pair) == chr(c):
                pairs.append((pair, chr(c)))
    pairs.sort(key=lambda x: len(unicodedata.normalize("NFD", x[1])))  # a letter with two marks takes the first one first
    return pairs, "".join(a), "".join(b)


COMPOSED, CANON_FROM, CANON_TO = composed()


def compose(x: Column) -> Column:
    """Unicode NFC of letters below U+2200, as an expression: marks after their letter are composed with it; only texts with marks cost.

    Marks that stand in another than their canonical order stay so; ``udfs.nfc`` is exact for all of Unicode.
    """
    pairs = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(c).alias("c")) for p, c in COMPOSED))
    joined = F.aggregate(pairs, x, lambda t, y: F.replace(t, y.p, y.c))
    return F.when(x.rlike(rf"[\p{{Mn}}{CANON_FROM}]"), F.translate(joined, CANON_FROM, CANON_TO)).otherwise(x)


def let(value: Column, f) -> Column:
    """f of a column that is computed once a row, however often f names it; conditional branches would compute it again each."""
    return F.transform(F.array(value), f)[0]


def _beyond_ascii(x: Column, f) -> Column:
    """f of a text that has more than ASCII, the text itself otherwise: translation looks each character up, most texts need none."""
    return F.when(x.rlike(r"[^\x00-\x7f]"), f(x)).otherwise(x)


def fold(x: Column) -> Column:
    """Lower case without accents; null gives the empty string."""
    return F.lower(_beyond_ascii(F.coalesce(x, F.lit("")), lambda s: F.regexp_replace(F.translate(s, FOLD_FROM, FOLD_TO), r"\p{M}+", "")))


def canon(x: Column) -> Column:
    """Upper case without accents, stripped; ordinals stay (canonical decomposition). Null gives the empty string."""
    kept = "".join(c for c in FOLD_FROM if unicodedata.normalize("NFD", c) != c)
    bare = "".join(FOLD_TO[FOLD_FROM.index(c)] for c in kept)
    return F.upper(strip(_beyond_ascii(F.coalesce(x, F.lit("")), lambda s: F.regexp_replace(F.translate(s, kept, bare), r"\p{Mn}+", ""))))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{WS}+|{WS}+\z", "")


def unix_lines(x: Column) -> Column:
    """CR LF and CR as LF."""
    return F.regexp_replace(x, r"\r\n?", "\n")


def lines(x: Column) -> Column:
    """The lines of a text cut at LF, without the empty one after a last LF; the empty text has none."""
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(x, r"\n\z", ""), "\n"))


def split_lines(x: Column) -> Column:
    """The lines of a text cut at every Unicode line boundary, without the empty one after a last boundary."""
    return lines(F.regexp_replace(x, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", "\n"))


def word_count(x: Column) -> Column:
    return F.regexp_count(x, F.lit(f"{NOT_WS}+")).cast("bigint")


def smart_trim(x: Column, most: int = 650) -> Column:
    """White space squeezed; a longer text is cut, after its last full stop if that lies in the second half, else with an ellipsis."""


    def trimmed(flat: Column) -> Column:
        head = F.substring(flat, 1, most)
        back = F.locate(" .", F.reverse(head))  # the last full stop with a blank after it
        stop = F.length(head) - back  # characters up to the stop
        cut = F.when((back > 0) & (stop - 1 > most * 0.5), F.substring(head, F.lit(1), stop)).otherwise(F.concat(F.regexp_replace(head, r"[ ,;:]+\z", ""), F.lit("…")))
        return F.when(F.length(flat) <= most, flat).otherwise(cut)

    return let(strip(F.regexp_replace(x, f"{WS}+", " ")), trimmed)


def quote(x: Column) -> Column:
    """A pattern that matches the text of a column literally."""
    return F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def flexible_find(text: Column, fragment: Column) -> Column:
    """Place from 0 of a fragment in a text: exact, else with any white space between its words (two at least), else -1.

    Fragments below four characters and nulls give -1.
    """
    exact = F.instr(text, fragment) - 1
    words = F.filter(F.split(strip(fragment), f"{WS}+"), lambda w: w != "")
    loose = let(words, lambda ws: F.when(F.size(ws) >= 2, let(F.split(text, F.array_join(F.transform(ws, quote), f"{WS}+"), 2), lambda p: F.when(F.size(p) > 1, F.length(p[0])).otherwise(-1))).otherwise(-1))
    return F.coalesce(F.when(F.length(fragment) < 4, F.lit(-1)).when(exact >= 0, exact).otherwise(loose), F.lit(-1)).cast("int")
