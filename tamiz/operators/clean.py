"""Rule-based trimming of a raw text to its narrative: line cleanup, boundaries by headings, inner cleanup, and cuts by fragments.

Everything is one projection of JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.text import WS, compose, flexible_find, fold, let, split_lines, strip, word_count


def site_noise(line: Column) -> Column:
    return strip(fold(line)).isin(*D.SITE_NOISE)


_CAPTION = rf"(?iu)^{D.CAPTIONS}{WS}*(?:n[°º.\s]|[0-9]|:)"
_ISSN = rf"(?iuU)\bissn\b|versi[oó]n{WS}+(?:impresa|on-?line)"
_NUMBERS = rf"^(?:[\p{{Nd}}.–-]|{WS})++\z"


def noise_kind(line: Column) -> Column:
    """'sitio', 'leyenda', 'issn' or 'numeros' for the first test that a line meets, else null."""
    return let(strip(line), _noise_kind)


def _noise_kind(s: Column) -> Column:
    # lengths first: site labels are short, and folding a paragraph to compare it with them is not
    short = F.length(s) <= 2 * max(map(len, D.SITE_NOISE))
    return (
        F.when(s == "", None).when(short & site_noise(s), "sitio").when(s.rlike(_CAPTION), "leyenda")
        .when((F.length(s) < 120) & s.rlike(_ISSN), "issn").when(s.rlike(_NUMBERS), "numeros")
    )


def line_cleanup(text: Column) -> Column:
    """The text without noise lines; blank lines become empty ones and stay. Null stays null."""
    both = F.transform(split_lines(text), lambda l: F.struct(l.alias("l"), strip(l).alias("s")))
    kept = F.transform(F.filter(both, lambda x: _noise_kind(x.s).isNull()), lambda x: F.when(x.s == "", "").otherwise(x.l))
    return F.when(text.isNotNull(), F.array_join(kept, "\n"))


def strip_urls(x: Column) -> Column:
    return F.regexp_replace(x, r"https?://[^\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}]+", "")


def strip_citations(x: Column) -> Column:
    """Without link marks, inline references to figures, and numbers in parentheses or brackets."""
    x = F.regexp_replace(x, rf"(?i)\[{WS}*links?{WS}*\]", "")
    x = F.regexp_replace(x, rf"(?iu)\({WS}*{D.CAPTIONS}[^)]{{0,30}}\)", "")
    x = F.regexp_replace(x, rf"\({WS}*\p{{Nd}}+(?:{WS}*[,–y-]{WS}*\p{{Nd}}+)*{WS}*\)", "")
    return F.regexp_replace(x, rf"\[{WS}*\p{{Nd}}+(?:{WS}*[,–-]{WS}*\p{{Nd}}+)*{WS}*\]", "")


def squeeze(x: Column) -> Column:
    """Runs of blanks to one, of line ends to two, no white space before , . ; : and none at the ends."""
    x = F.regexp_replace(F.regexp_replace(x, "[ \t]{2,}", " "), "\n{3,}", "\n\n")
    return strip(F.regexp_replace(x, rf"{WS}+([,.;:])", "$1"))


def inner_cleanup(x: Column) -> Column:
    x = F.regexp_replace(compose(x), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    return squeeze(strip_citations(strip_urls(x)))


def _first_of(text: Column, patterns: tuple[tuple[str, str], ...], shift: Column | int) -> Column:
    """(place, label) of the first match of the patterns at line starts of ``text``; null if none. Leading white space belongs to a match."""
    written = [(label, pattern.replace("{w}", WS)) for label, pattern in patterns]
    any_ = rf"(?iuU)\n{WS}*(?:{'|'.join(f'(?:{p})' for _, p in written)})"
    # one search for all: the leftmost match wins, and at one place the first pattern; its label is read off the short match


    def name_of(match: Column) -> Column:
        label = F.lit(written[-1][0])
        for name, pattern in reversed(written[:-1]):
            label = F.when(match.rlike(rf"(?iuU)^\n{WS}*(?:{pattern})"), name).otherwise(label)
        return label

    def place(parts: Column) -> Column:
        match = F.substring(text, F.length(parts[0]) + 1, F.length(text) - F.length(parts[0]) - F.length(parts[1]))
        return F.when(F.size(parts) > 1, F.struct((F.length(parts[0]) + shift).alias("pos"), let(match, name_of).alias("label")))

    return let(F.split(text, any_, 2), place)


def boundaries(df: DataFrame, text: str = "cleaned") -> DataFrame:
    """df with start, start_label, end and end_label of the narrative in a line-cleaned text; places count code points from 0.

    A heading of an article's type before an introduction, and an English abstract between start and introduction, move the start to
    the introduction. Without start heading: 0 and 'sin_inicio'; without end heading: the length and 'fin_archivo'. Null texts: nulls.
    """
    led = F.concat(F.lit("\n"), F.col(text))
    d = df.withColumn("_s", _first_of(led, D.STARTS, 0)).withColumn("_i", _first_of(led, (("introduccion", D.INTRODUCTION),), 0).pos).withColumn("_a", _first_of(led, (("abstract", D.ENGLISH_ABSTRACT),), 0).pos)
    start, label = F.coalesce(F.col("_s.pos"), F.lit(0)), F.coalesce(F.col("_s.label"), F.lit("sin_inicio"))
    moved = F.col("_i").isNotNull() & (label.isin(*D.TYPE_STARTS) & (start < F.col("_i")) | (F.col("_a") >= start) & (F.col("_a") < F.col("_i")))
    moved = F.coalesce(moved, F.lit(False))
    here = F.col(text).isNotNull()
    d = d.withColumn("start", F.when(here, F.when(moved, F.col("_i")).otherwise(start)).cast("int")).withColumn("start_label", F.when(here, F.when(moved, "introduccion").otherwise(label)))
    # the end is looked for from the character after the start, where a line start counts only after a line end
    rest = F.substring(F.col(text), F.col("start") + 2, F.length(text))
    d = d.withColumn("_e", _first_of(rest, D.ENDS, F.col("start") + 2))
    d = d.withColumn("end", F.when(here, F.coalesce(F.col("_e.pos"), F.length(text))).cast("int")).withColumn("end_label", F.when(here, F.coalesce(F.col("_e.label"), F.lit("fin_archivo"))))
    return d.drop("_s", "_i", "_a", "_e")


def core(df: DataFrame, text: str = "text") -> DataFrame:
    """df with cleaned (line cleanup), the boundaries, and core, the inner cleanup of the slice between them."""
    d = boundaries(df.withColumn("cleaned", line_cleanup(F.col(text))))
    return d.withColumn("core", inner_cleanup(F.substring(F.col("cleaned"), F.col("start") + 1, F.col("end") - F.col("start"))))


def safeguarded(kept: Column, cut: Column, least_words: int = 150, least_share: float = 0.3) -> Column:
    """The cut, unless it has too few words or too small a share of the text: then the text, stripped."""
    poor = (word_count(cut) < least_words) | (F.length(cut) < least_share * F.length(kept))
    return F.when(cut.isNull() | poor, strip(kept)).otherwise(cut)


def apply_cut(text: Column, head: Column, tail: Column, least_words: int = 150) -> Column:
    """The text from the fragment ``head`` to before the fragment ``tail``, where they are found, under the safeguard."""
    a = flexible_find(text, head)
    start = F.when(a > 0, a).otherwise(0)
    b = flexible_find(text, tail)
    end = F.when(b > start, b).otherwise(F.length(text))
    return safeguarded(text, strip(F.substring(text, start + 1, end - start)), least_words)


CUT = "inicio_basura boolean, frag_inicio_contenido string, fin_basura boolean, frag_inicio_basura_final string, tipo_basura string"


def apply_answer(text: Column, answer: Column, least_words: int = 150) -> Column:
    """A struct (text, at_start, at_end, kept) of a model's cut answer (a struct of CUT) applied to a text.

    A null answer leaves the text as it is, not stripped. A fragment counts only if its flag is true and it is found, the first one after
    the text's begin, the second after the first. ``kept`` tells that the safeguard kept the whole text.
    """
    at = lambda on, f: F.when(F.coalesce(on, F.lit(False)), flexible_find(text, strip(f))).otherwise(-1)

    def sliced(a: Column, b: Column) -> Column:
        start = F.when(a > 0, a).otherwise(0)
        end = F.when(b > start, b).otherwise(F.length(text))
        cut = strip(F.substring(text, start + 1, end - start))
        poor = (word_count(cut) < least_words) | (F.length(cut) < 0.3 * F.length(text))
        whole = F.struct(text.alias("text"), F.lit(False).alias("at_start"), F.lit(False).alias("at_end"), F.lit(False).alias("kept"))
        done = F.struct(F.when(poor, strip(text)).otherwise(cut).alias("text"), (a > 0).alias("at_start"), (b > start).alias("at_end"), poor.alias("kept"))
        return F.when(answer.isNull(), whole).otherwise(done)

    return let(at(answer.inicio_basura, answer.frag_inicio_contenido), lambda a: let(at(answer.fin_basura, answer.frag_inicio_basura_final), lambda b: sliced(a, b)))
