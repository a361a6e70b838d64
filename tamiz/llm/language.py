"""Problem 7: missing or wrong language labels. Rank-order n-gram profiles and the out-of-place distance.

Profiles: prose lines of a bounded sample of texts (about ``SAMPLE`` texts with the least hashes of their keys) are labelled by their function
words (``lexicon``), and each language's ``PROFILE`` most frequent n-grams (1 to 4 letters of words with a blank on either side) are
ranked. Texts: the n-grams of each prose line are ranked the same way; the distance to a language sums how far each n-gram is out of
place, up to the profile's size for one that it lacks. A short line shares the evidence of its neighbours, and a line leaves the
text's language only by a margin. A text's language is that of most words of its prose; the confidence is the lead over the next.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lexicon as X
from .common import cut, scan, unit
from .pages import page_lines
from .quality import shares

SAMPLE = 1_200  # texts
PROFILE = 500
_LINES = 2_000  # lines ranked at once, whatever the length of a text
UNKNOWN = "und"
LEAST_LINES = 12  # labelled lines without which a language has no profile
_WORD = re.compile(r"[^\W\d_]+")
_SETS = {lang: frozenset(ws.split()) for lang, ws in X.FUNCTION_WORDS.items()}


def grams(token: str) -> list[str]:
    """The n-grams of 1 to 4 characters of the words in a token, each with a blank on either side."""
    out = []
    for word in _WORD.findall(token):
        w = f" {word} "
        out += [w[i:i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if n > 1 or w[i] != " "]
    return out


def by_function_words(words: list[str]) -> str | None:
    """The language whose function words a line has most, if it leads by a fifth; None if unclear."""
    n = sorted(((sum(w in s for w in words), lang) for lang, s in _SETS.items()), reverse=True)
    return n[0][1] if n[0][0] >= 5 and n[0][0] >= 1.2 * n[1][0] else None


def prose(text: str) -> list[tuple[int, list[str], int, bool]]:
    """(line number, words, blank-separated words, goes on) of a text's prose lines; none for a text that is not prose (problem 4)."""
    lines = page_lines(text)
    p, loose = shares(lines)
    if loose > p:
        return []
    return [(x.no, x.text.lower().split(), x.text.count(" ") + 1, x.text[-1] not in ".!?:") for x in lines if x.kind == "prose"]


def labelled(texts) -> tuple[Counter, Counter]:
    """Counts of (language, n-gram) and of lines of the texts' lines that have a clear language."""
    counts: Counter = Counter()
    lines: Counter = Counter()
    for t in texts:
        for _, raw, n, _ in prose(t):
            words = _WORD.findall(" ".join(raw))
            lang = by_function_words(words) if n >= 8 else None
            if lang:
                lines[lang] += 1
                counts.update((lang, g) for w in words for g in grams(w))
    return counts, lines


def profiles_of(counts: dict[tuple[str, str], int], lines: dict[str, int]) -> dict[str, list[str]]:
    """Language profiles, most frequent n-gram first, of the languages with at least LEAST_LINES lines."""
    out: dict[str, list[str]] = {}
    for (lang, g), _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if lines[lang] >= LEAST_LINES and len(out.setdefault(lang, [])) < PROFILE:
            out[lang].append(g)
    return dict(sorted(out.items()))


class _Ids(dict):
    """Token to the 16-bit numbers of its n-grams that a profile holds, packed."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.find = index.get

    def __missing__(self, token: str) -> bytes:
        out = self[token] = np.array([i for i in map(self.find, grams(token)) if i is not None], dtype=np.uint16).tobytes()
        return out


class Profiles:
    """Out-of-place distances of many lines at once. N-grams that no profile holds count the same for each language and are left out."""

    def __init__(self, profiles: dict[str, list[str]]):
        self.langs = sorted(profiles)
        self.index = {g: i for i, g in enumerate(sorted({g for p in profiles.values() for g in p}))}
        self.ranks = np.full((len(self.index), len(self.langs)), PROFILE, dtype=np.float32)
        for k, lang in enumerate(self.langs):
            for r, g in enumerate(profiles[lang]):
                self.ranks[self.index[g], k] = r
        self.known = _Ids(self.index)

    def distances(self, lines: list[list[str]]) -> np.ndarray:
        """A row for each line: the mean distance of its n-grams to each language, from 0 to 1."""
        return np.vstack([self._block(lines[i:i + _LINES]) for i in range(0, len(lines), _LINES)]) if lines else np.ones((0, len(self.langs)), dtype=np.float32)

    def _block(self, lines: list[list[str]]) -> np.ndarray:
        if len(self.known) > 200_000:
            self.known.clear()
        get = self.known.__getitem__
        packed = [b"".join(map(get, words)) for words in lines]
        flat = np.frombuffer(b"".join(packed), dtype=np.uint16)
        out = np.full((len(lines), len(self.langs)), 1.0, dtype=np.float32)
        if not len(flat):
            return out
        v = len(self.index)
        at = np.repeat(np.arange(0, len(lines) * v, v, dtype=np.int64), [len(p) // 2 for p in packed])
        at += flat
        dense = np.bincount(at, minlength=len(lines) * v)
        key = np.flatnonzero(dense)
        line, gram = (key // v).astype(np.uint16), key % v
        order = np.argsort((1 << 15) - np.minimum(dense[key], 1 << 15).astype(np.uint16), kind="stable")  # 16-bit keys sort by radix
        order = order[np.argsort(line[order], kind="stable")]
        line, gram = line[order].astype(np.int64), gram[order]
        start = np.flatnonzero(np.diff(line, prepend=-1))
        size = np.diff(np.append(start, len(line)))
        # an n-gram's place in the line, stretched to the profile's length
        place = (np.arange(len(line)) - np.repeat(start, size)) * (PROFILE / np.maximum(np.repeat(size, size), 60))
        ranks = self.ranks[gram]
        away = np.where(ranks >= PROFILE, PROFILE, np.minimum(np.abs(ranks - place[:, None]), PROFILE))
        out[line[start]] = np.add.reduceat(away, start, axis=0) / size[:, None] / PROFILE
        return out


def judge(numbered: list[tuple[int, list[str], int, bool]], dist: np.ndarray, langs: list[str], margin: float, least: int) -> tuple[str, float, list[tuple[int, str, float]]]:
    """(language, confidence, foreign lines as (line number, language, confidence)) of a text with prose lines."""
    words = np.array([x[2] for x in numbered], dtype=np.float32)
    own = dist
    joined = [i for i in range(len(numbered) - 1) if numbered[i][3] and numbered[i + 1][0] == numbered[i][0] + 1 and max(words[i], words[i + 1]) < 25]
    if joined:  # the lines before and after it in its paragraph speak for a short line
        i = np.array(joined)
        weight, total = words.copy(), dist * words[:, None]
        for a, b in ((i, i + 1), (i + 1, i)):
            total[a] += 0.5 * dist[b] * words[b, None]
            weight[a] += 0.5 * words[b]
        own = total / np.maximum(weight, 1)[:, None]
    best = own.argmin(axis=1)
    votes = np.bincount(best, words, len(langs))
    main = int(votes.argmax())
    lead = np.sort(own, axis=1)
    share = float(votes[main] / max(votes.sum(), 1))
    foreign = []
    for i, (no, _, n, _) in enumerate(numbered):
        if best[i] != main and n >= least and own[i, main] - own[i, best[i]] > margin:
            foreign.append((no, langs[best[i]], round(float(lead[i, 1] - lead[i, 0]), 4)))
    gap = float(((lead[:, 1] - lead[:, 0]) * words).sum() / max(words.sum(), 1)) if len(langs) > 1 else 1.0
    return langs[main], round(min(1.0, share * (0.5 + min(0.5, gap * 5))), 4), foreign


def fit(df: DataFrame, key: str = "task_id", text: str = "text", sample: int = SAMPLE) -> dict[str, list[str]]:
    """Profiles from about ``sample`` texts, those whose keys have the least hashes: a bounded sample, the same at each run.

    The hashes' bound follows from the number of rows. Texts are read where they are; only PROFILE n-grams of each language are sent.
    """
    share = sample / max(df.count(), 1)
    rows = df.where((unit(F.col(key), 7) < share) & (F.length(F.trim(text)) > 0)).select(text)

    def count(it):
        counts, lines = labelled(t for (t,) in it)
        yield from ((lang, g, n) for (lang, g), n in counts.items())
        yield from ((lang, None, n) for lang, n in lines.items())

    total = cut(scan(rows, "lang string, gram string, n bigint", count).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    lines = {r.lang: r.n for r in total.where("gram is null").collect()}
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))  # n-grams of the sample's words
    top = total.where("gram is not null").withColumn("r", rank).where(F.col("r") <= PROFILE).collect()
    return profiles_of({(r.lang, r.gram): r.n for r in top}, lines)


def languages(df: DataFrame, profiles: dict[str, list[str]], key: str = "task_id", keep: tuple[str, ...] = ("pid",), text: str = "text", margin: float = 0.01, least: int = 8) -> DataFrame:
    """(key, keep..., lang, confidence, foreign) of each text; foreign holds (line_no, lang, confidence) of its foreign lines.

    Texts that are not prose, and all texts if there is no profile, have the language UNKNOWN with confidence 0. Null and blank texts
    give no row.
    """
    kind = df.schema[key].dataType.simpleString()
    kept = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)

    def rows(it):
        p = Profiles(profiles)
        held: list = []
        n = 0

        def flush():
            dist = p.distances([x[1] for _, lines in held for x in lines])
            at = 0
            for row, lines in held:
                lang, sure, foreign = judge(lines, dist[at:at + len(lines)], p.langs, margin, least)
                at += len(lines)
                yield (*row, lang, sure, [{"line_no": a, "lang": b, "confidence": c} for a, b, c in foreign])
            held.clear()

        for *row, t in it:
            lines = prose(t) if p.langs else []
            if not lines:
                yield (*row, UNKNOWN, 0.0, [])
            else:
                held.append((row, lines))
                n += len(lines)
                if n > 1_500:
                    yield from flush()
                    n = 0
        if held:
            yield from flush()

    return scan(df.where(F.length(F.trim(text)) > 0).select(key, *keep, text), f"{key} {kind}{kept}, lang string, confidence double, foreign array<struct<line_no:int,lang:string,confidence:double>>", rows)


def label_code(label: Column) -> Column:
    """The code of the language that a label names, from codes with or without region, or names; null if it names none."""
    names = F.create_map(*(F.lit(x) for lang, ns in X.LANGUAGE_NAMES.items() for n in ns.split() for x in (n, lang)))
    return F.try_element_at(names, F.regexp_extract(F.lower(F.trim(label)), r"^([\p{L}]+)", 1))


def wrong_labels(spoken: DataFrame, candidates: DataFrame, triage: DataFrame, key: str = "task_id") -> DataFrame:
    """(campo, key, line_no) from ``languages``: foreign lines ("segmento"), and labels that do not name the text's language.

    Labels of a pid that differ are wrong if one is. Pids without candidate or without an answered triage row are not judged.
    """
    s = spoken.where(F.col("lang") != UNKNOWN).select(key, "lang", "pid", F.size("foreign").alias("n"), "foreign")
    lines = s.select(F.lit("segmento").alias("campo"), key, F.explode("foreign.line_no").alias("line_no"))
    labels = candidates.where(F.col("pid").isNotNull()).select("pid", F.coalesce(label_code(F.col("idioma")), F.lit("?")).alias("code")).distinct()
    texts = s.where(F.col("pid").isNotNull()).select(key, "pid", "lang", F.when(F.col("n") > 0, "mixto").otherwise(F.col("lang")).alias("body"))
    one = texts.join(labels, "pid").where("code <> lang").select(F.lit("idioma").alias("campo"), key, F.lit(0).alias("line_no"))
    said = F.lower(F.trim("idioma_cuerpo"))
    answers = triage.where(F.col("pid").isNotNull() & (F.coalesce(F.trim("error"), F.lit("")) == "")).select("pid", F.when(said == "mixto", "mixto").otherwise(F.coalesce(label_code(said), F.lit("?"))).alias("code")).distinct()
    two = texts.join(answers, "pid").where("code <> body").select(F.lit("idioma_cuerpo").alias("campo"), key, F.lit(0).alias("line_no"))
    return lines.unionByName(one).unionByName(two).distinct()
