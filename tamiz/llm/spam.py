"""Problem 10: keyword-stuffed pages and link lists. An n-gram model of function words and word classes, trained on prose.

A token is itself if it is a function word or a sign, else its class: word, Name, CAPS, number, hashtag, part of a link, and "again" for a
content word that follows the same content word as before in the text (a repeated phrase). The trigram model is trained on the corpus'
prose: lines that end like a sentence, have the function words of one, repeat no phrase and hold no link or tag. Its counts are summed over
all documents; the classes bound them, not the corpus, and its smoothing does not depend on their size, so a token costs the same at
every scale. A document is flagged if its perplexity is abnormally high: more than ``deviations`` robust deviations above the median of
the documents that are prose by themselves (a fifth of their tokens in training lines), so spam does not move the bound.

The exact check that follows lets those of the flagged documents go that inform: contents and reference lists, and complete sentences
that naturally repeat a term. It reads the text in the pass that codes it, so no text is shuffled or read again.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, scan
from .pages import FUNCTION

_RUN = re.compile(r"([^\w\s/])\1+|\n\s*\n")
_TOKEN = re.compile(r"https?://\S+|www\.\S+|#\w+|\d[\d.,]*|[^\W\d_]+|\n|[^\w\s]")
_LINK = re.compile(r"https?://\S+|www\.\S+")
_PART = re.compile(r"[^/.:?&=#_-]+")
_REFERENCE = re.compile(r"(?:19|20)\d\d\s?;\s?\d+")
SIGNS = ".,;:()[]-|/>¿?¡!\"»•*%+=&_<"
# the code of a class is its place: line, again, word, Name, CAPS, number, link, hashtag, other sign, the signs, the function words
_BASE = 0x100
NAMES = ["L", "R", "W", "C", "A", "N", "U", "H", "S", *SIGNS, *sorted(FUNCTION)]
CODE = {c: chr(_BASE + i) for i, c in enumerate(NAMES)}
_L, _R, _W, _C, _A, _N, _U, _H, _S = (CODE[c] for c in "LRWCANUHS")
_STOP = CODE["."]
LEAST_SPREAD = 0.25  # bits; in a corpus of like documents any other would be far from the median
_UNLIKE = frozenset((_R, _U, _H))
_FUNCTION = re.compile(f"[{chr(_BASE + 9 + len(SIGNS))}-{chr(_BASE + len(NAMES))}]")
_CODES = {w: CODE[w] for w in FUNCTION} | {c: CODE[c] for c in SIGNS} | {"\n": _L}


def classes(text: str) -> str:
    """The classes of a text's tokens, a character each; a run of one sign is one token, a link one for each of its parts."""
    out, seen, last = [], set(), ""
    get = _CODES.get
    for t in _TOKEN.findall(_RUN.sub(lambda m: m.group(1) or "\n", text)):
        low = t.lower()
        code = get(low)
        if code is None:
            c = t[0]
            if c.isalpha():
                if low.startswith(("http", "www.")) and _LINK.match(low):
                    code = _U * len(_PART.findall(t))
                else:
                    pair = (last, low)
                    last = low
                    if pair in seen:
                        code = _R
                    else:
                        seen.add(pair)
                        code = _W if c.islower() else _A if len(t) > 2 and t.isupper() else _C
            else:
                code = _N if c.isdigit() else _H if c == "#" and len(t) > 1 else _S
        out.append(code)
    return "".join(out)


def training(seq: str) -> list[str]:
    """The lines of a text, as classes, that are prose: they end in a stop, repeat no phrase, hold no link and have a quarter of function words."""
    return [x for x in seq.split(_L) if len(x) >= 8 and x[-1] == _STOP and _UNLIKE.isdisjoint(x) and len(_FUNCTION.findall(x)) >= 0.25 * len(x)]


def ids(seq: str) -> np.ndarray:
    return np.frombuffer(seq.encode("utf-16-le"), dtype=np.uint16).astype(np.int64) - _BASE


class Model:
    """Trigram model of classes, interpolated with fixed weights; its size is bounded by the cube of the classes.

    A class that the prose lacks costs no more than some 21 bits, however many tokens it was trained on.
    """

    WEIGHTS = (0.6, 0.3, 0.1)  # of the trigrams, the pairs and the single classes
    RARE = 0.001  # the share of all classes alike in the single ones

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        v = self.v = len(NAMES) + 1
        order = np.argsort(keys)
        keys, n = np.asarray(keys, dtype=np.int64)[order], np.asarray(n, dtype=float)[order]
        a, b, c = keys // (v * v), keys // v % v, keys % v
        uni = np.bincount(c, n, v)
        p1 = (1 - self.RARE) * uni / max(uni.sum(), 1) + self.RARE / v
        two = np.bincount(b * v + c, n, v * v).reshape(v, v)
        seen = two.sum(axis=1, keepdims=True)
        w3, w2, w1 = self.WEIGHTS
        self.p2 = np.where(seen > 0, (w2 * two / np.maximum(seen, 1) + w1 * p1) / (w2 + w1), p1)
        self.keys, self.n, self.w3 = keys, n, w3
        self.before = np.bincount(a * v + b, n, v * v).reshape(v, v)

    def bits(self, seqs: list[str]) -> list[float]:
        """Bits a token of each text; 0 for one without tokens."""
        v, out = self.v, []
        for seq in seqs:
            if not seq:
                out.append(0.0)
                continue
            x = np.concatenate(([0, 0], ids(seq)))
            a, b, c = x[:-2], x[1:-1], x[2:]
            k = (a * v + b) * v + c
            if len(self.keys):
                i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
                n = np.where(self.keys[i] == k, self.n[i], 0.0)
            else:
                n = np.zeros(len(k))
            had = self.before[a, b]
            p = np.where(had > 0, self.w3 * n / np.maximum(had, 1) + (1 - self.w3) * self.p2[b, c], self.p2[b, c])
            out.append(round(float(-np.log2(p).mean()), 4))
        return out


_WORD = re.compile(r"[^\W\d_]+")
_CONTENTS = re.compile(r"\S.*[\s.]\d{1,4}$")
_BETWEEN = re.compile(r"(?<=[.!?])[\"”»)]*\s+")


def informs(text: str) -> bool:
    """Whether lines of contents or references, or complete sentences, make up most of a text's words.

    Sentences count only in a text that repeats its terms naturally: at most one sentence in eight holds a content word three times.
    """
    total = known = said = n = thrice = 0
    for line in text.split("\n"):
        line = line.strip()
        words = len(_WORD.findall(line))
        total += words
        linked = "#" in line or _LINK.search(line) is not None
        if _REFERENCE.search(line) or not linked and _CONTENTS.match(line):
            known += words
            continue
        for s in _BETWEEN.split(line):
            w = _WORD.findall(s.lower())
            if len(w) < 5:
                continue
            n += 1
            inside = Counter(x for x in w if x not in FUNCTION and len(x) > 2)
            thrice += max(inside.values(), default=0) > 2
            if s[-1:] in ".!?" and not linked and len(w) - sum(x not in FUNCTION for x in w) >= 0.15 * len(w):
                said += len(w)
    return 2 * known > total or 2 * (known + said) > total and 8 * thrice <= n


def _coded(df: DataFrame, key: str, text: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    return cut(scan(df.where(F.length(F.trim(text)) > 0).select(key, text), f"{key} {kind}, seq string, informs boolean", lambda it: ((k, classes(t), informs(t)) for k, t in it)))


def scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bits, centre, spread): bits a token under the prose model, and the median and robust deviation of the documents that are prose.

    Prose are the documents with a fifth of their tokens in training lines, all documents if there are none. Null and blank texts are
    left out. The model's counts are summed over all documents and sent to every task: at most one number for each three classes.
    """
    return _scored(_coded(df, key, text), key).drop("informs")


def _scored(coded: DataFrame, key: str) -> DataFrame:
    kind = coded.schema[key].dataType.simpleString()
    v = len(NAMES) + 1

    def count(it):
        n: Counter = Counter()
        held: list[np.ndarray] = []

        def add():
            if held:
                ks, cs = np.unique(np.concatenate(held), return_counts=True)
                n.update(dict(zip(ks.tolist(), cs.tolist())))
                held.clear()

        for (seq,) in it:
            for part in training(seq):
                x = np.concatenate(([0, 0], ids(part)))
                held.append((x[:-2] * v + x[1:-1]) * v + x[2:])
            if len(held) > 20_000:
                add()
        add()
        yield from n.items()

    # at most len(NAMES) ** 3 rows of 16 bytes, as Arrow columns
    counts = scan(coded.select("seq"), "k bigint, n bigint", count).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    model = Model(counts["k"].to_numpy(), counts["n"].to_numpy())

    def score(it):
        for k, seq, known in it:
            yield k, known, model.bits([seq])[0], 5 * sum(len(x) + 1 for x in training(seq)) >= len(seq) + 1

    scored = cut(scan(coded, f"{key} {kind}, informs boolean, bits double, prose boolean", score))
    middle = lambda x: F.percentile_approx(x, 0.5, 10000)
    some = scored.where("prose")
    some = scored if some.isEmpty() else some
    centre = some.agg(middle(F.col("bits")).alias("centre"))  # one row
    spread = some.join(F.broadcast(centre)).groupBy("centre").agg(F.greatest(middle(F.abs(F.col("bits") - F.col("centre"))) * 1.4826, F.lit(LEAST_SPREAD)).alias("spread"))  # one row
    return scored.drop("prose").join(F.broadcast(spread))


def spam(df: DataFrame, key: str = "doc_id", text: str = "text", deviations: float = 7.0) -> DataFrame:
    """(key, bits) of the documents with abnormally high perplexity that do not inform (``informs``).

    Repeated rows give repeated rows; an empty table gives an empty result.
    """
    return _scored(_coded(df, key, text), key).where((F.col("bits") > F.col("centre") + deviations * F.col("spread")) & ~F.col("informs")).select(key, "bits")
