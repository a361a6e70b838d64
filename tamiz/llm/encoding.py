"""Problem 6: text garbled by a wrong character encoding. Noisy-channel decoding over byte lattices with corpus word frequencies.

1. One pass takes the words with characters beyond ASCII from every text: all of them are counted over the corpus (the word
   frequencies), and those that may be garbled are kept with their text's key.
2. Each different suspect word becomes a lattice for each channel (a code page it may have been read in, once or twice, instead of
   UTF-8 or Latin-1): its characters are turned back into bytes, a lost byte is a wildcard, and the bytes are read again into letters,
   with several letters where a byte was lost. A Viterbi search under letter-pair frequencies of the corpus finds the best path; the
   corpus' words that a lattice with lost bytes holds are found in a join by the letters that are left.
3. Paths meet the corpus' word frequencies in a join. The best reading by path cost and frequency wins. A reading of UTF-8 or of a
   lost letter is accepted if its letter pairs are by ``MARGIN`` likelier than those of the word as it stands. A one-byte reading is accepted if its word is far more frequent than the garbled one, or
   occurs in records without suspect words and is better spelt, however common the damage is; a word that the corpus lacks if all
   its restored letters' pairs occur, it has a plain vowel, its garbled signs are no letters in their place, and other words prove the channel.
4. Texts that hold an accepted word are affected; their words can be replaced by the readings.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, narrowed, scan

# Code pages in which bytes of the web are misread.
CHANNELS = ("cp1252", "cp437", "cp850", "mac_roman", "cp1251")
OLD_PAGES = ("cp850", "cp437", "mac_roman")
ACCENTED = "áéíóúñüçãõâêôàèëïîùûäöòìÁÉÍÓÚÑÜÇÃÕÂÊÔÀÈËÏÎÙÛÄÖÒÌ"
# letters that are not suspect where the case of the word fits them
_USUAL = frozenset("áéíóúñüçãõâêôàèëïîùûœæ" + "ÁÉÍÓÚÑÜÇÃÕÂÊÔÀÉ")
_EDGE = "«»“”‘’–—…•·¿¡©®ºª°€\xa0"
_CLOSING = _EDGE.replace("¿", "").replace("¡", "")
_TOKEN = re.compile(r"[A-Za-z]*[^\x00-\x7f][^\x00-\x40\x5b-\x60\x7b-\x7f]*")
_RUN = re.compile(r"[^\x00-\x7f]+")
_LOST = "�"
_VOWELS = frozenset("aeiou")
MARGIN = 0.0  # nats a letter by which a reading has to be better spelt than the word as it stands


def words(text: str) -> list[str]:
    """Words of letters with at least one character beyond ASCII, composed; decomposed accents are no damage."""
    if "́" in text or "̃" in text or "̂" in text or "̀" in text or "̧" in text or "̈" in text:
        text = unicodedata.normalize("NFC", text)
    return _TOKEN.findall(text)


_seen: dict[str, bool] = {}


def suspect(word: str) -> bool:
    """Whether a word may be garbled: a character that is no usual letter, or a capital with an accent after a small letter."""
    hit = _seen.get(word)
    if hit is None:
        w = word.lstrip(_EDGE).rstrip(_CLOSING)
        odd = [i for i, c in enumerate(w) if ord(c) > 127 and not (c in _USUAL and (c.islower() or not any(x.islower() for x in w[:i]) and not w[i + 1:i + 2].islower() or i == 0 and w[1:2].isascii()))]
        hit = bool(odd) and (len(w) > 1 or word != w) and any(c.isascii() for c in word) or len(odd) > 1
        if len(_seen) > 200_000:
            _seen.clear()
        _seen[word] = hit
    return hit


def _bytes(run: str, channel: str) -> list[int | None] | None:
    """The bytes of a run in a code page, None for a lost one; nothing if a character has no byte there."""
    out: list[int | None] = []
    for c in run:
        if c == _LOST:
            out.append(None)
        elif channel == "cp1252" and ord(c) < 256:
            out.append(ord(c))
        else:
            b = c.encode(channel, "ignore")
            if not b:
                return None
            out.append(b[0])
    return out


def _utf8(bs: list[int | None]) -> list[str] | None:
    """The letters that a byte lattice can be as UTF-8, a string of choices for each; nothing if it is not valid UTF-8."""
    out, i = [], 0
    while i < len(bs):
        b = bs[i]
        two = bs[i + 1] if i + 1 < len(bs) else -1
        if b is not None and b < 0x80:
            out.append(chr(b))
            i += 1
        elif b is not None and 0xE2 <= b <= 0xE3 and i + 2 < len(bs) and all(x is None or 0x80 <= x < 0xC0 for x in bs[i + 1:i + 3]):
            out.append(chr((b & 15) << 12 | ((bs[i + 1] or 0x80) & 63) << 6 | (bs[i + 2] or 0x80) & 63))
            i += 3
        elif (b is None or 0xC2 <= b <= 0xCD) and (two is None or two is not None and 0x80 <= two < 0xC0) and two != -1 and not (b is None and two is None):
            if b is not None and two is not None:
                out.append(chr((b & 31) << 6 | two & 63))
            else:
                fits = [c for c in ACCENTED if (e := c.encode()) and (b is None or e[0] == b) and (two is None or e[1] == two)]
                if not fits:
                    return None
                out.append("".join(fits))
            i += 2
        elif b is not None and b in (0xC3, 0xC2) and (two == -1 or two in (0x20, 0xA0)):  # the second byte was a blank that is gone
            out.append("à" if b == 0xC3 else "")
            i += 1 if two == -1 else 2
        else:
            return None
    return out


def lattices(word: str) -> list[tuple[str, list[str]]]:
    """(channel, choices for each letter) of the readings that change a word."""
    out = []
    if _LOST in word:
        choice = [ACCENTED if c == _LOST else c for c in word]
        out.append(("lost", choice))
        if _LOST * 2 in word:
            out.append(("lost", [ACCENTED if c == "\0" else c for c in word.replace(_LOST * 2, "\0") if c != _LOST]))
    runs = list(_RUN.finditer(word))
    for channel in CHANNELS:
        for depth in (1, 2):
            choice, at, fits = [], 0, True
            for m in runs:
                choice += word[at:m.start()]
                at = m.end()
                bs = _bytes(m.group(), channel)
                read = _utf8(bs) if bs is not None else None
                if depth == 2 and read is not None:
                    once = "".join(x if len(x) == 1 else _LOST for x in read)
                    bs = _bytes(once, channel if channel != "cp1251" else "cp1252")
                    read = _utf8(bs) if bs is not None and not once.isascii() else None
                if read is None:
                    fits = False
                    break
                choice += read
            if not fits:
                break
            choice += word[at:]
            out.append((f"{channel}/utf8/{depth}", [x for x in choice if x]))
        if channel != "cp1252":
            bs = _bytes(word, channel)
            if bs is not None and _LOST not in word:
                read = bytes(bs).decode("latin-1")
                if read != word and all(c.isalpha() or c in _EDGE for c in read if ord(c) > 127):
                    out.append((f"{channel}/latin1", list(read)))
    bs = _bytes(word, "cp1252")
    if bs is not None and _LOST not in word:
        for page in OLD_PAGES:  # the other way: an old code page read as Windows or Latin-1
            read = bytes(bs).decode(page, "replace")
            if read != word and all(c.isalpha() or c in _EDGE for c in read if ord(c) > 127):
                out.append((f"cp1252/{page}", list(read)))
    return out


def _near(choices: list[str], i: int) -> str:
    """The certain letter that gives a lost one its case: the next one, or the last."""
    return next((c for c in choices[i + 1:] if len(c) == 1 and c.isalpha()), next((c for c in reversed(choices) if len(c) == 1 and c.isalpha()), "a"))


def viterbi(choices: list[str], pairs: dict[str, float], floor: float) -> tuple[float, str]:
    """The best path through a lattice, as (cost in nats, word); letters have the case of the next certain one.

    The best path to each last letter is kept, which is exact under letter pairs, however many letters are lost. Ties go by letter.
    """
    paths = {"^": (0.0, "")}
    for i, options in enumerate(choices):
        near = _near(choices, i) if len(options) > 1 else ""
        step: dict[str, tuple[float, str]] = {}
        for last, (cost, w) in paths.items():
            for c in options:
                low = c.lower()
                new = (cost - pairs.get(last + low, floor) + (4 if near and c.isupper() != near.isupper() else 0), w + c)
                if low not in step or new < step[low]:
                    step[low] = new
        paths = step
    return min(paths.values())


def fitting(key: str, choices: list[str], pairs: dict[str, float], floor: float) -> tuple[float, str] | None:
    """The path of a lattice that is a word of the vocabulary, given in lower case: (cost, word in the lattice's case); nothing if none is."""
    if len(key) != len(choices):
        return None
    out = []
    for i, (c, options) in enumerate(zip(key, choices)):
        if len(options) > 1 and _near(choices, i).isupper():
            c = c.upper()
        elif len(options) == 1 and options.lower() == c:
            c = options
        if c not in options:
            return None
        out.append(c)
    low = "^" + key
    return -sum(pairs.get(a + b, floor) for a, b in zip(low, low[1:])), "".join(out)


def skeleton(word: str) -> str:
    """A word in lower case with a mark for each letter beyond ASCII."""
    return "".join(c if c.isascii() else _LOST for c in word.lower())


def _trim(choices: list[str]) -> tuple[int, int]:
    """Where a lattice begins and ends without quotes and dashes."""
    a, b = 0, len(choices)
    while a < b and len(choices[a]) == 1 and choices[a] in _EDGE:
        a += 1
    while b > a and len(choices[b - 1]) == 1 and choices[b - 1] in _EDGE:
        b -= 1
    return a, b


def _clearer(own: float, word: str, cost: float, reading: str) -> float:
    """By how many nats a letter a reading is better spelt than the word."""
    return own / max(len(word), 1) - cost / max(len(reading), 1)


def _accented(word: str) -> bool:
    return any(c in ACCENTED for c in word)


def evidence(texts: DataFrame) -> DataFrame:
    """From (tabla, clave, text): rows with tabla hold a suspect word of a text, rows without the count ``n`` of a lower-case word, ``whole`` of
    them in texts without suspect words."""

    def rows(it):
        n: Counter = Counter()
        whole: Counter = Counter()
        for tabla, clave, text in it:
            if text.isascii():
                continue
            found = words(text)
            odd = {w for w in found if suspect(w)}
            (n if odd else whole).update(found)
            for w in odd:
                yield tabla, clave, w, 0, 0
            if len(n) + len(whole) > 300_000:
                yield from lower(n, whole)
        yield from lower(n, whole)

    def lower(n: Counter, whole: Counter):
        out: dict[str, list[int]] = {}
        for k, counts in enumerate((n, whole)):
            for w, c in counts.items():
                out.setdefault(w.lower().strip(_EDGE), [0, 0])[k] += c
            counts.clear()
        return [(None, None, w, a + b, b) for w, (a, b) in out.items()]

    return scan(texts.where(F.col("text").isNotNull() & F.col("clave").isNotNull()).select("tabla", "clave", "text"), "tabla string, clave string, word string, n bigint, whole bigint", rows)


def readings(found: DataFrame, times: float = 4.0, seen: int = 3) -> DataFrame:
    """(word, reading, channel, freq) of the suspect words of ``evidence`` that are garbled, with the best reading of each."""
    vocabulary = found.where("tabla is null").groupBy("word").agg(F.sum("n").alias("freq"), F.sum("whole").alias("whole"))
    # letter pairs of the corpus' words with usual letters only: bounded by the alphabet
    usual = vocabulary.where(F.col("word").rlike(f"^[a-z{''.join(c for c in ACCENTED if c.islower())}]+$"))
    spelt = F.concat(F.lit("^"), F.col("word"))
    pairs = usual.select("freq", F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(spelt, i, 2))).alias("pair")).groupBy("pair").agg(F.sum("freq").alias("n")).collect()
    total = sum(r.n for r in pairs) or 1
    logs = {r.pair: math.log(r.n / total) for r in pairs}
    floor = math.log(0.1 / total)

    def spelling(word: str, other: str = "") -> tuple[float, bool]:
        """The cost of a word's letter pairs, and whether the corpus has all that another word lacks."""
        ps, rest = ([a + b for a, b in zip("^" + w, w)] for w in (word, other))
        return -sum(logs.get(p, floor) for p in ps), all(p in logs for p in ps if p not in rest)

    def rows(it):
        for (word,) in it:
            low = word.lower().strip(_EDGE)
            own = spelling(low)[0]
            signs = len(low) >= 5 and not _VOWELS.isdisjoint(low) and all(c.isascii() or c in _USUAL and c.islower() or not c.isalpha() or c.isupper() and word[:i][-1:].islower() for i, c in enumerate(word))
            for channel, choices in lattices(word):
                a, b = _trim(choices)
                wild = [low, channel, choices, skeleton("".join(c if len(c) == 1 else _LOST for c in choices[a:b]))] if any(len(c) > 1 for c in choices) else [low, channel, None, None]
                cost, reading = viterbi(choices, logs, floor)
                reading = unicodedata.normalize("NFC", reading)  # a combining accent may have been garbled by itself
                key = reading.lower().strip(_EDGE)
                spelt, known = spelling(key, low)
                if _accented(reading) and reading != word:
                    yield word, *wild, reading, key, cost, 0.0, own - spelt, _clearer(own, low, spelt, key), signs and known

    # words of the corpus that a lattice with lost letters holds, by the letters that are left: no path is left out
    columns = "word string, low string, channel string, choices array<string>, skeleton string, reading string, key string, best double, cost double, gain double, clearer double, plain boolean"
    paths = cut(scan(found.where("tabla is not null").select("word").distinct(), columns, rows))
    marks = usual.where(~F.col("word").rlike("^[a-z]+$")).select(F.regexp_replace("word", "[^a-z]", _LOST).alias("skeleton"), F.col("word").alias("entry"))
    lost = paths.where("skeleton is not null").join(marks, "skeleton").select(*paths.columns, "entry")

    def enter(it):
        for word, low, channel, choices, bones, reading, key, best, _, gain, clearer, plain, entry in it:
            a, b = _trim(choices)
            fits = fitting(entry, choices[a:b], logs, floor)
            if fits and entry != key:
                own = spelling(low)[0]
                yield word, low, channel, None, None, "".join(choices[:a]) + fits[1] + "".join(choices[b:]), entry, best, fits[0] - best, own - fits[0], _clearer(own, low, fits[0], entry), plain

    tried = paths.unionByName(scan(lost, columns, enter)).drop("choices", "skeleton", "best")
    tried = tried.withColumn("cost", F.col("cost") + F.when(F.col("channel").contains("/utf8/"), 0.0).otherwise(2.0))
    rated = (
        tried.join(vocabulary.select(F.col("word").alias("key"), "freq", "whole"), "key", "left").join(vocabulary.select(F.col("word").alias("low"), F.col("freq").alias("own")), "low", "left")
        .fillna(0, ["freq", "own", "whole"]).withColumn("score", F.log1p("freq") * 2 - F.col("cost"))
    )
    # every reading has to be better spelt, letter by letter, than the word as it stands
    sure = F.col("channel").contains("/utf8/") | ((F.col("channel") == "lost") & ((F.col("freq") > 0) | (F.length("low") > 3)))
    often = ((F.col("freq") >= seen) & (F.col("freq") >= times * F.col("own"))) | ((F.col("whole") >= seen) & (F.col("gain") > 0))
    rated = cut(rated.withColumn("kept", sure & (F.col("clearer") > MARGIN) | ~sure & often))
    # a channel that words of the corpus prove also explains words that it lacks; the better spelt reading comes first
    proven = rated.where("kept").groupBy("channel").agg(F.count_distinct("word").alias("w")).where(F.col("w") >= seen).select("channel")
    held = rated.where("kept").select("word").distinct()
    lacking = rated.where("plain and gain > 0").join(F.broadcast(proven), "channel").join(held, "word", "left_anti").withColumn("score", F.col("gain"))
    kept = rated.where("kept").unionByName(lacking.select(*rated.columns))
    best = F.row_number().over(Window.partitionBy("word").orderBy(F.col("score").desc(), "channel", "reading"))  # a word has at most some hundred readings
    return kept.withColumn("r", best).where("r = 1").select("word", "reading", "channel", "freq")


def garbled(texts: DataFrame) -> DataFrame:
    """(tabla, clave) of the texts, given as (tabla, clave, text), with an accented letter shown as others or lost.

    Null keys and null texts give no row; equal keys of a table are one record; an empty table gives an empty result.
    """
    found = cut(evidence(texts))
    return found.where("tabla is not null").join(readings(found).select("word"), "word").select("tabla", "clave").distinct()


def restored(texts: DataFrame) -> DataFrame:
    """(tabla, clave, restored, words, unsure) of the affected texts: their garbled words replaced by their readings.

    ``words`` counts the different words replaced, ``unsure`` those whose reading the corpus does not hold. Repeated rows that are
    equal give one row.
    """
    found = cut(evidence(texts))
    per = cut(
        found.where("tabla is not null").join(readings(found), "word").groupBy("tabla", "clave")
        .agg(F.collect_set(F.struct("word", "reading", "freq")).alias("r"))
    )

    def rows(it):
        for tabla, clave, text, r in it:
            said = {x["word"]: x["reading"] for x in r}
            if "́" in text or "̃" in text or "̂" in text or "̀" in text or "̧" in text or "̈" in text:
                text = unicodedata.normalize("NFC", text)
            yield tabla, clave, _TOKEN.sub(lambda m: said.get(m.group(), m.group()), text), len(said), sum(not x["freq"] for x in r)

    # only affected texts are shuffled; equal rows are told apart by the hash of their text
    near = narrowed(texts.where(F.col("text").isNotNull()).select("tabla", "clave", "text"), per, ["tabla", "clave"]).dropDuplicates(["tabla", "clave", "text"])
    return scan(near.join(per, ["tabla", "clave"]), "tabla string, clave string, restored string, words int, unsure int", rows)


def texts_of(tabla: str, df: DataFrame, clave: Column, text: Column) -> DataFrame:
    return df.select(F.lit(tabla).alias("tabla"), clave.cast("string").alias("clave"), text.alias("text"))
