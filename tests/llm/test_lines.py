import random
import re
import unicodedata
from collections import defaultdict

import pyarrow as pa

from tamiz.llm import lines

SCHEMA = "task_id bigint, pid string, text string, k string, p string, n int, cluster string"


def table(spark, data):
    return spark.createDataFrame([(i, p, t, "k", "p", 1, "c") for i, (p, t) in enumerate(data)], SCHEMA)


def brute(data, least=5, share=50):
    def key(s):
        return "".join(c for c in unicodedata.normalize("NFD", s).lower() if c.isalnum())

    pids, seen = defaultdict(set), defaultdict(set)
    for p, t in data:
        if p is not None:
            pids[p[1:10]].add(p)
            for x in (t or "").split("\n"):
                if len(key(x)) >= 30:
                    seen[p[1:10], key(x)].add(p)
    out = set()
    for i, (p, t) in enumerate(data):
        if p is not None:
            for n, x in enumerate((t or "").split("\n"), 1):
                c = len(seen.get((p[1:10], key(x)), ()))
                if len(key(x)) >= 30 and c >= least and c * 1000 >= len(pids[p[1:10]]) * share:
                    out.add((i, n))
    return out


def corpus(seed=1, n=300):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghilmnopqrstu") for _ in range(r.randrange(3, 9)))
    notices = [" ".join(word() for _ in range(9)).capitalize() + " árbol Ñandú 12" for _ in range(6)]
    data = []
    for i in range(n):
        j = "1111-1111" if r.random() < 0.4 else f"{r.randrange(8):04d}-000X"
        body = [" ".join(word() for _ in range(14)) for _ in range(4)]
        for x in r.sample(notices, 2):
            body.insert(r.randrange(4), r.choice([x, x.upper(), x.replace("árbol", "arbol"), "» " + x + ".", unicodedata.normalize("NFD", x)]))
        data.append((f"S{j}{r.randrange(2000, 2003)}{i // 2:09d}", "\r\n".join(body)))
    return [*data, data[0], (None, notices[0]), ("S1111-11112000999999999", None), ("S1111-11112000999999998", ""), ("x", "corto")]


def test_found_equals_brute_force(spark):
    data = corpus()
    got = {(r.task_id, r.line_no) for r in lines.repeated_lines(table(spark, data), exact=True).collect()}
    assert got == brute(data) and len(got) > 300


def test_clusters_join_near_copies(spark):
    base = "Los autores ceden los derechos de difusión de este artículo a la revista por un plazo de {} años y medio según el acuerdo firmado el {} de mayo con la sociedad"
    data = [(f"S1111-11112001{i:09d}", base.format(i, i % 28) + f"\nprosa distinta número {i} " + "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(60))) for i in range(40)]
    got = lines.repeated_lines(table(spark, data)).collect()
    assert {(r.task_id, r.line_no) for r in got} == {(i, 1) for i in range(40)} and {r.cluster_pids for r in got} == {40}
    assert lines.repeated_lines(table(spark, data), exact=True).count() == 0  # none recurs by itself


def near(data, least, share):
    """(task, line, pids of its cluster) by brute force: components of the pairs of exact similarity 0.8 within a journal."""
    grams, pids, at = {}, defaultdict(set), defaultdict(set)
    for i, (p, t) in enumerate(data):
        for n, x in enumerate(t.split("\n"), 1):
            m = lines.mask(re.findall(r"[^\W_]+", lines.bare(x)))
            g = frozenset(tuple(m[k:k + 5]) for k in range(max(1, len(m) - 4)))
            grams[p[1:10], g] = (p[1:10], g)
            pids[p[1:10], g].add(p)
            at[p[1:10], g].add((i, n))

    def root(x):
        while grams[x] != x:
            x = grams[x]
        return x

    every = list(grams)
    for k, a in enumerate(every):
        for b in every[:k]:
            if a[0] == b[0] and len(a[1] & b[1]) * 5 >= len(a[1] | b[1]) * 4:
                grams[root(a)] = root(b)
    size, total = defaultdict(set), defaultdict(set)
    for x in every:
        size[root(x)] |= pids[x]
    for p, _ in data:
        total[p[1:10]].add(p)
    return {(i, n, c) for x in every if (c := len(size[root(x)])) >= least and c * 1000 >= share * len(total[x[0]]) for i, n in at[x]}


def families():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghilmnopqrstu") for _ in range(r.randrange(3, 9)))
    opening = [word() for _ in range(12)]  # families that share it are not similar to each other, and their lines are not copies
    sorts = [opening + [word() for _ in range(r.randrange(30, 60))] for _ in range(25)]
    data = []
    for i in range(150):
        base = list(sorts[i % 25])
        for _ in range(1 + len(base) // 60):
            base[r.randrange(12, len(base))] = word()
        data.append((f"S{1111 + i % 2}-11112001{i:09d}", " ".join(base)))
    chain = [word() for _ in range(60)]
    for i in range(12):  # each is similar to the next ones only
        chain[4 * i + 3] = word()
        data.append((f"S1111-11112001{200 + i:09d}", " ".join(chain)))
    return data


def test_clusters_equal_brute_force(spark, monkeypatch):
    data = families()
    found = lambda: {(x.task_id, x.line_no, x.cluster_pids) for x in lines.repeated_lines(table(spark, data), least=2, share_pm=1).collect()}
    want = near(data, 2, 1)
    got = found()
    assert {x[2] for x in want} >= {2, 3, 12} and {x[:2] for x in got} <= {x[:2] for x in want}  # no false member; a missed link may part a cluster
    assert len({x[:2] for x in got}) >= 0.97 * len({x[:2] for x in want}) and len(got & want) >= 0.9 * len(want)
    monkeypatch.setattr(lines, "HOT", 4)  # large buckets are spread over others, without a loss
    assert found() == got


def test_recall_of_pairs(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghilmnopqrstu") for _ in range(r.randrange(3, 9)))
    data = []
    for i in range(400):  # pairs of similarity 0.80 to 0.84: two words apart
        base = [word() for _ in range(r.randrange(96, 120))]
        other = list(base)
        other[10], other[50] = word(), word()
        data += [(f"S1111-11112001{2 * i + k:09d}", " ".join(x)) for k, x in enumerate((base, other))]
    want, got = near(data, 2, 1), {(x.task_id, x.line_no, x.cluster_pids) for x in lines.repeated_lines(table(spark, data), least=2, share_pm=1).collect()}
    assert len(want) > 300 and got <= want and len(got) >= 0.98 * len(want)


def test_components(spark):
    r = random.Random(6)
    n = list(range(80))
    r.shuffle(n)
    pairs = [(a, b) for a, b in zip(n[:60], n[1:60])] + [(n[60], b) for b in n[61:]]
    got = {x.m: x.cluster for x in lines.components(spark.createDataFrame(pairs, "m bigint, to bigint")).collect()}
    assert got == {m: min(n[:60]) for m in n[:60]} | {m: min(n[60:]) for m in n[60:]}


def test_clean(spark):
    data = corpus(2, 80)
    d = table(spark, data)
    found = lines.repeated_lines(d, exact=True)
    want = brute(data)
    for r in lines.without_lines(d, found).collect():
        t = data[r.task_id][1]
        assert r.clean == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (r.task_id, n) not in want))


def test_empty_and_long(spark):
    assert lines.repeated_lines(table(spark, []).limit(0)).count() == 0
    long = "palabra repetida muchas veces en la línea " * 40_000
    assert lines.repeated_lines(table(spark, [(f"S1111-11112001{i:09d}", long) for i in range(6)]), exact=True).count() == 6


def test_mask():
    assert lines.mask(re.findall(r"\w+", "Depósito legal N 2006 78831 Sociedad de Oncología")) == ["depósito", "legal", "x", "0", "x", "de", "x"]
    assert lines.mask(["TODO", "EN", "MAYÚSCULAS"]) == ["todo", "en", "mayúsculas"]


def test_unrelated_long_lines_are_no_members(spark, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghilmnopqrstu") for _ in range(r.randrange(3, 9)))
    phrases = [[word() for _ in range(15)] for _ in range(40)]  # lines that share some meet in a band, none is similar to another
    data = [(f"S1111-11112001{i:09d}", " ".join(w for x in r.sample(phrases, 6) for w in x)) for i in range(400)]
    assert not near(data, 2, 1)
    members, cut = [], lines.cut

    def counted(df):
        out = cut(df)
        if "hot" in out.columns and "s" not in out.columns:
            members.append(out.count())
        return out

    monkeypatch.setattr(lines, "cut", counted)
    assert lines.repeated_lines(table(spark, data), least=2, share_pm=1).count() == 0 and members and max(members) <= 4


def test_fit_loses_no_pair(monkeypatch):
    r = random.Random(10)
    sets = []
    for _ in range(150):  # of all sizes around WIDE; pairs of similarity 0.8 and more among others
        a = set(r.sample(range(1 << 24), r.randrange(4, 3 * lines.WIDE)))
        for _ in range(r.randrange(1, 4)):
            b = set(a)
            for _ in range(r.randrange(1 + len(a) // 8)):
                b.discard(r.choice(sorted(b)))
                b.add(r.randrange(1 << 24))
            sets.append(frozenset(b) if r.random() < 0.8 else frozenset(r.sample(sorted(b), len(b) * 4 // 5 + 1)))
    sets = list(dict.fromkeys(x for x in sets if len(x) > 3))
    packed = [b"".join(t.to_bytes(3, "little") for t in sorted(x)) for x in sets]
    b = pa.RecordBatch.from_arrays([pa.array([7] * len(sets)), pa.array(range(len(sets))), pa.array(packed)], names=["j", "m", "s"])
    band = next(lines.banded([b, b.slice(5, 9)])).set_column(0, "bucket", pa.array([1] * len(sets)))  # all in one bucket
    order = sorted(range(len(sets)), key=lambda i: (band.column("parity")[i].as_py() & 65535, i))
    want = {i for i, x in enumerate(sets) for k, y in enumerate(sets) if i != k and len(x & y) * 5 >= len(x | y) * 4}
    rows = lambda: [x for b in lines.fit([band.take(pa.array(order))]) for x in zip(b.column("m").to_pylist(), b.column("hot").to_pylist())]
    assert [lines.unpacked(x) for x in packed] == [sorted(x) for x in sets] and {len(sets[i]) < lines.WIDE for i in want} == {True, False}
    alone = {i for i, x in enumerate(sets) if not any(i != k and len(x & y) * 2 >= len(x | y) for k, y in enumerate(sets))}
    assert want <= {m for m, hot in rows() if not hot} and not alone & {m for m, _ in rows()} and len(alone) > 20
    monkeypatch.setattr(lines, "HOT", 5)
    assert want <= {m for m, hot in rows() if hot} and not alone & {m for m, _ in rows()}
    monkeypatch.setattr(lines, "DENSE", 5)  # not compared at all
    assert sorted(rows()) == [(i, True) for i in range(len(sets))]
