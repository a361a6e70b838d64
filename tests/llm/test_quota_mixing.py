import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tamiz.llm import mixing, quota

POOL = "pid string, journal string, issn string, relevancia string, palabras int, titulo string, need int, u double"
GOALS = "issn string, journal string, meta_pm int, minimo int"


def pool(spark, rows):
    return spark.createDataFrame([(p, None, i, "alta", 1, None, 3, 0.5) for p, i in rows], POOL)


def test_quota_exact(spark):
    r = random.Random(4)
    issns = ["1111-1111", "2222-2222", "3333-333X", "4444-4444"]
    rows = []
    for i in range(900):
        j = "1111-1111" if r.random() < 0.5 else r.choice(issns[1:3])
        rows.append((f"S{j}2001{i:09d}", r.choice([j, None, "", j.replace("-", ""), " " + j.lower(), "mal"])))
    rows += rows[:30] + [(None, "1111-1111")]
    goals = spark.createDataFrame([("1111-1111", "a", 100, 3), ("2222-2222", "b", 700, 5), ("3333-333X", "c", 1, 60), ("4444-4444", "d", 5, 2), ("5555-5555", None, None, None)], GOALS)
    units = quota.units(pool(spark, rows))
    assert units.count() == 900
    wanted = quota.needs(units, goals)
    have = Counter(p[1:10] for p, _ in rows[:900])
    n = 900 // 4
    need = {g.issn: max(g.minimo or 0, math.ceil((g.meta_pm or 0) * n / 1000)) for g in goals.collect()}
    assert {x.issn: x.need for x in wanted.collect()} == need
    sample = quota.quota_sample(units, wanted)
    got = Counter(x.issn for x in sample.collect())
    assert {k: v for k, v in got.items()} == {k: min(v, have[k]) for k, v in need.items() if min(v, have[k])}
    assert sample.select("pid").distinct().count() == sample.count()
    report = {x.issn: x.missing for x in quota.quota_report(sample, wanted).collect()}
    assert report == {k: v - min(v, have[k]) for k, v in need.items()}
    again = quota.quota_sample(units.repartition(7), wanted)
    assert {x.pid for x in again.collect()} == {x.pid for x in sample.collect()}


def test_quota_empty(spark):
    goals = spark.createDataFrame([("1111-1111", "a", 100, 3)], GOALS)
    units = quota.units(pool(spark, [("S1", None)]).limit(0))
    wanted = quota.needs(units, goals)
    assert [tuple(x)[:4] for x in wanted.collect()] == [("1111-1111", 3, 0, 3)]
    assert quota.quota_sample(units, wanted).count() == 0
    assert quota.quota_sample(units, wanted.limit(0)).count() == 0


DOCS = "doc_id bigint, text string, source string, size int, u double, demand int"


def docs(spark, n=400, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = r.choice(["Grande", " grande", "GRANDE ", "b", "c", None, "", "d"])
        rows.append((i, None if r.random() < 0.05 else " ".join(["x"] * r.randrange(0, 30)), s, 7, 0.1, 1))
    return spark.createDataFrame(rows, DOCS), rows


MIX = "source string, peso_pm int, max_repeticiones int"


def test_mix(spark):
    d, rows = docs(spark)
    size = Counter()
    for _, t, s, *_ in rows:
        if t is not None and s and s.strip():
            size[s.strip().lower()] += len(t.split())
    goals = spark.createDataFrame([("grande", 300, 1), ("b", 400, 3), ("c", 290, 1), ("e", 10, 2)], MIX)
    sizes = mixing.sized(d)
    plan = {r.source: r for r in mixing.plan(sizes, goals).collect()}
    total = sum(size.values())
    for s, (peso, rep) in {"grande": (300, 1), "b": (400, 3), "c": (290, 1), "e": (10, 2)}.items():
        assert plan[s].size == size[s]
    short = {r.source: r.short for r in mixing.shares(mixing.curriculum(sizes, goals), mixing.plan(sizes, goals)).collect()}
    assert short == {s: size[s] * rep < peso * total / 2 / 1000 for s, (peso, rep) in {"grande": (300, 1), "b": (400, 3), "c": (290, 1), "e": (10, 2)}.items()} and set(short.values()) == {True, False}
    # without the curriculum every source lacks its share
    assert all(r.short for r in mixing.shares(mixing.curriculum(sizes, goals).limit(0), mixing.plan(sizes, goals)).collect())
    mix = mixing.curriculum(sizes, goals).collect()
    assert [r.position for r in mix] == sorted(r.position for r in mix) and all(0 <= r.position <= 1 for r in mix)
    used, most = Counter(), Counter()
    for r in mix:
        used[r.source] += r.size
        most[r.source, r.doc_id] += 1
    for s, p in plan.items():
        big = max((len(t.split()) for _, t, x, *_ in rows if t and x and x.strip().lower() == s), default=0)
        assert abs(used[s] - p.used) <= big
        assert max((c for (x, _), c in most.items() if x == s), default=0) <= p.max_rep
    # a repeated source's weight grows: less than its even share in the first half of positions
    early = sum(r.size for r in mix if r.source == "b" and r.position < 0.5)
    assert early < 0.45 * used["b"]
    rep = {r.source: r for r in mixing.shares(mixing.curriculum(sizes, goals), mixing.plan(sizes, goals)).collect()}
    assert rep["e"].size == 0 and rep["e"].deficit > 0 and abs(sum(r.share_pm for r in rep.values()) - 1000) < 0.1


def test_mix_empty_and_null_targets(spark):
    d, _ = docs(spark)
    goals = spark.createDataFrame([("b", None, None), (None, 5, 5)], MIX)
    assert mixing.curriculum(mixing.sized(d), goals).count() == 0
    none = mixing.sized(d.limit(0)), spark.createDataFrame([("b", 5, 5)], MIX)
    assert mixing.shares(mixing.curriculum(*none), mixing.plan(*none)).first().short is False
    assert mixing.curriculum(mixing.sized(d.limit(0)), spark.createDataFrame([("b", 5, 5)], MIX)).count() == 0


def test_tokenizers(spark):
    import pathlib

    import pytest

    place = pathlib.Path("/opt/tokenizers")
    if not place.exists():
        pytest.skip("no tokenizers")
    for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        n = mixing.count_tokens(str(place / f))
        assert n("") == 0 and 2 <= n("El paciente <|endoftext|> presentó") < 40
    assert mixing.count_tokens(str(place / "byte_bpe_50k.tiktoken"))("Un caso clínico") == mixing.count_tokens(str(place / "byte_bpe_50k.json"))("Un caso clínico")


def test_running_total(spark):
    from tamiz.llm.common import running_total

    r = random.Random(1)
    rows = [(r.choice("aab"), r.randrange(20), r.randrange(5)) for _ in range(500)]
    got = running_total(spark.createDataFrame(rows, "g string, o int, w int"), "g", ["o"], "w").collect()
    for g in "ab":
        mine = sorted((x for x in got if x.g == g), key=lambda x: x.before)
        run, last = 0, -1
        for x in mine:
            assert x.o >= last
            last = x.o
        assert sorted(x.before + x.w for x in mine)[-1] == sum(w for a, _, w in rows if a == g)
    assert F is not None
