import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamiz.operators import calls, entities, relational, responses, sampling


def test_dedup(spark, rows):
    d = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", None, None), (None, 5, "n"), (None, 6, "m")], "k string, o int, v string")
    assert rows(relational.dedup(d, "k", [F.col("o")])) == sorted([("a", 1, "b"), ("b", None, None), (None, 5, "n")], key=repr)
    assert rows(relational.dedup(d, "k", [F.col("o")], "last")) == sorted([("a", 2, "x"), ("b", None, None), (None, 6, "m")], key=repr)
    assert relational.dedup(d.limit(0), "k", [F.col("o")]).count() == 0


def test_joins(spark, rows):
    a = spark.createDataFrame([("p1",), ("p2",), (None,)], "pid string")
    done = spark.createDataFrame([("p1", ""), ("p1", "e"), ("p3", "e"), (None, "")], "pid string, error string")
    assert rows(relational.pending(a, done, "pid")) == [("p2",), (None,)]
    assert rows(relational.approved(a, done, "pid")) == [("p1",)]
    assert rows(relational.without_failed(done, F.col("error") == "", "pid")) == [("p1", ""), ("p1", "e")]
    dim = spark.createDataFrame([("p1", "uno")], "pid string, v string")
    assert rows(relational.lookup(a, dim, "pid", "v", "-")) == [("p1", "uno"), ("p2", "-"), (None, "-")]


def test_upper_median(spark):
    r = random.Random(3)
    for n in (1, 2, 5, 40):
        vs = [r.randrange(6) for _ in range(n)]
        got = relational.upper_median(spark.createDataFrame([(v,) for v in [*vs, None]], "v int"), "v").first()
        assert tuple(got) == (n, min(vs), sorted(vs)[n // 2], max(vs), sum(vs))
    assert relational.upper_median(spark.createDataFrame([], "v int"), "v").count() == 0


def test_split_counts(spark, rows):
    d = spark.createDataFrame([("a; b;;a",), (None,), ("",)], "m string")
    assert rows(relational.split_counts(d, "m")) == [("a", 2), ("b", 1)]


def test_allocation(spark, rows):
    d = spark.createDataFrame([("A", 5), ("B", 3), ("C", 2)], "stratum string, size bigint")
    assert rows(sampling.allocate(d, 7), "stratum", "quota") == [("A", 4), ("B", 2), ("C", 1)]
    assert sum(r[1] for r in rows(sampling.allocate(d, 99), "stratum", "quota")) == 10
    assert sampling.allocate(d.limit(0), 7).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=6), st.integers(0, 80))
def test_allocation_sums(spark, sizes, n):
    d = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "stratum string, size bigint")
    got = sampling.allocate(d, n).collect()
    assert sum(r.quota for r in got) == min(n, sum(sizes)) and all(r.quota <= r.size for r in got)


def test_draw_and_reserve(spark, rows):
    import hashlib

    pool = spark.createDataFrame([(f"p{i}", "hot" if i % 3 else f"s{i % 9}") for i in range(900)], "pid string, stratum string")
    quotas = sampling.allocate(pool.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")), 100)
    drawn = sampling.draw(pool, quotas, "pid", seed=7)
    assert drawn.count() == 100
    want = set()
    by = {}
    for p, s in pool.collect():
        by.setdefault(s, []).append(p)
    for r in quotas.collect():
        want |= set(sorted(by[r.stratum], key=lambda p: hashlib.md5(f"7:{p}".encode()).hexdigest())[: r.quota])
    assert {r.pid for r in drawn.collect()} == want
    rest = sampling.reserve(pool, drawn, "pid")
    assert rest.count() == 800 and rest.join(drawn, "pid", "left_semi").count() == 0


def test_responses(spark):
    d = spark.createDataFrame([('Sí:\n```json\n{"confianza": "0.5", "idioma_cuerpo": "es", "es_caso_oncologico": false}\n``` fin',), ("{}",), ("nada",), (None,), ('{"a": 1',)], "c string")
    got = [r[0] for r in d.select(responses.parse(F.col("c"))).collect()]
    assert got[0].confianza == "0.5" and got[0].es_caso_oncologico is False and got[1:] == [None] * 4
    cut = spark.createDataFrame([('{"entidades":[{"texto":"tos \\"x\\"","categoria":"SINTOMA"},{"texto":"a',)], "c string")
    assert [tuple(x) for x in cut.select(responses.rescued(F.col("c"))).first()[0]] == [('tos \\"x\\"', "SINTOMA")]
    rule = spark.createDataFrame([(True, None)], "a boolean, b boolean").select(responses.reasons([(F.col("a"), "uno"), (F.col("b"), "dos"), (~F.col("a"), "tres")]), responses.first_match([(F.col("b"), "x"), (F.col("a"), "y")], "z")).first()
    assert tuple(rule) == ("uno", "y")


def spans(spark, rows, text, es, **kw):
    d = spark.createDataFrame([(1, text, es)], "task_id bigint, text string, entidades array<struct<texto:string,categoria:string>>")
    return sorted(tuple(r) for r in entities.mention_offsets(d, **kw).select("start", "end", "mention", "label").collect())


def test_offsets(spark, rows):
    assert spans(spark, rows, "TAC y TAC", [("TAC", "PROCEDIMIENTO")] * 3) == [(0, 3, "TAC", "PROCEDIMIENTO")] * 2 + [(6, 9, "TAC", "PROCEDIMIENTO")]
    assert len(spans(spark, rows, "TAC y TAC", [("TAC", "PROCEDIMIENTO")] * 3, dedupe=True)) == 2
    assert spans(spark, rows, "TAC", [("TAC", "OTRO"), ("RM", "SINTOMA"), (" ", "SINTOMA"), (None, "SINTOMA"), ("TAC", None)]) == []
    assert spans(spark, rows, "😀TAC", [(" TAC ", " procedimiento")]) == [(1, 4, "TAC", "PROCEDIMIENTO")]
    assert spans(spark, rows, None, [("TAC", "SINTOMA")]) == [] == spans(spark, rows, "TAC", None)


def test_offsets_against_scan(spark):
    r = random.Random(5)
    data = [(i, "".join(r.choice("ab ") for _ in range(30)), [(r.choice(["a", "ab", "b a", "aa"]), "SINTOMA") for _ in range(6)]) for i in range(40)]
    d = spark.createDataFrame(data, "task_id bigint, text string, entidades array<struct<texto:string,categoria:string>>")
    got = {(x.task_id, x.ord): x.start for x in entities.mention_offsets(d).collect()}
    want = {}
    for k, text, es in data:
        at = Counter()
        for o, (m, _) in enumerate(es):
            p = text.find(m, at[m])
            if p < 0:
                p = text.find(m)
            if p >= 0:
                at[m] = p + len(m)
                want[k, o] = p
    assert got == want


def test_annotation_tasks(spark):
    import json

    d = spark.createDataFrame([(1, "P1", "TAC y tos", [("tos", "SINTOMA"), ("TAC", "PROCEDIMIENTO")]), (2, "P2", "nada", None)], "task_id bigint, pid string, text string, entidades array<struct<texto:string,categoria:string>>")
    got = {r.task_id: json.loads(r.task) for r in entities.annotation_tasks(entities.mention_offsets(d), d, F.lit("m")).collect()}
    res = got[1]["predictions"][0]["result"]
    assert [x["id"] for x in res] == ["P1_0", "P1_1"] and all(got[1]["data"]["text"][x["value"]["start"]:x["value"]["end"]] == x["value"]["text"] for x in res)
    assert got[2]["predictions"][0]["result"] == []


def test_calls(spark):
    waits = []
    seq = lambda *a: (lambda it: (lambda _: next(it)))(iter(a))
    assert calls.call(seq((503, "", {}), (429, "", {"Retry-After": "9"}), (200, "ok", {})), "r", sleep=waits.append) == ("ok", "", 3) and waits == [5.0, 9.0]
    assert calls.call(seq((401, "", {})), "r", sleep=waits.append) == (None, "HTTP 401", 1)
    assert calls.call(lambda _: (500, "", {}), "r", sleep=lambda _: None) == (None, "agotados_reintentos", 5)

    def boom(_):
        raise TimeoutError

    assert calls.call(boom, "r", sleep=lambda _: None) == (None, "excepcion: TimeoutError", 5)
    assert calls.delays() == [5, 10, 20, 40]
    d = spark.createDataFrame([("a", "x"), ("b", None)], "pid string, request string")
    got = sorted(tuple(r) for r in calls.call_all(d, lambda: lambda r: (200, r * 2, {}), pace=0).collect())
    assert got == [("a", "xx", "", 1), ("b", None, "sin_peticion", 0)]
