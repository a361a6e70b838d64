import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from tamiz.functions.text import compose
from tamiz.operators import chat, clean, entities, fetch, relational, responses
from tamiz.plans import pipeline
from tamiz.sources import files


def test_fetch(spark, rows):
    d = spark.createDataFrame([("a", "u"), ("a", "u"), ("b", "v"), ("c", None), ("d", "w"), ("e", "x"), ("f", "y"), (None, "u"), ("", "u")], "pid string, html_url string")
    have = spark.createDataFrame([("e", 7), ("e", 9), (None, 1)], "pid string, chars int")

    def lookup():
        def own(pid):
            if pid == "b":
                raise TimeoutError
            return "<p>" + "x" * 300 if pid == "a" else "corto"

        return own

    def get():
        def load(url):
            if url == "w":
                raise ConnectionError
            return (200, ("<meta charset=latin-1><p>" + "ñ" * 600 + "</p>").encode("latin-1")) if url == "v" else (500, "")

        return load

    got = rows(fetch.fetch_bodies(d, have, lookup, get, tasks=2, pace=0.0), "pid", "fuente", "chars")
    assert got == [("a", "articlemeta_body", 303), ("b", "parrafos", 600), ("c", "sin_texto", 0), ("d", "error_http:ConnectionError", 0), ("e", "ya_existia", 9), ("f", "sin_texto", 0)]
    assert fetch.fetch_bodies(d.limit(0), have, lookup, get).count() == 0
    assert fetch.decoded("año".encode()) == "año" == fetch.decoded("año".encode("cp1252")) and fetch.decoded("x") == "x"


def test_chat(spark, rows, monkeypatch):
    d = spark.createDataFrame([("a", 'di "hola"\n'), ("b", None)], "pid string, text string").select("pid", chat.chat_body("sé breve", F.col("text"), "m", 400).alias("b"))
    got = {r.pid: r.b for r in d.collect()}
    assert got["b"] is None and json.loads(got["a"]) == {"model": "m", "messages": [{"role": "system", "content": "sé breve"}, {"role": "user", "content": 'di "hola"\n'}], "temperature": 0, "max_tokens": 400, "response_format": {"type": "json_object"}}
    called = [("a", chat.fake_chat("{}", {"prompt_tokens": 5, "completion_tokens": 2}), ""), ("b", "nada", ""), ("c", None, "HTTP 403"), ("d", chat.fake_chat(" ", {"prompt_tokens": 1}), "")]
    a = chat.answers(spark.createDataFrame(called, "pid string, response string, error string"))
    assert rows(a, "pid", "error") == [("a", ""), ("b", "respuesta_no_json"), ("c", "HTTP 403"), ("d", "respuesta_vacia")]
    assert rows(chat.usage(a)) == [(4, 3, 6, 2, 0, 0)] and rows(chat.usage(a.limit(0))) == [(0, 0, 0, 0, 0, 0)]
    monkeypatch.setenv("LLAVE", " x ")
    assert chat.secret("LLAVE") == "x"
    monkeypatch.setenv("LLAVE", "")
    with pytest.raises(RuntimeError):
        chat.secret("LLAVE")


def test_apply_answer(spark):
    text = " menú \n" + "palabra " * 200 + "fin del caso\nReferencias y más"
    cases = [
        (None, (text, False, False, False)), ('{"tipo_basura":"x"}', (text.strip(), False, False, False)),
        ('{"inicio_basura":true,"frag_inicio_contenido":"palabra palabra","fin_basura":true,"frag_inicio_basura_final":" Referencias y"}', (("palabra " * 200 + "fin del caso"), True, True, False)),
        ('{"inicio_basura":true,"frag_inicio_contenido":"fin del caso"}', (text.strip(), True, False, True)), ('{"inicio_basura":false,"frag_inicio_contenido":"palabra palabra"}', (text.strip(), False, False, False)),
    ]
    d = spark.createDataFrame([(i, text, a) for i, (a, _) in enumerate(cases)], "i int, text string, a string")
    got = d.select("i", clean.apply_answer(F.col("text"), responses.parse(F.col("a"), clean.CUT)).alias("r")).orderBy("i").collect()
    assert [tuple(x.r) for x in got] == [w for _, w in cases]


def test_review_and_decisions(spark):
    answers = [None, '{"es_caso_oncologico":true,"confianza":"alta"}', '{"es_caso_oncologico":false,"idioma_cuerpo":"mixto","calidad_recorte":"otro","confianza":"0.5"}']
    d = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string").select("i", responses.review(responses.parse(F.col("a"))).alias("r")).orderBy("i")
    assert [tuple(x.r) for x in d.collect()] == [(True, "sin_respuesta_del_modelo"), (False, ""), (True, "no_es_caso_oncologico;idioma_mixto;recorte_otro;baja_confianza")]
    e = spark.createDataFrame([("t", "x", ["Introducción"], 1), ("Case of the tumor", "x", ["Introducción"], 1), ("t", "x", [], 1), ("t", "x", ["Introducción"], 0)], "title string, text string, s array<string>, n int")
    got = e.select(pipeline.decision_reason(F.col("title"), F.col("text"), F.col("s"), last=((F.col("n") == 0, "DESCARTADO", "otra"),)).alias("r")).collect()
    assert [x.r.decision for x in got] == ["SELECCIONADO", "DESCARTADO", "REVISAR", "DESCARTADO"] and got[3].r.motivo == "otra"


def test_eligible(spark, rows):
    t = spark.createDataFrame([("a", "x " * 150), ("b", "x " * 150), ("c", "x"), ("d", "x " * 150), ("e", None)], "pid string, text string")
    c = spark.sql("select * from values ('a', 'alta', timestamp'2020-01-01'), ('b', 'media', timestamp'2020-01-01'), ('d', 'media', timestamp'2020-01-01'), ('d', 'alta', timestamp'2021-01-01') as t(pid, relevancia, cosechado_en)")
    assert rows(pipeline.eligible(t, c), "pid", "dropped") == [("a", None), ("b", "relevancia"), ("c", "palabras"), ("d", None), ("e", "palabras")]
    assert rows(pipeline.eligible(t, c, with_medium=True).where("dropped is null"), "pid") == [("a",), ("b",), ("d",)]
    assert rows(pipeline.eligible(t, c.limit(0)).where("dropped is null"), "pid") == [("a",), ("b",), ("d",)]


def test_compose(spark):
    texts = ["".join(chr(c) for c in range(a, a + 64) if chr(c).isprintable()) for a in range(0x20, 0x1F00, 64)]
    both = [(x, unicodedata.normalize("NFD", x)) for x in texts] + [(None, None), ("", "")]
    got = spark.createDataFrame(both, "a string, b string").select(compose(F.col("a")).alias("a"), compose(F.col("b")).alias("b")).collect()
    latin = [(r, x) for r, (x, _) in zip(got, both) if x and max(map(ord, x)) < 0x250 and min(map(ord, x)) >= 0x20]
    assert all(r.a == r.b == unicodedata.normalize("NFC", x) for r, x in latin) and len(latin) >= 8 and got[-2].a is None and got[-1].a == ""


def test_plans(spark):
    d = spark.createDataFrame([("k", "a b a", [("a", "SINTOMA"), ("a", "sintoma"), ("a", "SINTOMA"), ("b", "otra")])], "task_id string, text string, entidades array<struct<texto:string,categoria:string>>")
    m = entities.mention_offsets(d)
    assert "Exchange" not in m._jdf.queryExecution().executedPlan().toString()
    assert [(r.start, r.end) for r in m.orderBy("ord").collect()] == [(0, 1), (4, 5), (0, 1)]
    median = relational.upper_median(spark.createDataFrame([(x,) for x in (1, 9, 3, 4, None)], "v int"), "v")
    assert tuple(median.first()) == (4, 1, 4, 9, 17) and "Window" not in median._jdf.queryExecution().executedPlan().toString()
    assert relational.upper_median(spark.createDataFrame([(None,)], "v int"), "v").count() == 0


def test_observed_and_capped(spark, rows):
    d = spark.createDataFrame([(f"p{i:02d}",) for i in range(12)] + [(None,)], "pid string")
    seen, note = relational.observed(d, "n", F.col("pid") > "p05")
    seen.collect()
    assert note.get == {"rows": 13, "flagged": 6}
    r = relational.capped(d, "pid", 10).first()
    assert (r.n, len(r.shown), r.more) == (12, 10, 2) and relational.capped(d.limit(0), "pid", 10).first().shown == []
    assert rows(relational.first_pending(d.where("pid is not null"), d.where("pid = 'p01'"), "pid", 3)) == [("p00",), ("p02",)]


def test_texts_and_selection(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_bytes("año �\r\nx".encode() + b"\xff")
    assert rows(files.texts(spark, str(tmp_path))) == [("a", "año �\nx")] and rows(files.texts(spark, str(tmp_path), "replace")) == [("a", "año �\nx�")]
    d = spark.createDataFrame([("p", "uno"), ("q", "dos"), ("r", None)], "pid string, text string")
    out = tmp_path / "out"
    out.mkdir()
    files.write_selection(d, spark.createDataFrame([("q",), ("r",), ("q",)], "pid string"), str(out))
    assert [x.name for x in out.iterdir()] == ["q.txt"]
    files.write_csv(spark.createDataFrame([("a", ""), ("a", "e"), ("b", "e")], "pid string, error string"), str(tmp_path / "c"))
    files.rewrite_without_failed(spark, str(tmp_path / "c"), str(tmp_path / "d"), "pid string, error string", F.coalesce("error", F.lit("")) == "", "pid")
    assert {r.pid for r in files.csv_table(spark, str(tmp_path / "d"), "pid string, error string").collect()} == {"a"}
    with pytest.raises(ValueError):
        files.rewrite_without_failed(spark, "x", "x/", "pid string", F.lit(True), "pid")
