import json

from pyspark.sql import functions as F

from tamiz.plans import pipeline
from tamiz.sources import files

TEXT = "Revista\nReporte de caso\nCarcinoma renal\nIntroducción\n" + "El paciente con tos acudió por dolor. " * 40 + "\nReferencias\n1. x"


def test_harvest(spark, rows):
    schema = "pid string, titulo string, resumen string, tipo_documento string, anio string, idioma string, licencia string, html_url string"
    a = [("p1", "Carcinoma: reporte de caso", None, None, "2001", "es", None, "u2"), ("p1", "Carcinoma: reporte de caso", None, None, "2001", "es", None, "u1"), ("p2", "Fractura", None, "case-report", None, None, None, None), ("p3", "Linfoma", None, "case-report", None, None, None, None), (None, "Linfoma", None, "case-report", None, None, None, None)]
    known = spark.createDataFrame([("p3",)], "pid string")
    assert rows(pipeline.harvest(spark.createDataFrame(a, schema), known), "pid", "relevancia", "html_url") == [("p1", "alta", "u1")]


def test_chain(spark, rows, tmp_path):
    texts = spark.createDataFrame([(f"S1111-11112001{i:09d}", TEXT) for i in range(8)] + [("S2222-22222001000000001", "Case of the tumor\nIntroduction\nx\nDiscussion\ny"), ("S3", None)], "pid string, text string")
    cand = spark.createDataFrame([("S3", "x")], "pid string, titulo string")
    cur = pipeline.curate(texts, cand)
    assert {r.decision: r.n for r in cur.groupBy("decision").agg(F.count(F.lit(1)).alias("n")).collect()} == {"SELECCIONADO": 8, "DESCARTADO": 1, "REVISAR": 1}
    one = cur.where("decision = 'SELECCIONADO'").first()
    assert one.title == "Carcinoma renal" and one.start_label == "introduccion" and one.core.startswith("Introducción\nEl paciente") and "Referencias" not in one.core
    drawn, rest = pipeline.sample(cur, pipeline.Settings(sample=3))
    assert drawn.count() == 3 and rest.count() == 5
    req = pipeline.requests(texts, drawn, "A {text} B", pipeline.Settings(prompt_characters=7))
    assert {r.request for r in req.where("pid like 'S1%'").collect()} == {"A Revista B"} and req.count() == 7
    answers = spark.createDataFrame([("S1111-11112001000000000", '{"entidades":[{"texto":"tos","categoria":"SINTOMA"}]}'), ("S1111-11112001000000001", '{"entidades":[{"texto":"tos","categoria":"SINTOMA"},{"texto":"do'), ("S3", "x")], "pid string, response string")
    got = {r.pid: json.loads(r.task) for r in pipeline.mentions(texts, answers, "m").collect()}
    assert [len(got[f"S1111-1111200100000000{i}"]["predictions"][0]["result"]) for i in (0, 1)] == [1, 1] and got["S3"]["predictions"][0]["result"] == []
    files.write_texts(texts.where("pid <> 'S3'"), str(tmp_path))
    assert rows(files.texts(spark, str(tmp_path))) == rows(texts.where("pid <> 'S3'"))
