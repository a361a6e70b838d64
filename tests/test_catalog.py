from pyspark.sql import functions as F

from tamiz.operators import catalog
from tamiz.sources.files import catalogue_cards


def cat(spark, *lines):
    return catalog.catalogue(spark.createDataFrame([("\n".join(lines),)], "text string")).first()


def test_sections(spark):
    d = spark.createDataFrame([("Palabras Clave: x",), ("DISCUSIÓN.",), ("Discutir",), ("key words",), ("",), (None,)], "l string")
    assert [r[0] for r in d.select(catalog.section_of(F.col("l"))).collect()] == ["Palabras clave", "Discusión", None, "Key words", None, None]


def test_header(spark):
    r = cat(spark, "", "versión ISSN 1", "", "ISSN 2", "v.1", "T")
    assert (r.voldate, r.title, r.type) == ("v.1", "T", None)
    r = cat(spark, "Revista", "Artículo original", "T")
    assert (r.type, r.title, r.voldate) == ("Artículo original", "T", None)
    r = cat(spark, "ISSN 1", "", "ISSN 2")
    assert r.voldate is None and r.title is None
    r = cat(spark, "Reporte de caso:", "Introducción", "x")
    assert (r.type, r.title, r.final_type) == ("Reporte de caso", None, "Reporte de caso")


def test_structure_and_type(spark):
    r = cat(spark, "T", "Métodos", "a", "Resultados", "b", "Métodos", "Referencias", "1. x")
    assert r.structure == ["Materiales y métodos", "Resultados", "Referencias"] and r.final_type == "Artículo original (inferido)"
    assert cat(spark, "T", "x").final_type == "Imagen / nota breve (inferido)"
    assert cat(spark, "T", *["x"] * 12).final_type == "Indeterminado"


def test_abstract(spark):
    r = cat(spark, "T", "Resumen", "Primera línea", "segunda.", "", "Palabras clave: a")
    assert r.abstract == "Primera línea segunda."
    assert cat(spark, "T", "Resumen", "x" * 130, "Palabras clave").abstract == "x" * 130
    assert cat(spark, "T", "corta", "otra", "Referencias", "y" * 300).abstract == "corta"
    assert cat(spark, "T", "corta", "z" * 170, "w" * 200).abstract == "z" * 170
    assert cat(spark, "Referencias", "T", "x").abstract == ""


def test_empty_and_null(spark):
    d = spark.createDataFrame([("", 1), (None, 2)], "text string, facts_ int")
    for r in catalog.catalogue(d).collect():
        assert r.title is None and r.structure == [] and r.nlines == 0 and r.abstract == ""
    assert catalog.catalogue(spark.createDataFrame([], "text string")).count() == 0


def test_pid_and_names(spark):
    d = spark.createDataFrame([("S1018-130X2004000000001",), ("Sx",), (None,)], "pid string")
    issn, year = catalog.pid_parts(F.col("pid"))
    got = [tuple(r) for r in d.select(issn, year, catalog.journal_name(issn)).collect()]
    assert got == [("1018-130X", "2004", "Revista Médica Herediana"), ("x", "?", "(revista no identificada)"), (None, "?", "(revista no identificada)")]


def test_cards(spark, rows):
    d = spark.createDataFrame([(f"p{i:04d}", f"T{i}\nIntroducción\nx") for i in range(1, 1203)], "pid string, text string").repartition(5)
    got = catalog.cards(catalog.catalogue(d)).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1203)) and got[1201].card.startswith("[1202] p1202\n") and "ESTRUCTURA: Introducción" in got[0].card
    text = "\n".join(r.card for r in got)
    back = spark.createDataFrame([(text,)], "t string").select(F.explode(catalogue_cards(F.col("t"))).alias("c")).select("c.*").collect()
    assert len(back) == 1202 and back[1100].pid == "p1101" and back[0].estructura == ["Introducción"] and back[0].titulo == "T1"
