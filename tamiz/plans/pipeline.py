"""The whole chain as DataFrames: harvest, catalogue, filter, trim, sample, and tasks for annotation. Each step is lazy.

Steps with calls to outside services are split: requests are made here, ``operators.calls`` sends them, and their written answers are
read by the next step, so that a retry never sends a request twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..functions.udfs import html_to_text
from ..operators import catalog, clean, entities, relational, relevance, responses, sampling
from ..session import cut


@dataclass(frozen=True)
class Settings:
    least_words: int = 150
    sample: int = 120
    seed: int = 42
    prompt_characters: int = 60_000
    with_abstract: bool = False


def harvest(articles: DataFrame, known: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """New candidates: relevant case reports with a pid that is not known yet, each once, the first by url winning."""
    abstract = F.col("resumen") if settings.with_abstract else None
    d = articles.withColumn("relevancia", relevance.relevance(F.col("titulo"), abstract))
    d = d.where(F.col("relevancia").isNotNull() & relevance.is_case_report(F.col("titulo"), F.col("tipo_documento")) & (F.coalesce("pid", F.lit("")) != ""))
    d = relational.dedup(d.drop("resumen"), "pid", [F.col("html_url")])
    return relational.pending(d, known, "pid").select("pid", "titulo", "relevancia", "tipo_documento", "anio", "idioma", "licencia", "html_url")


def decision(title: Column, text: Column, structure: Column) -> Column:
    """What becomes of a text, by its language and sections: the first rule that holds."""
    return decision_reason(title, text, structure).decision


def decision_reason(title: Column, text: Column, structure: Column, first: tuple[tuple[Column, str, str], ...] = (), last: tuple[tuple[Column, str, str], ...] = ()) -> Column:
    """A struct (decision, motivo) by the first rule that holds; ``first`` and ``last`` are rules (condition, decision, reason) around the own ones."""
    useful = F.arrays_overlap(structure, F.array(F.lit("Introducción"), F.lit("Caso clínico")))
    rules = (
        *first, (relevance.english_title(title) | relevance.english_body(text), "DESCARTADO", "cuerpo en ingles (bilingue)"),
        (~F.coalesce(useful, F.lit(False)), "REVISAR", "sin Introduccion/Caso clinico rotulado"), *last,
    )
    named = lambda d, m: F.struct(F.lit(d).alias("decision"), F.lit(m).alias("motivo"))
    out = F.when(rules[0][0], named(*rules[0][1:]))
    for condition, d, m in rules[1:]:
        out = out.when(condition, named(d, m))
    return out.otherwise(named("SELECCIONADO", ""))


def eligible(texts: DataFrame, candidates: DataFrame, settings: Settings = Settings(), with_medium: bool = False) -> DataFrame:
    """texts (pid, text) with relevancia, palabras and ``dropped``: null, 'relevancia' or 'palabras'.

    A pid without candidate counts as 'alta'; without any candidate relevance drops nothing. The last candidate row of a pid counts.
    """
    last = relational.dedup(candidates.select("pid", "relevancia", "cosechado_en"), "pid", [F.col("cosechado_en")], "last").select("pid", F.coalesce("relevancia", F.lit("")).alias("relevancia"))
    none = candidates.limit(1).agg((F.count(F.lit(1)) == 0).alias("_none"))  # one row
    wanted = F.array_union(F.array(F.lit("alta")), F.array(F.lit("media")) if with_medium else F.array().cast("array<string>"))
    d = texts.join(last, "pid", "left").join(F.broadcast(none)).withColumn("relevancia", F.coalesce("relevancia", F.lit("alta"))).withColumn("palabras", word_count(F.coalesce("text", F.lit(""))))
    dropped = F.when(~F.col("_none") & ~F.array_contains(wanted, F.col("relevancia")), "relevancia").when(F.col("palabras") < settings.least_words, "palabras")
    return d.withColumn("dropped", dropped).drop("_none")


def curate(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """texts (pid, text) with their catalogue columns, decision, boundaries and core. A title of the text wins over the candidate's."""
    last = candidates.select("pid", F.col("titulo").alias("_t"))
    page = F.contains("text", F.lit("</"))  # a page as it was fetched; others do not cross to Python
    texts = texts.withColumn("_h", html_to_text(F.when(page, F.col("text")))).withColumn("text", F.when(page & (F.col("_h.texto") != ""), F.col("_h.texto")).otherwise(F.col("text"))).drop("_h")
    d = catalog.catalogue(texts).join(last, "pid", "left").withColumn("title", F.coalesce("title", F.nullif("_t", F.lit("")))).drop("_t")
    return clean.core(d.withColumn("decision", decision(F.col("title"), F.col("text"), F.col("structure"))))


def sample(curated: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(drawn, reserve) of the selected texts with enough words, in proportion to their journals."""
    issn, _ = catalog.pid_parts(F.col("pid"))
    pool = curated.where((F.col("decision") == "SELECCIONADO") & (word_count(F.col("core")) >= settings.least_words)).select("pid", issn.alias("stratum"), word_count(F.col("core")).alias("palabras"))
    pool = cut(pool)  # the draw reads it several times
    quotas = sampling.allocate(pool.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")), settings.sample)
    drawn = sampling.draw(pool, quotas, "pid", seed=settings.seed)
    return drawn, sampling.reserve(pool, drawn, "pid")


def requests(texts: DataFrame, done: DataFrame, template: str, settings: Settings = Settings()) -> DataFrame:
    """(pid, request) of the texts without an answer yet; the template's ``{text}`` becomes the text's first characters."""
    return relational.pending(texts.select("pid", responses.prompt(F.col("text"), template, settings.prompt_characters).alias("request")), done, "pid")


def mentions(texts: DataFrame, answers: DataFrame, model: str) -> DataFrame:
    """(pid, task): annotation tasks from texts and the written answers (pid, response), whole or cut."""
    parsed = F.from_json(responses.salvage(F.col("response")), "entidades array<struct<texto:string,categoria:string>>").entidades
    d = texts.select("pid", "text").join(answers.select("pid", F.coalesce(parsed, responses.rescued(F.col("response"))).alias("entidades")), "pid")
    return entities.annotation_tasks(entities.mention_offsets(d, key="pid"), d.withColumn("p", F.col("pid")), F.lit(model), key="pid", pid="p")
