"""Queries over the driver's tables, one for each operator, whole tables throughout; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.udfs import fold_exact, html_to_text, nfc
from ..operators import calls, catalog, chat, clean, entities, fetch, relational, relevance, responses, sampling
from ..session import shared_folder, spread
from ..streaming import incremental
from . import pipeline
from .oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(_t(spark, sf, "preanot").select(*columns))


def _shared(spark: SparkSession) -> str:
    """A new folder on the storage that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/tamiz-{spark.sparkContext._jvm.java.util.UUID.randomUUID()}"


# --- titles ---


@query
def keyword_relevance(spark, sf):
    return _t(spark, sf, "candidatos").select("pid", "titulo", relevance.relevance(F.col("titulo")).alias("clase"))


@query
def case_title_filter(spark, sf):
    return _t(spark, sf, "candidatos").where(relevance.is_case_report(F.col("titulo"), F.col("tipo_documento")) & (F.col("pid") != "")).select("pid", "titulo", "tipo_documento")


@query
def relevant_cases(spark, sf):
    c = _t(spark, sf, "candidatos").withColumn("clase", relevance.relevance(F.col("titulo")))
    kept = c.where(F.col("clase").isNotNull() & relevance.is_case_report(F.col("titulo"), F.col("tipo_documento")) & (F.col("pid") != ""))
    return relational.dedup(kept, "pid", [F.col("cosechado_en")]).select("pid", "clase", "anio", F.coalesce("idioma", F.lit("")).alias("idioma"))


@query
def fold_text(spark, sf):
    return _t(spark, sf, "candidatos").select("pid", T.fold(F.col("titulo")).alias("plegado"))


@query
def fold_text_exact(spark, sf):
    return _t(spark, sf, "candidatos").select("pid", fold_exact("titulo").alias("plegado"))


@query
def english_title(spark, sf):
    return _t(spark, sf, "candidatos").select("pid", "titulo", relevance.english_title(F.col("titulo")).alias("ingles"))


# --- keys and duplicates ---


@query
def dedup_first(spark, sf):
    return relational.dedup(_t(spark, sf, "candidatos"), "pid", [F.col("cosechado_en")]).select("pid", "titulo", F.col("cosechado_en").cast("string").alias("cosechado"))


@query
def dedup_last(spark, sf):
    return relational.dedup(_t(spark, sf, "candidatos"), "pid", [F.col("cosechado_en")], "last").select("pid", "titulo", F.col("cosechado_en").cast("string").alias("cosechado"))


@query
def latest_by_pid(spark, sf):
    return relational.dedup(_t(spark, sf, "preanot").select("pid", "anotado_en", "task_id"), "pid", [F.col("anotado_en"), F.col("task_id")], "last").select("pid", "task_id")


@query
def pending_anti(spark, sf):
    fetched = _t(spark, sf, "fetch_log").where("chars > 0")
    return relational.pending(_t(spark, sf, "candidatos").select("pid").distinct(), fetched, "pid")


@query
def approved_semi(spark, sf):
    ok = _t(spark, sf, "qc_deepseek").where(F.lower(F.trim("revisar")) == "no")
    return relational.approved(_t(spark, sf, "preanot").select("task_id", "pid"), ok, "pid")


@query
def missing_anti(spark, sf):
    ok = _t(spark, sf, "qc_deepseek").where(F.lower(F.trim("revisar")) == "no").select("pid").distinct()
    return relational.pending(ok, _t(spark, sf, "preanot"), "pid")


@query
def without_failed(spark, sf):
    done = (F.coalesce("error", F.lit("")) == "") & (F.coalesce("es_caso_oncologico", F.lit("")) != "")
    return relational.without_failed(_t(spark, sf, "qc_deepseek"), done, "pid").select("pid", "error")


@query
def text_with_candidate(spark, sf):
    """Left join of texts to candidates, the last harvest of a pid winning."""
    last = relational.dedup(_t(spark, sf, "candidatos"), "pid", [F.col("cosechado_en")], "last").select("pid", "titulo", "relevancia")
    return _t(spark, sf, "preanot").select("task_id", "pid").join(last, "pid", "left").select("task_id", "pid", F.coalesce("titulo", F.lit("")).alias("titulo"), F.coalesce("relevancia", F.lit("alta")).alias("relevancia"))


@query
def journal_lookup(spark, sf):
    issn, year = catalog.pid_parts(F.col("pid"))
    names = _t(spark, sf, "metas_revista").select("issn", F.col("journal").alias("revista"))
    return relational.lookup(_t(spark, sf, "seleccion_validacion").select("pid", issn.alias("issn"), year.alias("anio")), names, "issn", "revista", "(revista no identificada)")


@query
def journal_names(spark, sf):
    issn, _ = catalog.pid_parts(F.col("pid"))
    return _t(spark, sf, "candidatos").select("pid").distinct().select("pid", catalog.journal_name(issn).alias("revista"))


# --- counts ---


@query
def journal_counts(spark, sf):
    issn, _ = catalog.pid_parts(F.col("pid"))
    return (
        _t(spark, sf, "candidatos").groupBy(issn.alias("issn"))
        .agg(F.count(F.lit(1)).alias("filas"), F.countDistinct("pid").alias("pids"), F.count_if(F.trim("titulo") == "").alias("sin_titulo"), F.count_if(F.col("relevancia") == "alta").alias("alta"))
    )


@query
def year_range(spark, sf):
    _, year = catalog.pid_parts(F.col("pid"))
    return _t(spark, sf, "candidatos").agg(F.min(year).alias("primero"), F.max(year).alias("ultimo"), F.countDistinct(year).alias("anios"))


@query
def type_counts(spark, sf):
    """Counts in decreasing order, ties by name."""
    kind = F.coalesce("tipo_documento", F.lit("(ninguno)"))
    return _t(spark, sf, "candidatos").groupBy(kind.alias("tipo")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tipo")


@query
def motive_histogram(spark, sf):
    return relational.split_counts(_t(spark, sf, "qc_deepseek").distinct(), "motivos")


@query
def usage_totals(spark, sf):
    return _t(spark, sf, "usage_log").agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("prompt_tokens", "completion_tokens", "prompt_cache_hit_tokens", "prompt_cache_miss_tokens")), F.countDistinct("pid").alias("pids"))


@query
def fetch_lengths(spark, sf):
    return _t(spark, sf, "fetch_log").groupBy("fuente").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("chars"), 4).alias("media"))


@query
def word_stats_upper_median(spark, sf):
    return relational.upper_median(_t(spark, sf, "seleccion_validacion").dropDuplicates(), "palabras")


@query
def windowed_counts(spark, sf):
    return incremental.windowed_counts(_t(spark, sf, "events")).select(F.col("window_start").cast("string").alias("window_start"), "event_type", "n")


# --- texts and lines ---


@query
def word_count(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", T.word_count(F.col("text")).alias("palabras"))


@query
def line_explode(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", F.posexplode(T.lines(T.unix_lines(F.col("text")))).alias("i", "line")).select("task_id", (F.col("i") + 1).alias("line_no"), "line")


@query
def noise_lines(spark, sf):
    d = _texts(spark, sf, "task_id", "text").select("task_id", F.posexplode(T.split_lines(F.col("text"))).alias("i", "line")).withColumn("tipo", clean.noise_kind(F.col("line")))
    return d.where(F.col("tipo").isNotNull()).select("task_id", (F.col("i") + 1).alias("line_no"), "tipo")


@query
def line_cleanup(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", clean.line_cleanup(F.col("text")).alias("limpio"))


@query
def url_strip(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", clean.strip_urls(F.col("text")).alias("limpio"))


@query
def citation_strip(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", clean.strip_citations(F.col("text")).alias("limpio"))


@query
def whitespace_squeeze(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", clean.squeeze(F.col("text")).alias("limpio"))


@query
def inner_cleanup(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", clean.inner_cleanup(F.col("text")).alias("limpio"))


@query
def nfc_exact(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", nfc("text").alias("nfc"))


@query
def smart_trim(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", T.smart_trim(F.col("text")).alias("corto"))


@query
def looks_spanish(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", relevance.looks_spanish(F.col("text")).alias("espanol"))


@query
def english_body(spark, sf):
    return _texts(spark, sf, "task_id", "text").select("task_id", relevance.english_body(F.col("text")).alias("ingles"))


@query
def flex_find(spark, sf):
    """Where the selected title stands in its text, with any white space between its words."""
    titles = _t(spark, sf, "seleccion_validacion").where("titulo is not null").groupBy("pid").agg(F.min("titulo").alias("titulo"))
    return _t(spark, sf, "preanot").join(titles, "pid").select("task_id", T.flexible_find(F.col("text"), F.col("titulo")).alias("lugar"))


# --- catalogue ---


@query
def section_detect(spark, sf):
    d = _texts(spark, sf, "task_id", "text").select("task_id", F.posexplode(T.lines(T.unix_lines(F.col("text")))).alias("i", "line"))
    return d.select("task_id", (F.col("i") + 1).alias("line_no"), catalog.section_of(F.col("line")).alias("seccion")).where(F.col("seccion").isNotNull())


@query
def type_detect(spark, sf):
    d = _texts(spark, sf, "task_id", "text").select("task_id", F.posexplode(T.lines(T.unix_lines(F.col("text")))).alias("i", "line"))
    return d.select("task_id", (F.col("i") + 1).alias("line_no"), catalog.type_of_canon(T.canon(F.col("line"))).alias("tipo")).where(F.col("tipo").isNotNull())


@query
def ordered_sections(spark, sf):
    return catalog.catalogue(_texts(spark, sf, "task_id", "text")).select("task_id", F.array_join("structure", " › ").alias("estructura"))


@query
def header_block(spark, sf):
    return catalog.catalogue(_texts(spark, sf, "task_id", "text")).select("task_id", F.col("voldate").alias("volumen"), F.col("type").alias("tipo"), F.col("title").alias("titulo"))


@query
def final_type(spark, sf):
    return catalog.catalogue(_texts(spark, sf, "task_id", "text")).select("task_id", F.col("final_type").alias("tipo"), F.col("nlines").alias("lineas"))


@query
def abstract_extract(spark, sf):
    return catalog.catalogue(_texts(spark, sf, "task_id", "text")).select("task_id", F.col("abstract").alias("resumen"))


@query
def catalog_cards(spark, sf):
    return catalog.cards(catalog.catalogue(_t(spark, sf, "preanot").select(F.col("task_id").cast("string").alias("pid"), "text")))


@query
def decision_ladder(spark, sf):
    """The first rule that a text meets, by language and sections."""
    d = catalog.catalogue(_texts(spark, sf, "task_id", "text"))
    return d.select("task_id", pipeline.decision(F.col("title"), F.col("text"), F.col("structure")).alias("decision"))


@query
def decision_counts(spark, sf):
    return decision_ladder(spark, sf).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@query
def prompt_build(spark, sf):
    return _t(spark, sf, "preanot").select("task_id", F.md5(responses.prompt(F.col("text"), "Clasifica:\n{text}\nFin")).alias("huella"), F.length(responses.prompt(F.col("text"), "{text}", 100)).alias("largo"))


# --- boundaries ---


def _bounded(spark, sf):
    return clean.core(_texts(spark, sf, "task_id", "text"))


@query
def boundary_start(spark, sf):
    return _bounded(spark, sf).select("task_id", F.col("start_label").alias("inicio"), F.col("start").alias("lugar"))


@query
def boundary_end(spark, sf):
    return _bounded(spark, sf).select("task_id", F.col("end_label").alias("fin"), F.col("end").alias("lugar"))


@query
def core_slice(spark, sf):
    return _bounded(spark, sf).select("task_id", "core")


@query
def cut_safeguard(spark, sf):
    return _bounded(spark, sf).select("task_id", clean.safeguarded(F.col("text"), F.col("core")).alias("texto"))


@query
def cut_apply(spark, sf):
    """The cut from a text's own words 21 to 24 to its last heading of references."""
    d = _t(spark, sf, "preanot").where("text is not null").select("task_id", "text")
    words = F.filter(F.split(T.strip(F.col("text")), f"{T.WS}+"), lambda w: w != "")
    return d.select("task_id", clean.apply_cut(F.col("text"), F.array_join(F.slice(words, 21, 4), " "), F.lit("Referencias")).alias("texto"))


# --- samples ---


def _pool(spark, sf):
    issn, _ = catalog.pid_parts(F.col("pid"))
    return _t(spark, sf, "seleccion_validacion").where("pid is not null").groupBy("pid").agg(F.max("palabras").alias("palabras")).select("pid", issn.alias("stratum"), "palabras")


def _quotas(spark, sf, n=120):
    return sampling.allocate(_pool(spark, sf).groupBy("stratum").agg(F.count(F.lit(1)).alias("size")), n)


@query
def eligible_by_journal(spark, sf):
    """Texts of at least 150 words by journal: words counted in the text, relevance from the title."""
    issn, _ = catalog.pid_parts(F.col("pid"))
    texts = _t(spark, sf, "preanot").withColumn("n", T.word_count(F.col("text"))).where("n >= 150").select("pid", "n")
    cand = relational.dedup(_t(spark, sf, "candidatos"), "pid", [F.col("cosechado_en")], "last").select("pid", relevance.relevance(F.col("titulo")).alias("clase"))
    d = texts.join(cand, "pid", "left").where(F.coalesce("clase", F.lit("alta")) == "alta")
    return d.groupBy(issn.alias("issn")).agg(F.count(F.lit(1)).alias("textos"), F.sum("n").alias("palabras"))


@query
def alloc_largest_remainder(spark, sf):
    return _quotas(spark, sf)


@query
def stratified_draw(spark, sf):
    return sampling.draw(_pool(spark, sf), _quotas(spark, sf), "pid").select("pid", "stratum")


@query
def reserve_anti(spark, sf):
    pool = _pool(spark, sf)
    return sampling.reserve(pool, sampling.draw(pool, _quotas(spark, sf), "pid"), "pid").select("pid", "stratum")


# --- answers of a model ---


def _answers(spark, sf):
    """The triage rows as the texts in which a model gave them: fenced JSON with words around it, and nothing for failed calls."""
    b = lambda c: F.coalesce(F.when(responses.flag(F.col(c)), "true").when(~responses.flag(F.col(c)), "false"), F.lit("null"))
    s = lambda c: F.coalesce(F.concat(F.lit('"'), F.translate(c, '"\\\n', "   "), F.lit('"')), F.lit("null"))
    body = F.concat(
        F.lit('{"es_caso_oncologico": '), b("es_caso_oncologico"), F.lit(', "es_paciente_humano": '), b("es_paciente_humano"), F.lit(', "idioma_cuerpo": '), s("idioma_cuerpo"),
        F.lit(', "tiene_narrativa_paciente": '), b("tiene_narrativa_paciente"), F.lit(', "calidad_recorte": '), s("calidad_recorte"), F.lit(', "confianza": '), s("confianza"), F.lit("}"),
    )
    text = F.when(F.coalesce("error", F.lit("")) != "", None).otherwise(F.concat(F.lit("Claro:\n```json\n"), body, F.lit("\n```\nListo.")))
    return _t(spark, sf, "qc_deepseek").distinct().select("pid", text.alias("content"))


@query
def qc_json_parse(spark, sf):
    return _answers(spark, sf).select("pid", responses.parse(F.col("content")).alias("r")).select("pid", "r.es_caso_oncologico", "r.es_paciente_humano", "r.idioma_cuerpo", "r.calidad_recorte", "r.confianza")


@query
def review_reasons(spark, sf):
    r = _answers(spark, sf).select("pid", responses.parse(F.col("content")).alias("r"))
    bad_crop = ~F.coalesce("r.calidad_recorte", F.lit("")).isin("limpio", "")
    rules = [
        (F.col("r").isNull(), "sin_respuesta"), (F.col("r.es_caso_oncologico") == F.lit(False), "no_caso"), (F.col("r.es_paciente_humano") == F.lit(False), "no_humano"),
        (F.col("r.idioma_cuerpo").isin("en", "mixto"), F.concat(F.lit("idioma_"), F.col("r.idioma_cuerpo"))), (F.col("r.tiene_narrativa_paciente") == F.lit(False), "sin_narrativa"),
        (F.col("r").isNotNull() & bad_crop, F.concat(F.lit("recorte_"), F.col("r.calidad_recorte"))), (F.try_to_number(F.col("r.confianza"), F.lit("9.99")) < 0.6, "baja_confianza"),
    ]
    return r.select("pid", responses.reasons(rules).alias("motivos"))


@query
def json_rescue(spark, sf):
    """Entities of answers that were cut after 60 % of their characters."""
    e = _t(spark, sf, "preanot").where(F.size("entidades") > 0).select("task_id", F.to_json(F.struct(F.col("entidades"))).alias("j"))
    cut = F.substring(F.col("j"), F.lit(1), F.expr("length(j) * 6 div 10").cast("int"))
    return e.select("task_id", F.posexplode(responses.rescued(cut)).alias("ord", "e")).select("task_id", "ord", F.col("e.texto").alias("texto"), F.col("e.categoria").alias("categoria"))


# --- entities ---


@query
def entity_counts(spark, sf):
    return entities.valid_mentions(_texts(spark, sf, "task_id", "text", "entidades")).groupBy("task_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def mention_offsets(spark, sf):
    return entities.mention_offsets(_texts(spark, sf, "task_id", "text", "entidades"))


@query
def annotation_tasks(spark, sf):
    p = _t(spark, sf, "preanot").where("text is not null")
    return entities.annotation_tasks(entities.mention_offsets(p), p, F.coalesce("modelo", F.lit("")))


# --- outside calls and incremental runs ---


@query
def html_text(spark, sf):
    """Every text; those with markup as the text of their paragraphs."""
    page = F.contains("text", F.lit("</"))
    d = _texts(spark, sf, "task_id", "text").select("task_id", "text", page.alias("page"), html_to_text(F.when(page, F.col("text"))).alias("r"))
    return d.select("task_id", F.when(F.col("page"), F.col("r.fuente")).otherwise("texto").alias("fuente"), F.when(F.col("page"), F.col("r.texto")).otherwise(F.col("text")).alias("texto"))


def _fake_client():
    """A service that is overloaded at the first try of each request and refuses those that end in 7."""
    tried: dict[str, int] = {}

    def client(request: str) -> tuple[int, str, dict]:
        tried[request] = tried.get(request, 0) + 1
        if request.endswith("7"):
            return 403, "", {}
        return (200, f"ok {request}", {}) if tried[request] > 1 else (503, "", {})

    return client


@query
def llm_retry(spark, sf):
    requests = _t(spark, sf, "candidatos").select("pid").distinct().withColumn("request", F.col("pid"))
    return calls.call_all(requests, _fake_client, pace=0.0, first=0.0)


@query
def incremental_append(spark, sf):
    """Candidates appended by a stream, each pid once, run twice: the second run finds nothing new."""
    out = _shared(spark)
    schema = _t(spark, sf, "candidatos").schema
    source = f"{sf}/candidatos.parquet"
    if Path(source).is_file():  # a stream reads folders
        source, glob = sf, "candidatos.parquet"
    else:
        glob = "*.parquet"
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source)
        incremental.append_stream(stream, f"{out}/rows", f"{out}/state", "pid", lambda d: d.select("pid")).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _fake_lookup():
    """A service that has its own copy of the articles with an even last digit and fails for those with a 5."""

    def lookup(pid: str) -> str | None:
        if pid.endswith("5"):
            raise TimeoutError
        return "<html>" + "b" * 300 if pid[-1] in "02468" else "b" * 50

    return lookup


def _fake_get():
    """A site that is gone for articles whose address ends in 1, and answers 404 for those that end in 3."""

    def get(url: str) -> tuple[int, str]:
        if url.endswith("1"):
            raise ConnectionError
        return (404, "") if url.endswith("3") else (200, "<p>corto</p>" + f"<p>{'a' * 100}</p>" * 6)

    return get


@query
def fetch_statuses(spark, sf):
    """Bodies of all candidates by pid: fetched before, from the service, from the page, or the reason why there is none."""
    have = _t(spark, sf, "fetch_log").where("chars > 0").select("pid", "chars")
    return fetch.fetch_bodies(_t(spark, sf, "candidatos").select("pid", "html_url"), have, _fake_lookup, _fake_get, pace=0.0).select("pid", "fuente", "chars")


@query
def chat_usage(spark, sf):
    """Calls and tokens of answers that hold the counts of usage_log; every seventh character code of a pid without content."""
    counts = F.struct(*(F.col(c) for c in chat.USAGE))
    empty = F.col("pid").endswith("7")
    body = F.struct(F.array(F.struct(F.struct(F.when(empty, "").otherwise("{}").alias("content")).alias("message"))).alias("choices"), counts.alias("usage"))
    called = _t(spark, sf, "usage_log").select("pid", F.when(F.col("pid").endswith("9"), "no es json").otherwise(F.to_json(body)).alias("response"), F.lit("").alias("error"))
    return chat.usage(chat.answers(called))


@query
def cut_answer(spark, sf):
    """A model's cut from a text's own words 21 to 24 to its heading of references; every third text without answer."""
    d = _t(spark, sf, "preanot").where("text is not null").select("task_id", "text")
    words = F.filter(F.split(T.strip(F.col("text")), f"{T.WS}+"), lambda w: w != "")
    said = F.to_json(F.struct(F.lit(True).alias("inicio_basura"), F.array_join(F.slice(words, 21, 4), " ").alias("frag_inicio_contenido"), (F.col("task_id") % 2 == 0).alias("fin_basura"), F.lit(" Referencias ").alias("frag_inicio_basura_final")))
    answer = responses.parse(F.when(F.col("task_id") % 3 != 0, said), clean.CUT)
    return d.select("task_id", clean.apply_answer(F.col("text"), answer).alias("r")).select("task_id", F.col("r.text").alias("texto"), F.col("r.kept").alias("conservado"))


@query
def decision_reasons(spark, sf):
    d = catalog.catalogue(_texts(spark, sf, "task_id", "text"))
    return d.select("task_id", pipeline.decision_reason(F.col("title"), F.col("text"), F.col("structure")).alias("r")).select("task_id", "r.decision", "r.motivo")


@query
def eligible_drops(spark, sf):
    """How many texts lack relevance or words, and how many stay."""
    d = pipeline.eligible(_texts(spark, sf, "pid", "text"), _t(spark, sf, "candidatos"))
    return d.groupBy(F.coalesce("dropped", F.lit("-")).alias("motivo")).agg(F.count(F.lit(1)).alias("n"))


@query
def review_flags(spark, sf):
    """Reasons to look at a text, how often each set of them is given, and whether it flags."""
    r = _answers(spark, sf).select(responses.review(responses.parse(F.col("content"))).alias("r"))
    return r.groupBy(F.col("r.flagged").alias("revisar"), F.col("r.motivos").alias("motivos")).agg(F.count(F.lit(1)).alias("n"))


@query
def year_counts(spark, sf):
    _, year = catalog.pid_parts(F.col("pid"))
    return _t(spark, sf, "candidatos").groupBy(year.alias("anio")).agg(F.count(F.lit(1)).alias("n")).orderBy("anio")


@query
def first_pending(spark, sf):
    """Of the first 100 pids those that no answer has approved yet."""
    done = _t(spark, sf, "qc_deepseek").where(F.lower(F.trim("revisar")) == "no")
    return relational.first_pending(_t(spark, sf, "preanot").select("pid").where("pid is not null").distinct(), done, "pid", 100)


@query
def missing_capped(spark, sf):
    """How many candidates were never fetched, and the first ten of them."""
    return relational.capped(pending_anti(spark, sf), "pid", 10).select("n", F.array_join("shown", ";").alias("primeros"), "more")


@query
def catalog_report(spark, sf):
    cat = catalog.catalogue(_t(spark, sf, "preanot").select(F.col("task_id").cast("string").alias("pid"), "text"))
    return catalog.report(cat).where("part < 3")
