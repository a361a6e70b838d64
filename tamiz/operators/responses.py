"""Answers of a language model as text: salvage, typed fields, review reasons, and rescue of answers cut in the middle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANSWER = "es_caso_oncologico boolean, es_paciente_humano boolean, idioma_cuerpo string, tipo_cancer string, tiene_narrativa_paciente boolean, calidad_recorte string, confianza string, problemas string"
_STRING = r'"((?:[^"\\]|\\.)*)"'


def salvage(content: Column) -> Column:
    """The JSON object in an answer, from its first to its last brace, without fences; null if it does not parse."""
    body = F.regexp_extract(content, r"(?s)\{.*\}", 0)
    return F.when((body != "") & F.try_parse_json(body).isNotNull(), body)


def parse(content: Column, schema: str = ANSWER) -> Column:
    """The fields of an answer; an empty object counts as no answer and gives null."""
    j = salvage(content)
    return F.when(j.isNotNull() & (F.json_object_keys(j).isNotNull()) & (F.size(F.json_object_keys(j)) > 0), F.from_json(j, schema))


def rescued(content: Column, first: str = "texto", second: str = "categoria") -> Column:
    """The complete {first, second} objects of an answer that was cut, as an array of structs; escapes stay as they are."""
    pattern = rf'\{{\s*"{first}"\s*:\s*{_STRING}\s*,\s*"{second}"\s*:\s*{_STRING}\s*\}}'
    a, b = (F.regexp_extract_all(content, F.lit(pattern), F.lit(i)) for i in (1, 2))
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: F.struct(x.a.alias(first), x.b.alias(second)))


def flag(value: Column) -> Column:
    """A boolean from its usual spellings, null from any other."""
    v = F.lower(F.trim(value))
    return F.when(v.isin("true", "si", "sí", "1"), True).when(v.isin("false", "no", "0"), False)


def reasons(rules: list[tuple[Column, str | Column]]) -> Column:
    """The names of the rules that hold, in their order, joined by semicolons; a rule that is null does not hold."""
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(n) if isinstance(n, str) else n) for c, n in rules))), ";")


def first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    """The name of the first rule that holds."""
    out = F.when(rules[0][0], rules[0][1])
    for c, n in rules[1:]:
        out = out.when(c, n)
    return out.otherwise(default)


def prompt(text: Column, template: str, most: int = 60_000) -> Column:
    """A request: the template with a text's first ``most`` characters in place of ``{text}``; null for a null text."""
    before, _, after = template.partition("{text}")
    return F.concat(F.lit(before), F.substring(text, 1, most), F.lit(after))


def review(answer: Column) -> Column:
    """A struct (flagged, motivos): what a triage answer (a struct of ANSWER) gives reason to look at; a null answer is flagged.

    A confidence that is no number gives no reason.
    """
    crop = F.coalesce(answer.getField("calidad_recorte"), F.lit(""))
    why = reasons([
        (answer.getField("es_caso_oncologico") == F.lit(False), "no_es_caso_oncologico"), (answer.getField("es_paciente_humano") == F.lit(False), "no_humano"),
        (answer.getField("idioma_cuerpo").isin("en", "mixto"), F.concat(F.lit("idioma_"), answer.getField("idioma_cuerpo"))), (answer.getField("tiene_narrativa_paciente") == F.lit(False), "sin_narrativa_paciente"),
        (~crop.isin("limpio", ""), F.concat(F.lit("recorte_"), crop)), (answer.getField("confianza").try_cast("double") < 0.6, "baja_confianza"),
    ])
    lost = F.struct(F.lit(True).alias("flagged"), F.lit("sin_respuesta_del_modelo").alias("motivos"))
    return F.when(answer.isNull(), lost).otherwise(F.struct((why != "").alias("flagged"), why.alias("motivos")))
