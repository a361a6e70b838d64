"""Queries of the training-data operators, over whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from . import density, encoding, language, leakage, lines, mixing, quality, quota, spam, truncation
from .common import cut, table

def _tasks(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf, "preanot").select("task_id", *columns, "text"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "source", "text"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return lines.repeated_lines(_tasks(spark, sf, "pid"), exact=True).select("task_id", "line_no").distinct()


def p1_clean(spark: SparkSession, sf: str) -> DataFrame:
    texts = _tasks(spark, sf, "pid")
    return lines.without_lines(texts, lines.repeated_lines(texts).select("task_id", "line_no"))


def _p2(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    pool = cut(quota.units(table(spark, sf, "seleccion_validacion")))
    return pool, quota.needs(pool, table(spark, sf, "metas_revista"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_report(spark, sf).where("missing > 0").select("issn")


def p2_sample(spark: SparkSession, sf: str) -> DataFrame:
    return quota.quota_sample(*_p2(spark, sf))


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    pool, wanted = _p2(spark, sf)
    return quota.quota_report(quota.quota_sample(pool, wanted), wanted)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return density.page_parts(_tasks(spark, sf, "pid"))


def p3_main(spark: SparkSession, sf: str) -> DataFrame:
    return density.main_content(_tasks(spark, sf, "pid"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_prose(_tasks(spark, sf)).select("task_id")


def p4_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_statistics(_tasks(spark, sf))


def p4_scores(spark: SparkSession, sf: str) -> DataFrame:
    return quality.outlier_scores(cut(quality.text_statistics(_tasks(spark, sf)))).select("task_id", "score", "unprose")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.endings(_tasks(spark, sf, "pid")).where("verdict = 'cut'").select("task_id")


def p5_sources(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.source_rates(truncation.endings(_tasks(spark, sf, "pid")), table(spark, sf, "qc_deepseek"))


def _p6(spark: SparkSession, sf: str) -> DataFrame:
    tasks = encoding.texts_of("preanot", _tasks(spark, sf), F.col("task_id"), F.col("text"))
    return tasks.unionByName(encoding.texts_of("candidatos", table(spark, sf, "candidatos"), F.col("pid"), F.col("titulo")))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.garbled(_p6(spark, sf))


def p6_restored(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.restored(_p6(spark, sf))


def _p7(spark: SparkSession, sf: str) -> DataFrame:
    return language.languages(_tasks(spark, sf, "pid"), language.fit(table(spark, sf, "preanot")))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.wrong_labels(cut(_p7(spark, sf)), table(spark, sf, "candidatos"), table(spark, sf, "qc_deepseek"))


def p7_languages(spark: SparkSession, sf: str) -> DataFrame:
    return _p7(spark, sf)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(_documents(spark, sf), table(spark, sf, "eval_items")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.item_report(leakage.leaks(_documents(spark, sf), table(spark, sf, "eval_items")))


def p8_near(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.proximity(_documents(spark, sf), table(spark, sf, "eval_items"))


def _tokenizer(spark: SparkSession) -> str:
    """The vocabulary file of a public tokenizer, on a path that every executor has; spark.tamiz.tokenizer names another one."""
    return spark.conf.get("spark.tamiz.tokenizer", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def _p9(spark: SparkSession, sf: str, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    sizes, targets = cut(mixing.sized(_documents(spark, sf), tokenizer=tokenizer)), table(spark, sf, "mezcla_metas")
    return mixing.curriculum(sizes, targets), mixing.plan(sizes, targets)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(*_p9(spark, sf)).where("short").select("source")


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _p9(spark, sf, _tokenizer(spark))[0]


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    mix, planned = _p9(spark, sf, _tokenizer(spark))
    return mixing.shares(cut(mix), planned).drop("short")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The report in blank-separated words."""
    mix, planned = _p9(spark, sf)
    return mixing.shares(cut(mix), planned).drop("short")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return spam.spam(_documents(spark, sf)).select("doc_id").distinct()


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    return spam.scores(_documents(spark, sf)).select("doc_id", "bits", F.round("centre", 4).alias("centre"), F.round("spread", 4).alias("spread"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            p1_found, p1_clean, p2_found, p2_sample, p2_report, p3_found, p3_main, p4_found, p4_statistics, p4_scores, p5_found, p5_sources,
            p6_found, p6_restored, p7_found, p7_languages, p8_found, p8_items, p8_near, p9_found, p9_mix, p9_report, p9_shares, p10_found, p10_scores,
        )
    }


_P2 = """
WITH pool AS (
  SELECT pid, coalesce(min(CASE WHEN regexp_full_match(upper(regexp_replace(issn, '[^0-9Xx]', '', 'g')), '[0-9]{7}[0-9X]')
    THEN left(upper(regexp_replace(issn, '[^0-9Xx]', '', 'g')), 4) || '-' || right(upper(regexp_replace(issn, '[^0-9Xx]', '', 'g')), 4) END),
    substring(pid, 2, 9)) AS issn
  FROM seleccion_validacion WHERE pid IS NOT NULL GROUP BY pid),
n AS (SELECT count(*) // 4 AS n FROM pool),
seen AS (SELECT issn, count(*) AS observed FROM pool GROUP BY issn),
need AS (
  SELECT m.issn, greatest(minimo, (meta_pm * n.n + 999) // 1000)::BIGINT AS need, coalesce(observed, 0)::BIGINT AS observed
  FROM metas_revista m CROSS JOIN n LEFT JOIN seen USING (issn)),
got AS (SELECT *, least(need, observed) AS sampled FROM need)
"""

_P8 = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(strip_accents(texto)), '[\\p{L}\\p{N}]+') AS w FROM eval_items WHERE texto IS NOT NULL),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM d)),
iw AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS p FROM i))
"""


_P9 = """
WITH d AS (SELECT doc_id, lower(trim(source)) AS source, len(regexp_extract_all(text, '\\S+')) AS size FROM documents WHERE text IS NOT NULL AND trim(source) <> ''),
s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
goal AS (SELECT lower(trim(m.source)) AS source, peso_pm, max_repeticiones AS max_rep, coalesce(s.size, 0) AS size, (SELECT sum(size)::BIGINT FROM s) AS total
  FROM mezcla_metas m LEFT JOIN s ON s.source = lower(trim(m.source)))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": """
WITH l AS (
  SELECT task_id, pid, substring(pid, 2, 9) AS j, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n
  FROM preanot WHERE text IS NOT NULL AND pid IS NOT NULL),
s AS (SELECT task_id, pid, j, n, regexp_replace(lower(strip_accents(line)), '[^\\p{L}\\p{N}]', '', 'g') AS k FROM l),
c AS (SELECT j, k, count(DISTINCT pid) AS c FROM s WHERE length(k) >= 30 GROUP BY j, k),
t AS (SELECT substring(pid, 2, 9) AS j, count(DISTINCT pid) AS t FROM preanot WHERE pid IS NOT NULL GROUP BY 1)
SELECT DISTINCT task_id, n::INT AS line_no FROM s JOIN c USING (j, k) JOIN t USING (j) WHERE c >= 5 AND c * 1000 >= t * 50
""",
        "p2_found": _P2 + "SELECT issn FROM got WHERE sampled < need",
        "p2_report": _P2
        + """SELECT issn, need, observed, sampled, need - sampled AS missing,
  round(sampled * 1000 / greatest((SELECT sum(sampled) FROM got), 1), 2) AS share_pm FROM got""",
        "p8_found": _P8 + "SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (g)",
        "p8_items": _P8
        + """, r AS (
  SELECT DISTINCT doc_id, item_id, dp - ip AS shift, ip FROM
    (SELECT doc_id, unnest(range(1, len(w) - 10)) AS dp, w AS dv FROM d) a
    JOIN (SELECT item_id, unnest(range(1, len(w) - 10)) AS ip, w AS iv FROM i) b ON array_to_string(dv[dp:dp + 11], ' ') = array_to_string(iv[ip:ip + 11], ' ')),
g AS (SELECT *, ip - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY ip) AS island FROM r),
m AS (SELECT doc_id, item_id, count(*) + 11 AS words FROM g GROUP BY doc_id, item_id, shift, island)
SELECT item_id, count(DISTINCT doc_id) AS documents, max(words)::INT AS longest FROM m GROUP BY item_id""",
        "p9_found": _P9 + "SELECT source FROM goal WHERE size * max_rep * 2000 < peso_pm * total",
        "p9_shares": _P9
        + """, used AS (SELECT *, peso_pm * total / 2000.0 AS demand, least(peso_pm * total / 2000.0, size * max_rep) AS used FROM goal),
laid AS (SELECT u.source, used, d.size, rep, sum(d.size) OVER (PARTITION BY u.source ORDER BY rep, md5('42:' || rep || ':' || doc_id), doc_id) - d.size AS before
  FROM used u JOIN d USING (source), unnest(range(1, greatest(least(max_rep, ceil(used / greatest(u.size, 1))), 0)::INT + 1)) AS r(rep) WHERE d.size > 0),
mix AS (SELECT source, sum(size) AS placed, max(rep) AS repetitions FROM laid WHERE before < used GROUP BY source)
SELECT source, peso_pm, coalesce(placed, 0)::BIGINT AS size, round(coalesce(placed, 0) * 1000 / (SELECT sum(placed) FROM mix), 2) AS share_pm, coalesce(repetitions, 0)::INT AS repetitions,
  round(greatest(demand - coalesce(placed, 0), 0), 3) AS deficit FROM used LEFT JOIN mix USING (source)""",
    }
