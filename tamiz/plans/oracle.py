"""The queries in DuckDB's SQL, written from the semantics, with windows and lists of that engine rather than the Spark expressions."""

from __future__ import annotations

import unicodedata

from ..functions import dictionaries as D
from ..functions.text import FOLD_FROM, FOLD_TO, WS

NWS = "[^" + WS[1:]
_CANON_FROM = "".join(c for c in FOLD_FROM if unicodedata.normalize("NFD", c) != c)
_CANON_TO = "".join(FOLD_TO[FOLD_FROM.index(c)] for c in _CANON_FROM)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_q, r)) + ")" for r in rows)


def fold(x: str) -> str:
    return f"lower(regexp_replace(translate(coalesce({x}, ''), {_q(FOLD_FROM)}, {_q(FOLD_TO)}), '\\p{{M}}+', '', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def canon(x: str) -> str:
    return f"upper({strip(f"regexp_replace(translate(coalesce({x}, ''), {_q(_CANON_FROM)}, {_q(_CANON_TO)}), '\\p{{Mn}}+', '', 'g')")})"


def unix(x: str) -> str:
    return f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"


def _lines(x: str, name: str = "l", source: str = "preanot", key: str = "task_id") -> str:
    """A CTE of (key, n, line) of the lines without the empty one after a last line end."""
    body = f"regexp_replace({x}, '\\n$', '')"
    return f"""{name}s AS (SELECT {key}, string_split({body}, chr(10)) AS ls FROM {source} WHERE text IS NOT NULL AND text <> ''),
{name} AS (SELECT {key}, unnest(range(1, len(ls) + 1))::INT AS n, unnest(ls) AS line FROM {name}s)"""


_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_CAP = D.CAPTIONS.replace("(", "(?:", 1)


def _noise(line: str) -> str:
    s = strip(line)
    return f"""CASE WHEN {s} = '' THEN NULL WHEN {strip(fold(line))} IN ({", ".join(map(_q, D.SITE_NOISE))}) THEN 'sitio'
 WHEN regexp_matches({s}, '^{_CAP}{WS}*(?:n[°º.\\s]|[0-9]|:)', 'i') THEN 'leyenda'
 WHEN regexp_matches({s}, '\\bissn\\b|versi[oó]n{WS}+(?:impresa|on-?line)', 'i') AND length({s}) < 120 THEN 'issn'
 WHEN regexp_full_match({s}, '(?:[\\p{{Nd}}.–-]|{WS})+') THEN 'numeros' END"""


def _urls(x: str) -> str:
    return f"regexp_replace({x}, 'https?://{NWS}+', '', 'g')"


def _citations(x: str) -> str:
    x = f"regexp_replace({x}, '\\[{WS}*links?{WS}*\\]', '', 'gi')"
    x = f"regexp_replace({x}, '\\({WS}*{_CAP}[^)]{{0,30}}\\)', '', 'gi')"
    x = f"regexp_replace({x}, '\\({WS}*\\p{{Nd}}+(?:{WS}*[,–y-]{WS}*\\p{{Nd}}+)*{WS}*\\)', '', 'g')"
    return f"regexp_replace({x}, '\\[{WS}*\\p{{Nd}}+(?:{WS}*[,–-]{WS}*\\p{{Nd}}+)*{WS}*\\]', '', 'g')"


def _squeeze(x: str) -> str:
    x = f"regexp_replace(regexp_replace({x}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(f"regexp_replace({x}, '{WS}+([,.;:])', '\\1', 'g')")


def _inner(x: str) -> str:
    return _squeeze(_citations(_urls(f"regexp_replace(nfc_normalize({x}), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')")))


_LAST = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY cosechado_en DESC, titulo DESC NULLS LAST) AS r FROM candidatos) WHERE r = 1)"""
_SECTION = f"(VALUES {_values((k, v) for v, ks in D.SECTIONS.items() for k in ks)}) AS sec(k, section)"
_TYPE = f"(VALUES {_values((k, v) for v, ks in D.TYPES.items() for k in ks)}) AS typ(k, type)"
_KEY = "regexp_replace(u, '[ .:;-]+$', '')"
_SECTION_CASE = """coalesce(sec.section, CASE WHEN regexp_matches(u, '^(PALABRAS\\s+CLAVES?|PALABRAS-CLAVE)\\b') THEN 'Palabras clave'
 WHEN regexp_matches(u, '^KEY\\s*WORDS\\b') THEN 'Key words' WHEN regexp_matches(u, '^RESUMEN\\b') THEN 'Resumen'
 WHEN regexp_matches(u, '^(ABSTRACT|SUMMARY)\\b') THEN 'Abstract(EN)' END)"""

# every line with its facts, and for each text the places that the header, title and abstract hang on
_CATALOGUE = f"""
WITH {_lines(unix("text"))},
u AS (SELECT task_id, n, {strip("line")} AS s, {canon("line")} AS u, upper(line) LIKE '%ISSN%' AS issn FROM l),
f AS (SELECT task_id, n, s, issn, CASE WHEN u <> '' THEN {_SECTION_CASE} END AS section, typ.type AS type,
  u IN ({", ".join(map(_q, D.SITE_LINES))}) OR u LIKE '- %' OR (u LIKE '%ISSN%' AND (u LIKE '%VERSION%' OR u LIKE '%IMPRESA%' OR u LIKE '%ON-LINE%' OR u LIKE '%ONLINE%')) AS site,
  lower(s) LIKE 'http%' OR lower(s) LIKE 'doi:%' OR lower(s) LIKE '%doi.org%' AS doi
  FROM u LEFT JOIN {_SECTION} ON sec.k = {_KEY} LEFT JOIN {_TYPE} ON typ.k = {_KEY}),
h AS (SELECT task_id, max(n) AS total, min(n) FILTER (issn) AS i1, max(n) FILTER (issn) AS i2, min(n) FILTER (s <> '' AND NOT site) AS opening,
  min(n) FILTER (section = 'Referencias') AS refs, min(n) FILTER (section = 'Palabras clave') AS keys, count(*) FILTER (s <> '') AS nlines FROM f GROUP BY task_id),
st AS (SELECT h.*, (SELECT min(n) FROM f WHERE f.task_id = h.task_id AND f.n > h.i1 AND f.s <> '' AND NOT f.issn) AS stop FROM h),
c AS (SELECT *, CASE WHEN i1 IS NOT NULL THEN coalesce(stop, i2) ELSE coalesce(opening - 1, total) END AS cursor_ FROM st),
t AS (SELECT c.*, coalesce((SELECT min(n) FROM f WHERE f.task_id = c.task_id AND f.n > cursor_ AND NOT (f.s = '' OR f.site OR f.doi OR f.type IS NOT NULL)), total + 1) AS at_ FROM c),
g AS (SELECT t.*, fs.s AS voldate, CASE WHEN ft.section IS NULL THEN ft.s END AS title,
  (SELECT arg_min(type, n) FROM f WHERE f.task_id = t.task_id AND f.n > cursor_ AND f.n < at_ AND f.s <> '' AND NOT f.site AND NOT f.doi AND f.type IS NOT NULL) AS type,
  (SELECT max(n) FROM f WHERE f.task_id = t.task_id AND f.n < keys AND f.s <> '') AS abs_n
  FROM t LEFT JOIN f fs ON fs.task_id = t.task_id AND fs.n = stop LEFT JOIN f ft ON ft.task_id = t.task_id AND ft.n = at_),
o AS (SELECT task_id, list(section ORDER BY n) AS structure FROM (SELECT task_id, section, min(n) AS n FROM f WHERE section IS NOT NULL GROUP BY ALL) GROUP BY task_id),
r AS (SELECT p.task_id, g.* EXCLUDE (task_id), coalesce(o.structure, []) AS structure FROM preanot p LEFT JOIN g USING (task_id) LEFT JOIN o USING (task_id))
"""


def _place(text: str, pattern: str, shift: str = "0") -> str:
    p = f"\\n{WS}*" + pattern.replace("{w}", WS).replace("(", "(?:")
    parts = f"string_split_regex({text}, {_q('(?i)' + p)})"
    return f"CASE WHEN len({parts}) > 1 THEN length({parts}[1]) + {shift} END"


def _least(text: str, patterns, shift: str = "0") -> str:
    rows = ", ".join(f"{{'pos': {_place(text, p, shift)}, 'ord': {i}, 'label': {_q(k)}}}" for i, (k, p) in enumerate(patterns))
    return f"list_sort(list_filter([{rows}], lambda x: x.pos IS NOT NULL))[1]"


_BOUNDS = f"""
WITH b AS (SELECT task_id, text, string_split(regexp_replace(regexp_replace(text, '{_BREAKS}', chr(10), 'g'), '\\n$', ''), chr(10)) AS ls FROM preanot),
n AS (SELECT task_id, text, CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN '' ELSE coalesce(array_to_string(list_filter(list_transform(ls, lambda x: CASE WHEN {strip("x")} = '' THEN '' ELSE x END), lambda x: ({_noise("x")}) IS NULL), chr(10)), '') END AS c FROM b),
s AS (SELECT *, {_least("chr(10) || c", D.STARTS)} AS s0, {_place("chr(10) || c", D.INTRODUCTION)} AS ip, {_place("chr(10) || c", D.ENGLISH_ABSTRACT)} AS ap FROM n),
m AS (SELECT *, coalesce(ip IS NOT NULL AND ((s0.label IN ({", ".join(map(_q, D.TYPE_STARTS))}) AND s0.pos < ip) OR (ap >= coalesce(s0.pos, 0) AND ap < ip)), false) AS moved FROM s),
x AS (SELECT task_id, text, c, CASE WHEN c IS NOT NULL THEN CASE WHEN moved THEN ip ELSE coalesce(s0.pos, 0) END END::INT AS st,
  CASE WHEN c IS NOT NULL THEN CASE WHEN moved THEN 'introduccion' ELSE coalesce(s0.label, 'sin_inicio') END END AS sl FROM m),
y AS (SELECT *, {_least("substring(c, st + 2)", D.ENDS, "st + 2")} AS e0 FROM x),
z AS (SELECT *, CASE WHEN c IS NOT NULL THEN coalesce(e0.pos, length(c)) END::INT AS en, CASE WHEN c IS NOT NULL THEN coalesce(e0.label, 'fin_archivo') END AS el FROM y),
k AS (SELECT *, {_inner("substring(c, st + 1, en - st)")} AS core FROM z)
"""

_POOL = """
WITH pool AS (SELECT pid, substring(pid, 2, 9) AS stratum FROM seleccion_validacion WHERE pid IS NOT NULL GROUP BY pid),
sz AS (SELECT stratum, count(*) AS size FROM pool GROUP BY stratum), tot AS (SELECT sum(size)::BIGINT AS total, least(120, sum(size))::BIGINT AS n FROM sz),
al AS (SELECT stratum, size, size * n // total AS base, (size * n) % total AS rem, n FROM sz CROSS JOIN tot),
qu AS (SELECT stratum, size, (base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum) <= (SELECT max(n) - sum(base) FROM al) THEN 1 ELSE 0 END)::BIGINT AS quota FROM al),
dr AS (SELECT pid, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || pid), pid) AS r FROM pool),
dn AS (SELECT pid, stratum FROM dr JOIN qu USING (stratum) WHERE r <= quota)
"""

_FLAG = "CASE WHEN lower(trim({0})) IN ('true', 'si', 'sí', '1') THEN true WHEN lower(trim({0})) IN ('false', 'no', '0') THEN false END"
_ANSWERS = f"""
WITH a AS (SELECT pid, coalesce(error, '') = '' AS ok, {_FLAG.format("es_caso_oncologico")} AS f1, {_FLAG.format("es_paciente_humano")} AS f2, {_FLAG.format("tiene_narrativa_paciente")} AS f3,
  idioma_cuerpo, calidad_recorte, confianza FROM (SELECT DISTINCT * FROM qc_deepseek))
"""

_MENTIONS = f"""
WITH e AS (SELECT task_id, {unix("text")} AS text, unnest(range(len(entidades)))::INT AS ord, unnest(entidades) AS e FROM preanot WHERE entidades IS NOT NULL),
m AS (SELECT task_id, text, ord, {strip("e.texto")} AS mention, upper({strip("e.categoria")}) AS label FROM e),
v AS (SELECT * FROM m WHERE mention <> '' AND label IN ({", ".join(map(_q, D.ENTITY_LABELS))}))
"""


def oracle_sql() -> dict[str, str]:
    f = fold("titulo")
    has = lambda terms: f"regexp_matches({f}, {_q('|'.join(terms))})"
    clase = f"CASE WHEN {has(D.ONCOLOGY_STRONG)} THEN 'alta' WHEN {has(D.ONCOLOGY_WEAK)} THEN 'media' END"
    case = f"({has(D.CASE_PHRASES)} OR {fold('tipo_documento')} = 'case-report')"
    heads = " + ".join(f"CASE WHEN regexp_matches(chr(10) || h, '\\n{WS}*{x}\\b') THEN 1 ELSE 0 END" for x in D.ENGLISH_HEADINGS)
    flat = strip(f"regexp_replace(text, '{WS}+', ' ', 'g')")
    return {
        "keyword_relevance": f"SELECT pid, titulo, {clase} AS clase FROM candidatos",
        "case_title_filter": f"SELECT pid, titulo, tipo_documento FROM candidatos WHERE {case} AND pid <> ''",
        "relevant_cases": f"""SELECT DISTINCT ON (pid) pid, {clase} AS clase, anio, coalesce(idioma, '') AS idioma FROM candidatos
WHERE {clase} IS NOT NULL AND {case} AND pid <> '' ORDER BY pid, cosechado_en""",
        "fold_text": f"SELECT pid, {f} AS plegado FROM candidatos",
        "english_title": f"""SELECT pid, titulo, regexp_matches({f}, '\\b({"|".join(D.ENGLISH_TITLE_WORDS)})\\b') AND NOT regexp_matches(coalesce(titulo, ''), '[áéíóúñ]') AS ingles FROM candidatos""",
        "dedup_first": "SELECT DISTINCT ON (pid) pid, titulo, cosechado_en::VARCHAR AS cosechado FROM candidatos ORDER BY pid, cosechado_en",
        "dedup_last": "SELECT DISTINCT ON (pid) pid, titulo, cosechado_en::VARCHAR AS cosechado FROM candidatos ORDER BY pid, cosechado_en DESC",
        "latest_by_pid": "SELECT DISTINCT ON (pid) pid, task_id FROM preanot ORDER BY pid, anotado_en DESC NULLS LAST, task_id DESC",
        "pending_anti": "SELECT DISTINCT pid FROM candidatos WHERE pid NOT IN (SELECT pid FROM fetch_log WHERE chars > 0 AND pid IS NOT NULL)",
        "approved_semi": "SELECT task_id, pid FROM preanot WHERE pid IN (SELECT pid FROM qc_deepseek WHERE lower(trim(revisar)) = 'no')",
        "missing_anti": "SELECT DISTINCT pid FROM qc_deepseek WHERE lower(trim(revisar)) = 'no' AND pid NOT IN (SELECT pid FROM preanot WHERE pid IS NOT NULL)",
        "without_failed": "SELECT pid, error FROM qc_deepseek WHERE pid IN (SELECT pid FROM qc_deepseek WHERE coalesce(error, '') = '' AND coalesce(es_caso_oncologico, '') <> '')",
        "text_with_candidate": f"WITH {_LAST} SELECT task_id, p.pid, coalesce(titulo, '') AS titulo, coalesce(relevancia, 'alta') AS relevancia FROM preanot p LEFT JOIN last USING (pid)",
        "journal_lookup": """SELECT substring(s.pid, 2, 9) AS issn, s.pid, CASE WHEN regexp_full_match(substring(s.pid, 11, 4), '[0-9]+') THEN substring(s.pid, 11, 4) ELSE '?' END AS anio,
  coalesce(m.journal, '(revista no identificada)') AS revista FROM seleccion_validacion s LEFT JOIN metas_revista m ON m.issn = substring(s.pid, 2, 9)""",
        "journal_names": f"""SELECT pid, coalesce(j.name, '(revista no identificada)') AS revista FROM (SELECT DISTINCT pid FROM candidatos)
  LEFT JOIN (VALUES {_values(D.JOURNALS.items())}) AS j(issn, name) ON j.issn = substring(pid, 2, 9)""",
        "journal_counts": """SELECT substring(pid, 2, 9) AS issn, count(*) AS filas, count(DISTINCT pid) AS pids, count(*) FILTER (trim(titulo) = '') AS sin_titulo, count(*) FILTER (relevancia = 'alta') AS alta
  FROM candidatos GROUP BY 1""",
        "year_range": """SELECT min(y) AS primero, max(y) AS ultimo, count(DISTINCT y) AS anios FROM
  (SELECT CASE WHEN regexp_full_match(substring(pid, 11, 4), '[0-9]+') THEN substring(pid, 11, 4) ELSE '?' END AS y FROM candidatos)""",
        "type_counts": "SELECT coalesce(tipo_documento, '(ninguno)') AS tipo, count(*) AS n FROM candidatos GROUP BY 1 ORDER BY n DESC, tipo",
        "motive_histogram": "SELECT trim(m) AS value, count(*) AS count FROM (SELECT unnest(string_split(motivos, ';')) AS m FROM (SELECT DISTINCT * FROM qc_deepseek)) WHERE trim(m) <> '' GROUP BY 1",
        "usage_totals": """SELECT coalesce(sum(prompt_tokens), 0)::BIGINT AS prompt_tokens, coalesce(sum(completion_tokens), 0)::BIGINT AS completion_tokens,
  coalesce(sum(prompt_cache_hit_tokens), 0)::BIGINT AS prompt_cache_hit_tokens, coalesce(sum(prompt_cache_miss_tokens), 0)::BIGINT AS prompt_cache_miss_tokens, count(DISTINCT pid) AS pids FROM usage_log""",
        "fetch_lengths": "SELECT fuente, count(*) AS n, round(avg(chars), 4) AS media FROM fetch_log GROUP BY 1",
        "word_stats_upper_median": """WITH w AS (SELECT palabras FROM (SELECT DISTINCT * FROM seleccion_validacion) WHERE palabras IS NOT NULL)
SELECT count(*) AS n, min(palabras) AS least, list_sort(list(palabras))[(count(*) // 2 + 1)::INT] AS upper_median, max(palabras) AS most, sum(palabras)::BIGINT AS total FROM w""",
        "windowed_counts": "SELECT date_trunc('hour', ts)::VARCHAR AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
        "word_count": f"SELECT task_id, len(regexp_extract_all(text, '{NWS}+')) AS palabras FROM preanot",
        "line_explode": f"WITH {_lines(unix('text'))} SELECT task_id, n AS line_no, line FROM l",
        "noise_lines": f"WITH {_lines(f"regexp_replace(text, '{_BREAKS}', chr(10), 'g')")} SELECT * FROM (SELECT task_id, n AS line_no, {_noise('line')} AS tipo FROM l) WHERE tipo IS NOT NULL",
        "line_cleanup": _BOUNDS + "SELECT task_id, c AS limpio FROM n",
        "url_strip": f"SELECT task_id, {_urls('text')} AS limpio FROM preanot",
        "citation_strip": f"SELECT task_id, {_citations('text')} AS limpio FROM preanot",
        "whitespace_squeeze": f"SELECT task_id, {_squeeze('text')} AS limpio FROM preanot",
        "inner_cleanup": f"SELECT task_id, {_inner('text')} AS limpio FROM preanot",
        "nfc_exact": "SELECT task_id, nfc_normalize(text) AS nfc FROM preanot",
        "smart_trim": f"""WITH f AS (SELECT task_id, {flat} AS t FROM preanot), h AS (SELECT task_id, t, left(t, 650) AS h FROM f),
d AS (SELECT *, CASE WHEN contains(h, '. ') THEN length(h) - strpos(reverse(h), ' .') - 1 ELSE -1 END AS at_ FROM h)
SELECT task_id, CASE WHEN length(t) <= 650 THEN t WHEN at_ > 325 THEN left(h, at_ + 1) ELSE regexp_replace(h, '[ ,;:]+$', '') || '…' END AS corto FROM d""",
        "looks_spanish": "SELECT task_id, regexp_matches(text, '[áéíóúñ¿¡ÁÉÍÓÚÑ]') OR len(regexp_extract_all(lower(text), '\\b(de|la|el|en|los|las|una|con|por|que|del|se|un)\\b')) >= 3 AS espanol FROM preanot",
        "english_body": f"""WITH x AS (SELECT task_id, {fold("left(text, 4000)")} AS h, text FROM preanot)
SELECT task_id, coalesce(text IS NOT NULL AND ({heads}) >= 2 AND NOT contains(h, 'discusion'), false) AS ingles FROM x""",
        "flex_find": f"""WITH t AS (SELECT pid, min(titulo) AS f FROM seleccion_validacion WHERE titulo IS NOT NULL GROUP BY pid),
x AS (SELECT task_id, text, f, list_filter(string_split_regex({strip("f")}, '{WS}+'), lambda w: w <> '') AS w FROM preanot JOIN t USING (pid)),
y AS (SELECT *, array_to_string(list_transform(w, lambda v: regexp_escape(v)), '{WS}+') AS p FROM x)
SELECT task_id, coalesce(CASE WHEN length(f) < 4 THEN -1 WHEN strpos(text, f) > 0 THEN strpos(text, f) - 1
  WHEN len(w) >= 2 AND regexp_matches(text, p) THEN length(string_split_regex(text, p)[1]) ELSE -1 END, -1)::INT AS lugar FROM y""",
        "section_detect": f"""WITH {_lines(unix("text"))}, u AS (SELECT task_id, n, {canon("line")} AS u FROM l)
SELECT * FROM (SELECT task_id, n AS line_no, CASE WHEN u <> '' THEN {_SECTION_CASE} END AS seccion FROM u LEFT JOIN {_SECTION} ON sec.k = {_KEY}) WHERE seccion IS NOT NULL""",
        "type_detect": f"WITH {_lines(unix('text'))}, u AS (SELECT task_id, n, {canon('line')} AS u FROM l) SELECT task_id, n AS line_no, typ.type AS tipo FROM u JOIN {_TYPE} ON typ.k = {_KEY}",
        "ordered_sections": _CATALOGUE + "SELECT task_id, coalesce(array_to_string(structure, ' › '), '') AS estructura FROM r",
        "header_block": _CATALOGUE + "SELECT task_id, voldate AS volumen, type AS tipo, title AS titulo FROM r",
        "final_type": _CATALOGUE
        + """SELECT task_id, coalesce(type, CASE WHEN list_contains(structure, 'Caso clínico') THEN 'Reporte de caso (inferido)'
  WHEN list_contains(structure, 'Materiales y métodos') AND list_contains(structure, 'Resultados') THEN 'Artículo original (inferido)'
  WHEN NOT list_contains(structure, 'Resumen') AND coalesce(nlines, 0) <= 10 THEN 'Imagen / nota breve (inferido)' ELSE 'Indeterminado' END) AS tipo, coalesce(nlines, 0)::INT AS lineas FROM r""",
        "abstract_extract": _CATALOGUE
        + """, ab AS (SELECT r.task_id, CASE WHEN fa.section IS NULL AND fa.s IS NOT NULL THEN
    CASE WHEN length(fa.s) < 120 AND fp.s <> '' AND fp.section IS NULL THEN fp.s || ' ' || fa.s ELSE fa.s END END AS own,
    CASE WHEN title IS NULL THEN at_ - 1 ELSE at_ END AS b, coalesce(refs - 1, total) AS e
  FROM r LEFT JOIN f fa ON fa.task_id = r.task_id AND fa.n = r.abs_n LEFT JOIN f fp ON fp.task_id = r.task_id AND fp.n = r.abs_n - 1),
bd AS (SELECT ab.task_id, f.n, f.s FROM ab JOIN f ON f.task_id = ab.task_id AND f.n > b AND f.n <= e WHERE f.s <> '' AND f.section IS NULL AND NOT regexp_matches(f.s, '^\\d+\\s*[.)]')),
fb AS (SELECT task_id, coalesce(arg_min(s, n) FILTER (length(s) >= 160), arg_max(s, length(s) * 100000 - n)) AS s FROM bd GROUP BY task_id)
SELECT ab.task_id, coalesce(own, fb.s, '') AS resumen FROM ab LEFT JOIN fb USING (task_id)""",
        "catalog_cards": _CATALOGUE
        + """, ft AS (SELECT task_id, title, structure, coalesce(type, CASE WHEN list_contains(structure, 'Caso clínico') THEN 'Reporte de caso (inferido)'
  WHEN list_contains(structure, 'Materiales y métodos') AND list_contains(structure, 'Resultados') THEN 'Artículo original (inferido)'
  WHEN NOT list_contains(structure, 'Resumen') AND coalesce(nlines, 0) <= 10 THEN 'Imagen / nota breve (inferido)' ELSE 'Indeterminado' END) AS tipo FROM r)
SELECT n, format('[{:03d}] {}', n, task_id) || chr(10) || 'TIPO: ' || tipo || chr(10) || 'TITULO: ' || coalesce(title, '-') || chr(10) || 'ESTRUCTURA: ' || coalesce(array_to_string(structure, ' › '), '') AS card
FROM (SELECT *, row_number() OVER (ORDER BY task_id::VARCHAR) AS n FROM ft)""",
        "decision_ladder": _CATALOGUE
        + f""", en AS (SELECT task_id, {fold("left(text, 4000)")} AS h, text FROM preanot),
dl AS (SELECT task_id, CASE WHEN regexp_matches({fold("title")}, '\\b({"|".join(D.ENGLISH_TITLE_WORDS)})\\b') AND NOT regexp_matches(coalesce(title, ''), '[áéíóúñ]') THEN 'DESCARTADO'
  WHEN text IS NOT NULL AND ({heads}) >= 2 AND NOT contains(h, 'discusion') THEN 'DESCARTADO'
  WHEN NOT list_has_any(structure, ['Introducción', 'Caso clínico']) THEN 'REVISAR' ELSE 'SELECCIONADO' END AS decision FROM r JOIN en USING (task_id))
SELECT task_id, decision FROM dl""",
        "decision_counts": _CATALOGUE
        + f""", en AS (SELECT task_id, {fold("left(text, 4000)")} AS h, text FROM preanot),
dl AS (SELECT task_id, CASE WHEN regexp_matches({fold("title")}, '\\b({"|".join(D.ENGLISH_TITLE_WORDS)})\\b') AND NOT regexp_matches(coalesce(title, ''), '[áéíóúñ]') THEN 'DESCARTADO'
  WHEN text IS NOT NULL AND ({heads}) >= 2 AND NOT contains(h, 'discusion') THEN 'DESCARTADO'
  WHEN NOT list_has_any(structure, ['Introducción', 'Caso clínico']) THEN 'REVISAR' ELSE 'SELECCIONADO' END AS decision FROM r JOIN en USING (task_id))
SELECT decision, count(*) AS n FROM dl GROUP BY decision""",
        "prompt_build": "SELECT task_id, md5('Clasifica:' || chr(10) || left(text, 60000) || chr(10) || 'Fin') AS huella, length(left(text, 100))::INT AS largo FROM preanot",
        "boundary_start": _BOUNDS + "SELECT task_id, sl AS inicio, st AS lugar FROM k",
        "boundary_end": _BOUNDS + "SELECT task_id, el AS fin, en AS lugar FROM k",
        "core_slice": _BOUNDS + "SELECT task_id, core FROM k",
        "cut_safeguard": _BOUNDS + f"SELECT task_id, CASE WHEN core IS NULL OR len(regexp_extract_all(core, '{NWS}+')) < 150 OR length(core) < 0.3 * length(text) THEN {strip('text')} ELSE core END AS texto FROM k",
        "cut_apply": f"""WITH w AS (SELECT task_id, text, list_filter(string_split_regex({strip("text")}, '{WS}+'), lambda x: x <> '')[21:24] AS w FROM preanot WHERE text IS NOT NULL),
h AS (SELECT task_id, text, array_to_string(w, ' ') AS f, w, array_to_string(list_transform(w, lambda v: regexp_escape(v)), '{WS}+') AS p FROM w),
a AS (SELECT *, CASE WHEN coalesce(length(f), 0) < 4 THEN 0 WHEN strpos(text, f) > 0 THEN strpos(text, f) - 1 WHEN len(w) >= 2 AND regexp_matches(text, p) THEN length(string_split_regex(text, p)[1]) ELSE 0 END AS st FROM h),
b AS (SELECT *, CASE WHEN strpos(text, 'Referencias') - 1 > st THEN strpos(text, 'Referencias') - 1 ELSE length(text) END AS en FROM a),
c AS (SELECT *, {strip("substring(text, st + 1, en - st)")} AS cut FROM b)
SELECT task_id, CASE WHEN len(regexp_extract_all(cut, '{NWS}+')) < 150 OR length(cut) < 0.3 * length(text) THEN {strip("text")} ELSE cut END AS texto FROM c""",
        "eligible_by_journal": f"""WITH {_LAST}, x AS (SELECT p.pid, len(regexp_extract_all(text, '{NWS}+')) AS n, last.pid IS NULL AS gone, {clase} AS clase FROM preanot p LEFT JOIN last USING (pid))
SELECT substring(pid, 2, 9) AS issn, count(*) AS textos, sum(n)::BIGINT AS palabras FROM x WHERE n >= 150 AND coalesce(clase, 'alta') = 'alta' GROUP BY 1""",
        "alloc_largest_remainder": _POOL + "SELECT stratum, size, quota FROM qu",
        "stratified_draw": _POOL + "SELECT pid, stratum FROM dn",
        "reserve_anti": _POOL + "SELECT pid, stratum FROM pool WHERE pid NOT IN (SELECT pid FROM dn)",
        "qc_json_parse": _ANSWERS
        + """SELECT pid, CASE WHEN ok THEN f1 END AS es_caso_oncologico, CASE WHEN ok THEN f2 END AS es_paciente_humano, CASE WHEN ok THEN translate(idioma_cuerpo, '"\\' || chr(10), '   ') END AS idioma_cuerpo,
  CASE WHEN ok THEN translate(calidad_recorte, '"\\' || chr(10), '   ') END AS calidad_recorte, CASE WHEN ok THEN translate(confianza, '"\\' || chr(10), '   ') END AS confianza FROM a""",
        "review_reasons": _ANSWERS
        + """SELECT pid, CASE WHEN NOT ok THEN 'sin_respuesta' ELSE concat_ws(';', CASE WHEN f1 = false THEN 'no_caso' END, CASE WHEN f2 = false THEN 'no_humano' END,
  CASE WHEN idioma_cuerpo IN ('en', 'mixto') THEN 'idioma_' || idioma_cuerpo END, CASE WHEN f3 = false THEN 'sin_narrativa' END,
  CASE WHEN coalesce(calidad_recorte, '') NOT IN ('limpio', '') THEN 'recorte_' || calidad_recorte END, CASE WHEN try_cast(confianza AS DOUBLE) < 0.6 THEN 'baja_confianza' END) END AS motivos FROM a""",
        "entity_counts": _MENTIONS + "SELECT task_id, label, count(*) AS n FROM v GROUP BY ALL",
        "mention_offsets": _MENTIONS
        + """, p AS (SELECT task_id, ord, mention, label, list_transform(string_split(text, mention), lambda x: length(x)) AS cuts FROM v),
j AS (SELECT *, (row_number() OVER (PARTITION BY task_id, mention ORDER BY ord) - 1) % (len(cuts) - 1) AS j FROM p WHERE len(cuts) > 1)
SELECT task_id, ord, (list_sum(cuts[1:j + 1]) + j * length(mention))::INT AS start, (list_sum(cuts[1:j + 1]) + (j + 1) * length(mention))::INT AS "end", mention, label FROM j""",
        "incremental_append": "SELECT DISTINCT pid FROM candidatos",
        "llm_retry": """SELECT DISTINCT pid, CASE WHEN pid LIKE '%7' THEN NULL ELSE 'ok ' || pid END AS response, CASE WHEN pid LIKE '%7' THEN 'HTTP 403' ELSE '' END AS error,
  CASE WHEN pid LIKE '%7' THEN 1 ELSE 2 END AS tries FROM candidatos WHERE pid IS NOT NULL""",
        "fetch_statuses": """WITH c AS (SELECT pid, min(html_url) AS url FROM candidatos WHERE coalesce(pid, '') <> '' GROUP BY pid),
h AS (SELECT pid, max(chars) AS chars FROM fetch_log WHERE chars > 0 AND pid IS NOT NULL GROUP BY pid),
f AS (SELECT pid, h.chars AS had, CASE WHEN h.pid IS NOT NULL THEN 'ya_existia' WHEN right(pid, 1) IN ('0', '2', '4', '6', '8') THEN 'articlemeta_body'
  WHEN coalesce(url, '') = '' OR right(url, 1) = '3' THEN 'sin_texto' WHEN right(url, 1) = '1' THEN 'error_http:ConnectionError' ELSE 'parrafos' END AS fuente FROM c LEFT JOIN h USING (pid))
SELECT pid, fuente, CASE fuente WHEN 'ya_existia' THEN had WHEN 'articlemeta_body' THEN 306 WHEN 'parrafos' THEN 610 ELSE 0 END::BIGINT AS chars FROM f""",
        "chat_usage": """SELECT count(*) AS calls, count(*) FILTER (right(pid, 1) IN ('7', '9')) AS failed, """
        + ", ".join(f"coalesce(sum({c}) FILTER (pid IS NULL OR right(pid, 1) <> '9'), 0)::BIGINT AS {c}" for c in ("prompt_tokens", "completion_tokens", "prompt_cache_hit_tokens", "prompt_cache_miss_tokens"))
        + " FROM usage_log",
        "cut_answer": f"""WITH w AS (SELECT task_id, text, list_filter(string_split_regex({strip("text")}, '{WS}+'), lambda x: x <> '')[21:24] AS w FROM preanot WHERE text IS NOT NULL),
h AS (SELECT task_id, text, array_to_string(w, ' ') AS f, w, array_to_string(list_transform(w, lambda v: regexp_escape(v)), '{WS}+') AS p FROM w),
a AS (SELECT *, CASE WHEN coalesce(length(f), 0) < 4 THEN 0 WHEN strpos(text, f) > 0 THEN strpos(text, f) - 1 WHEN len(w) >= 2 AND regexp_matches(text, p) THEN length(string_split_regex(text, p)[1]) ELSE 0 END AS st FROM h),
b AS (SELECT *, CASE WHEN task_id % 2 = 0 AND strpos(text, 'Referencias') - 1 > st THEN strpos(text, 'Referencias') - 1 ELSE length(text) END AS en FROM a),
c AS (SELECT *, {strip("substring(text, st + 1, en - st)")} AS cut FROM b), k AS (SELECT *, len(regexp_extract_all(cut, '{NWS}+')) < 150 OR length(cut) < 0.3 * length(text) AS poor FROM c)
SELECT task_id, CASE WHEN task_id % 3 = 0 THEN text WHEN poor THEN {strip("text")} ELSE cut END AS texto, task_id % 3 <> 0 AND poor AS conservado FROM k""",
        "decision_reasons": _CATALOGUE
        + f""", en AS (SELECT task_id, {fold("left(text, 4000)")} AS h, text FROM preanot),
dl AS (SELECT task_id, CASE WHEN regexp_matches({fold("title")}, '\\b({"|".join(D.ENGLISH_TITLE_WORDS)})\\b') AND NOT regexp_matches(coalesce(title, ''), '[áéíóúñ]') THEN 1
  WHEN text IS NOT NULL AND ({heads}) >= 2 AND NOT contains(h, 'discusion') THEN 1 WHEN NOT list_has_any(structure, ['Introducción', 'Caso clínico']) THEN 2 ELSE 3 END AS r FROM r JOIN en USING (task_id))
SELECT task_id, ['DESCARTADO', 'REVISAR', 'SELECCIONADO'][r] AS decision, ['cuerpo en ingles (bilingue)', 'sin Introduccion/Caso clinico rotulado', ''][r] AS motivo FROM dl""",
        "eligible_drops": f"""WITH l AS (SELECT pid, coalesce(arg_max(coalesce(relevancia, ''), (cosechado_en, coalesce(relevancia, ''))), '') AS relevancia FROM candidatos GROUP BY pid),
x AS (SELECT coalesce(l.relevancia, 'alta') AS rel, len(regexp_extract_all(coalesce(text, ''), '{NWS}+')) AS n FROM preanot LEFT JOIN l USING (pid))
SELECT CASE WHEN rel <> 'alta' THEN 'relevancia' WHEN n < 150 THEN 'palabras' ELSE '-' END AS motivo, count(*) AS n FROM x GROUP BY 1""",
        "review_flags": _ANSWERS
        + """, m AS (SELECT CASE WHEN NOT ok THEN 'sin_respuesta_del_modelo' ELSE concat_ws(';', CASE WHEN f1 = false THEN 'no_es_caso_oncologico' END, CASE WHEN f2 = false THEN 'no_humano' END,
  CASE WHEN idioma_cuerpo IN ('en', 'mixto') THEN 'idioma_' || idioma_cuerpo END, CASE WHEN f3 = false THEN 'sin_narrativa_paciente' END,
  CASE WHEN coalesce(calidad_recorte, '') NOT IN ('limpio', '') THEN 'recorte_' || calidad_recorte END, CASE WHEN try_cast(confianza AS DOUBLE) < 0.6 THEN 'baja_confianza' END) END AS motivos FROM a)
SELECT motivos <> '' AS revisar, motivos, count(*) AS n FROM m GROUP BY ALL""",
        "year_counts": "SELECT CASE WHEN regexp_full_match(substring(pid, 11, 4), '[0-9]+') THEN substring(pid, 11, 4) ELSE '?' END AS anio, count(*) AS n FROM candidatos GROUP BY 1",
        "first_pending": """SELECT pid FROM (SELECT DISTINCT pid FROM preanot WHERE pid IS NOT NULL ORDER BY pid LIMIT 100)
WHERE pid NOT IN (SELECT pid FROM qc_deepseek WHERE lower(trim(revisar)) = 'no' AND pid IS NOT NULL)""",
        "missing_capped": """WITH p AS (SELECT DISTINCT pid FROM candidatos WHERE pid IS NOT NULL AND pid NOT IN (SELECT pid FROM fetch_log WHERE chars > 0 AND pid IS NOT NULL)),
f AS (SELECT pid FROM p ORDER BY pid LIMIT 10)
SELECT (SELECT count(*) FROM p) AS n, (SELECT string_agg(pid, ';' ORDER BY pid) FROM f) AS primeros, (SELECT count(*) FROM p) - (SELECT count(*) FROM f) AS more""",
        "catalog_report": _CATALOGUE
        + """, ft AS (SELECT task_id::VARCHAR AS pid, coalesce(type, CASE WHEN list_contains(structure, 'Caso clínico') THEN 'Reporte de caso (inferido)'
  WHEN list_contains(structure, 'Materiales y métodos') AND list_contains(structure, 'Resultados') THEN 'Artículo original (inferido)'
  WHEN NOT list_contains(structure, 'Resumen') AND coalesce(nlines, 0) <= 10 THEN 'Imagen / nota breve (inferido)' ELSE 'Indeterminado' END) AS tipo FROM r),
v AS (SELECT 1 AS part, tipo AS v, count(*) AS c FROM ft GROUP BY tipo UNION ALL
  SELECT 2, CASE WHEN regexp_full_match(substring(pid, 11, 4), '[0-9]+') THEN substring(pid, 11, 4) ELSE '?' END, count(*) FROM ft GROUP BY 2)
SELECT part, row_number() OVER (PARTITION BY part ORDER BY CASE WHEN part = 1 THEN -c END, v) AS n, v || ': ' || c AS text FROM v""",
        "json_rescue": """WITH e AS (SELECT task_id, to_json({'entidades': entidades})::VARCHAR AS j FROM preanot WHERE len(entidades) > 0), c AS (SELECT task_id, left(j, (length(j) * 6 // 10)::INT) AS j FROM e),
p AS (SELECT task_id, regexp_extract_all(j, '\\{\\s*"texto"\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"\\s*,\\s*"categoria"\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"\\s*\\}', 1) AS a,
  regexp_extract_all(j, '\\{\\s*"texto"\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"\\s*,\\s*"categoria"\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"\\s*\\}', 2) AS b FROM c)
SELECT task_id, unnest(range(len(a)))::INT AS ord, unnest(a) AS texto, unnest(b) AS categoria FROM p""",
    }
