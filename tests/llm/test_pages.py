import random

from tamiz.llm import common, density, language, pages, quality, truncation
from tamiz.llm.pages import density as ctd
from tamiz.llm.pages import page_lines

PROSE = [
    "La paciente acudió al hospital por dolor abdominal de tres meses de evolución y pérdida de peso, sin otros antecedentes de importancia para el caso que se describe.",
    "En la exploración se encontró una masa de cuatro centímetros en el hilio renal, y la tomografía confirmó el hallazgo con una imagen quística de bordes irregulares.",
    "El tratamiento se inició con dos ciclos de quimioterapia, que la paciente toleró con náuseas leves, y el control a los seis meses no mostró signos de recidiva.",
]
PAGE = """Inicio | Índice | Buscar | Contacto
* Iniciar sesión
Este sitio usa cookies propias y de terceros para mejorar su experiencia de lectura.

Carcinoma renal en paciente joven
Pérez JA, Díaz M
Recibido: 01/02/2003. Aceptado: 04/05/2003
Introducción
{0}
Compartir
- Sarcoma de húmero: reporte de caso
- Linfoma gástrico
Caso clínico
{1}
plaquetas\t13,4\tU/L
Figura 1. Tomografía con una masa sólida.
{2}
Referencias
1. Pérez JA, Díaz M. Carcinoma de riñón. Rev Med. 2004;26(2):139-51.
Lo más leído
Visitas: 34
Descargas: 6
© 2001 Revista Médica. Todos los derechos reservados
< Anterior | Siguiente >""".format(*PROSE)
WANT = {1, 2, 3, 10, 11, 12, 20, 21, 22, 23, 24}


def parts(text):
    return {x.no for x in page_lines(text) if x.kind == "page"}


def test_plain_page():
    assert parts(PAGE) == WANT
    assert parts(PAGE.replace("\n", "\r\n")) == WANT
    assert parts(PAGE.encode().decode("cp1252", "ignore")) == WANT  # garbled phrases are recognised too


def test_marked_up_page():
    html = "\n".join([
        "<script>var p=1;</script>", '<div id="nav">', '<a href="/a">Inicio</a>', '<a href="/b">Sección rara</a>', "</div>", "<h3>Carcinoma renal</h3>", "<h3>Introducción</h3>",
        *(f"<p>{p}</p>" for p in PROSE), "<p>Suscríbase al boletín mensual de la revista</p>", "<br/>", '<div class="foot-2">Volver arriba</div>', '<div class="x">Otro pie cualquiera</div>',
    ])
    assert parts(html) == {1, 2, 3, 4, 5, 11, 12, 13, 14}


def test_long_notice_and_markup_over_lines():
    notice = "Este sitio usa cookies propias y de terceros para mejorar su experiencia de lectura. " * 5
    assert len(notice) > 400 and parts("\n".join([*PROSE, notice, " ".join(PROSE)])) == {4}
    html = ["<h3>Carcinoma renal</h3>", "<script>", "var paciente = 1;", "mostrar(paciente);", "</script>", *(f"<p>{p}</p>" for p in PROSE), "<!-- un comentario", "que sigue aquí", "-->", '<a href="/x">', "Otro caso de la serie", "</a>"]
    assert parts("\n".join(html)) == {2, 3, 4, 5, 9, 10, 11, 12, 13, 14}
    assert parts("\n".join(["<script>", *(f"<p>{p}</p>" for p in PROSE)])) == {1}  # never closed


def test_density():
    assert ctd(0, 1, 0, 0, 10, 1) == 0 and ctd(400, 1, 0, 0, 1000, 100) > ctd(40, 4, 30, 4, 1000, 100) > 0
    assert page_lines(None) == [] and [x.kind for x in page_lines("")] == ["blank"] and [x.kind for x in page_lines(" \n\t")] == ["blank", "blank"]


def texts(spark, rows):
    return spark.createDataFrame([(i, f"S1111-11112001{i:09d}", t, "x", 1, "y") for i, t in enumerate(rows)], "task_id bigint, pid string, text string, lang string, n int, seq string")


def test_operators_with_odd_rows(spark):
    long = "\n".join(PROSE * 2_000)
    d = texts(spark, [PAGE, None, "", " \n", PAGE, long, "💥\u0000\n<div", "<" * 50 + "/>" * 9])
    found = {(r.task_id, r.line_no) for r in density.page_parts(d).collect()}
    assert {n for t, n in found if t == 0} == WANT == {n for t, n in found if t == 4} and not any(t in (1, 2, 3, 5) for t, _ in found)
    main = {r.task_id: r for r in density.main_content(d).collect()}
    assert main[1].main is None and main[2].main == "" and main[0].dropped == len(WANT) and PROSE[0] in main[0].main and "cookies" not in main[0].main
    assert density.page_parts(d.limit(0)).count() == 0 == density.main_content(d.limit(0)).count()


def site_pages(n=40):
    """Pages of two sites, whose labels and notices no list knows, around articles with headings and a consent that recur too."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abdefilmnoprstu") for _ in range(8))
    frames = [[f"{word().capitalize()} {word()}" for _ in range(6)] + [f"{word().capitalize()} {word()} {word()} © {word()}"] for _ in range(2)]
    rows, want = [], set()
    for i in range(n):
        f = frames[i % 2]
        own = [f"Un caso {word()} de {word()}", "Introducción", f"{PROSE[i % 3]} {word()}.", f"{PROSE[(i + 1) % 3]} {word()}.", "Discusión", f"{word()}\t1,{i % 9}\tU/L", f"{PROSE[(i + 2) % 3]} {word()}.", PROSE[0]]
        lines = [*f[:4], "", *own, "", *f[4:6], f"Leído por {i} personas", f[6]]
        rows.append((i, f"S{1111 * (1 + i % 2)}-11112001{i:09d}", "\n".join(lines)))
        want |= {(i, k) for k in (1, 2, 3, 4, 15, 16, 17, 18)}
    return rows, want


def test_density_decides_without_lists(spark, monkeypatch):
    rows, want = site_pages()
    d = spark.createDataFrame(rows, "task_id bigint, pid string, text string")
    found = lambda: {(r.task_id, r.line_no) for r in density.page_parts(d).collect()}
    assert found() == want
    monkeypatch.setattr(density, "MOST_LINES", 0)  # the way without sending the lines to all tasks
    assert found() == want
    monkeypatch.undo()
    monkeypatch.setattr(pages, "density", lambda *_: 1.0)  # densities that are all the same decide nothing
    assert not found()


def test_tree():
    html = "\n".join(["<div id=m>", "<section>", *(f"<p>{p}</p>" for p in PROSE), "</nav>", "</section>", "<div", ' class="x"', ">Otro pie</div>", "</div>"])
    assert [x.text for x in page_lines(html) if x.kind == "prose"] == PROSE  # a closing tag without its start closes nothing; attributes are no text
    assert not any("class" in x.text for x in page_lines(html))


TABLE = "\n".join(f"creatinina\t{i},4\tU/L" for i in range(30))
LIST = "\n".join(f"- paclitaxel {i} mg" for i in range(30))
JUNK = "\n".join("vn|: !rt ;:. ^jl ~w" + "|:;" * (i % 5) for i in range(20))
WRAPPED = "\n".join(" ".join(" ".join(PROSE).split()[i:i + 9]) for i in range(0, 80, 9))


def test_not_prose(spark, monkeypatch):
    normal = [f"{PROSE[i % 3]}\n{PROSE[(i + 1) % 3]} {i}\n{PROSE[(i + 2) % 3]}" for i in range(60)]
    odd = [TABLE, LIST, JUNK, "Título\n" + PROSE[0] + "\n" + TABLE + LIST]
    d = texts(spark, [*normal, WRAPPED, PROSE[0] + "\ncreatinina\t1,4\tU/L\n" + PROSE[1], None, "", *odd])
    got = {r.task_id for r in quality.not_prose(d).collect()}
    assert got == {64, 65, 66, 67}
    stats = {r.task_id: r for r in quality.text_statistics(d).collect()}
    assert stats[62].lang == "?" and stats[62].mean_word is None and stats[0].lang == "es" and stats[0].words == len(normal[0].split())
    assert quality.not_prose(d.limit(0)).count() == 0 == quality.text_statistics(d.limit(0)).count()
    # the score decides: below its bounds nothing is found, beyond them everything
    for n, found in ((1e9, set()), (1, set(range(60)))):
        monkeypatch.setattr(quality, "gamma_bound", lambda shape, beyond, n=n: n if n > 1 else -1.0)
        assert found <= {r.task_id for r in quality.not_prose(d).collect()} and (found or not quality.not_prose(d).count())


def test_gamma_bound():
    assert abs(quality.gamma_bound(1, 0.05) - 2.9957) < 1e-3 and abs(quality.gamma_bound(4, 0.05) - 7.7537) < 1e-3 and quality.three(123456) == 123000.0


def test_running_total(spark):
    r = random.Random(4)
    rows = [(r.choice("aab"), r.randrange(50), i, r.randrange(9)) for i in range(500)]
    d = common.running_total(spark.createDataFrame(rows, "g string, o int, i int, w int"), "g", ["o", "i"], "w")
    assert all(x.before == sum(w for g, o, i, w in rows if g == x.g and (o, i) < (x.o, x.i)) for x in d.collect()) and d.count() == 500
    assert "NestedLoop" not in d._jdf.queryExecution().executedPlan().toString() and "CartesianProduct" not in d._jdf.queryExecution().executedPlan().toString()


def test_exact_ranks(spark):
    r = random.Random(2)
    rows = [(r.choice(["es", "en"]), r.choice("ab"), None if r.random() < 0.05 else float(r.randrange(12))) for _ in range(600)]
    got = quality.exact_ranks(spark.createDataFrame(rows, "lang string, stat string, value double")).collect()
    for x in got:
        mine = [v for a, b, v in rows if (a, b) == (x.lang, x.stat) and v is not None]
        assert (x.at_most, x.at_least, x.n) == (sum(v <= x.value for v in mine), sum(v >= x.value for v in mine), len(mine))
    assert len(got) == len({x for x in rows if x[2] is not None})


def test_automaton():
    assert truncation.open_at_end('a (b [c] "d') == 'S("' and truncation.open_at_end("a) «b»") == "S" and truncation.open_at_end("Uno (dos. Tres). Cuatro.") == "" == truncation.open_at_end("")
    assert truncation.automaton([["Uno (dos"], ["Tres."]]).stack == "" and truncation.automaton([["Uno,", "dos (tres"]]) == ("S(", "Uno, dos (tres")
    assert truncation.broken_end("a &lt; b &am") and truncation.broken_end("a\\u00") and truncation.broken_end("fin�") and truncation.broken_end("x <p") and not truncation.broken_end("fin.")
    assert not truncation.broken_end("área de R&D") and truncation.open_elements("<div><b>a<br></b><p>c") == ["div"] and truncation.open_elements("<i>a</i></b>") == []


def test_cut_by_states_and_sources(spark, monkeypatch):
    whole = "\n".join(PROSE)
    marked = "\n".join(f"<p>{p}</p>" for p in PROSE)
    bare = "\n".join(f"{p[:-1]} y {p[:-1].lower()}" for p in PROSE)  # a source that leaves terminators out
    rows = [("1", whole)] * 12 + [("1", f"<div>{marked}</div>"), ("1", f"<div>{marked}"), ("1", f"<div>{marked}<sp")] + [("1", whole[:-40])] + [("2", bare)] * 9 + [("3", whole + "\nSe hizo, con cuidado, una " + x * 5) for x in "uvwxyz"]
    d = spark.createDataFrame([(i, f"S{j * 4}-{j * 4}2001{i:09d}", t) for i, (j, t) in enumerate(rows)], "task_id bigint, pid string, text string")
    got = {r.task_id: r for r in truncation.endings(d).collect()}
    assert [i for i in range(16) if got[i].verdict == "cut"] == [13, 14, 15]
    assert all(got[i].verdict == "complete" and got[i].complete_share > 0.5 for i in range(16, 25))  # its own baseline
    assert all(got[i].verdict == "cut" and got[i].at_limit for i in range(25, 31))
    monkeypatch.setattr(truncation, "automaton", lambda parts: truncation.End("", ""))  # without the automaton only broken ends and tags are left
    assert {r.task_id for r in truncation.endings(d).where("verdict = 'cut'").collect()} == {13, 14}


def test_endings(spark):
    whole = "\n".join(PROSE)
    cases = {
        "complete": [whole, whole + "\n© Revista Médica", whole + "\nReferencias\n1. Pérez J. Un título cualquiera. Rev Med. 2004;26(2):139-51", whole + "\nPalabras clave: tumor, caso", whole + "\ncreatinina\t1,4\tU/L", whole[:-1]],
        "cut": [whole[:-30], whole[:-30] + "\n© Revista Médica", whole[:-30] + "... Leer más", whole + "\nEn ese contexto (…)", whole + "\nSe hizo una biopsia (de tru", "\n".join(PROSE[:2]) + "\nEl tratamiento se inició con"],
        "blank": [None, "", "\n"],
    }
    rows = [t for ts in cases.values() for t in ts] + [whole] * 20
    got = [r.verdict for r in truncation.endings(texts(spark, rows)).orderBy("task_id").collect()]
    assert got == [k for k, ts in cases.items() for _ in ts] + ["complete"] * 20
    rates = truncation.source_rates(truncation.endings(texts(spark, rows))).first()
    assert (rates.texts, rates.cut) == (32, 6)
    assert truncation.endings(texts(spark, rows).limit(0)).count() == 0


SPOKEN = {
    "es": PROSE,
    "en": [
        "The patient was admitted to the hospital because of abdominal pain that had worsened over the last three months and a loss of weight of four kilograms.",
        "Physical examination revealed a firm mass in the renal hilum, and the computed tomography showed a cystic image with irregular borders in the left kidney.",
        "She was treated with two cycles of chemotherapy, which she tolerated well, and the follow-up at six months did not show any sign of relapse.",
    ],
    "pt": [
        "A paciente procurou atendimento com dor abdominal há três meses e perda de peso, sem outros antecedentes de importância para o caso que é descrito aqui.",
        "Ao exame físico notou-se uma massa firme no rim esquerdo, e a tomografia mostrou uma imagem cística de bordas irregulares, que não havia sido descrita.",
        "O tratamento foi iniciado com dois ciclos de quimioterapia, e o seguimento aos seis meses não mostrou sinais de recidiva da doença no local da cirurgia.",
    ],
}


def test_languages(spark):
    rows = [("\n".join(SPOKEN[lang][(i + j) % 3] for j in range(3)), lang) for i in range(12) for lang in SPOKEN]
    mixed = SPOKEN["es"][0] + "\n" + SPOKEN["en"][0] + "\n" + SPOKEN["es"][1] + "\nKeywords: the pain, of the kidney, and so on"
    d = texts(spark, [t for t, _ in rows] + [mixed, None, "", TABLE])
    profiles = language.fit(d.where(f"task_id < {len(rows)}"))  # each sentence as often: there are too few for stable ranks otherwise
    assert set(profiles) == {"es", "en", "pt"} and language.fit(d.limit(0)) == {}
    got = {r.task_id: r for r in language.languages(d, profiles).collect()}
    assert [got[i].lang for i in range(len(rows))] == [lang for _, lang in rows] and all(got[i].foreign == [] for i in range(len(rows)))
    n = len(rows)
    assert got[n].lang == "es" and [(x.line_no, x.lang) for x in got[n].foreign] == [(2, "en")] and set(got) == {*range(n + 1), n + 3} and got[n + 3].lang == language.UNKNOWN
    assert {r.lang for r in language.languages(d, {}).collect()} == {language.UNKNOWN}
    spoken = language.languages(d.where(f"task_id in (0, 1, {n})"), profiles)
    pid = [f"S1111-11112001{i:09d}" for i in (0, 1, n)]
    cand = spark.createDataFrame([(pid[0], "es-PE"), (pid[0], "es-PE"), (pid[1], "español"), (pid[2], " n/d "), (None, "en")], "pid string, idioma string")
    triage = spark.createDataFrame([(pid[0], "Es", ""), (pid[1], None, ""), (pid[1], "es", "HTTP 500"), (pid[2], "es", None)], "pid string, idioma_cuerpo string, error string")
    wrong = sorted(tuple(r) for r in language.wrong_labels(spoken, cand, triage).collect())
    assert wrong == [("idioma", 1, 0), ("idioma", n, 0), ("idioma_cuerpo", 1, 0), ("idioma_cuerpo", n, 0), ("segmento", n, 2)]
    assert language.wrong_labels(spoken, cand.limit(0), triage.limit(0)).count() == 1
