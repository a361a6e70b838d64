import random
import re
import unicodedata

from tamiz.llm import encoding, leakage, spam

TEXT = "La exploración reveló una tumoración quística del riñón; según el médico, la evolución clínica después de tres días fue rápida. Año, niño, corazón, pulmón, también «órgano»."
UPPER = "PRESENTACIÓN CLÍNICA DEL CORAZÓN Y DEL RIÑÓN"


def garble(t, how):
    if how == "lost":
        return t.encode("ascii", "replace").decode().replace("?", "�")
    code, byte, times = how
    for _ in range(times):
        t = "".join(bytes([b]).decode(code, "ignore") or chr(b) for b in t.encode(byte))
    return t


WAYS = [("cp1252", "utf8", 1), ("cp1252", "utf8", 2), ("cp437", "utf8", 1), ("mac_roman", "utf8", 1), ("cp1251", "utf8", 1), ("cp850", "latin-1", 1), ("mac_roman", "latin-1", 1), "lost"]


def frame(spark, rows):
    return spark.createDataFrame([("t", k, v, "x", 3) for k, v in rows], "tabla string, clave string, text string, word string, n int")


def test_round_trip(spark):
    clean = [(f"c{i}", TEXT) for i in range(6)] + [(f"u{i}", UPPER) for i in range(6)]
    fine = [("nfd", unicodedata.normalize("NFD", TEXT)), ("sign", "5 µg/L ± 3 °C – β2 «cita» n.º 4 • fin… € 5"), ("plain", "sin acentos: ano"), ("null", None), ("empty", ""), (None, TEXT)]
    bad = [(f"b{i}", garble(TEXT, w)) for i, w in enumerate(WAYS)] + [(f"B{i}", garble(UPPER, w)) for i, w in enumerate(WAYS)]
    d = frame(spark, clean + fine + bad + bad[:1])
    got = {r.clave for r in encoding.garbled(d).collect()}
    assert got == {k for k, _ in bad}
    back = {r.clave: r.restored for r in encoding.restored(d).collect()}
    assert set(back) == got
    for k, t in back.items():
        want = TEXT if k[0] == "b" else UPPER
        if WAYS[int(k[1:])] == "lost":  # marks that no word holds stay lost
            want, t = (re.sub(r"[^\w ]", "", x) for x in (want, t))
        if k == "B6":  # a word whose garbled letter is a usual one (Í read as Õ) is not suspect
            want = want.replace("CLÍNICA", "CLÕNICA")
        assert t == want, k
    assert encoding.garbled(d.limit(0)).count() == 0 == encoding.restored(d.limit(0)).count()


def test_lost_letters(spark):
    clean = [(f"c{i}", TEXT + " La ecografía de la región inguinal; después, día y también.") for i in range(6)]
    two = "ecograf�a y regi�n, evoluci�n cl�nica"
    three = "L� evoluci�n cl�nica despu�s de tres d�as, tambi�n «�rgano»"
    back = {r.clave: r.restored for r in encoding.restored(frame(spark, clean + [("two", two), ("three", three.replace("L�", "La")), ("one", "tumoraci�n qu�stica")])).collect()}
    assert back == {"two": "ecografía y región, evolución clínica", "three": "La evolución clínica después de tres días, también «órgano»", "one": "tumoración quística"}
    assert encoding.viterbi(["a", "áé", "b"], {"^a": -1.0, "aá": -2.0, "áb": -3.0}, -9.0) == (6.0, "aáb") and encoding.fitting("aéb", ["A", "áéÁÉ", "b"], {}, -1.0) == (3.0, "Aéb")


def test_search_decides(spark, monkeypatch):
    d = frame(spark, [(f"c{i}", TEXT) for i in range(6)] + [("b", garble(TEXT, WAYS[0])), ("lost", garble(TEXT, "lost"))])
    assert {r.clave for r in encoding.garbled(d).collect()} == {"b", "lost"}
    monkeypatch.setattr(encoding, "_clearer", lambda *_: 0.0)  # no reading is better spelt
    assert encoding.garbled(d).count() == 0


def test_one_word(spark):
    d = frame(spark, [(f"c{i}", TEXT) for i in range(5)] + [("one", "el riÃ±Ã³n izquierdo " + "palabra " * 50_000), ("lost", "el ri��n")])
    assert {r.clave: r.restored[:8] for r in encoding.restored(d).collect()}["one"] == "el riñón"
    assert {r.clave for r in encoding.garbled(d).collect()} == {"one", "lost"}


def test_a_third_in_one_code_page(spark):
    for code in ("cp850", "mac_roman", "cp437"):
        how = (code, "latin-1", 1)
        clean = [(f"c{i}", TEXT + " El tórax.") for i in range(20)] + [("fine", "5 µg/L ± 3 °C, Sjögren, Løvås, Jäger y Škoda")]
        bad = [(f"b{i}", garble(TEXT, how)) for i in range(10)] + [("rare", garble("neumotórax", how))]  # a word that the corpus lacks
        back = {r.clave: r.restored for r in encoding.restored(frame(spark, clean + bad)).collect()}
        assert set(back) == {k for k, _ in bad} and back["rare"] == "neumotórax", code
        assert all(t == TEXT for k, t in back.items() if k != "rare"), code


def brute_leaks(docs, items, run=12):
    words = lambda t: re.findall(r"[^\W_]+", "".join(c for c in unicodedata.normalize("NFD", t or "") if not unicodedata.combining(c)).lower())
    grams = lambda w: {tuple(w[i:i + run]) for i in range(len(w) - run + 1)}
    it = [(k, grams(words(t))) for k, t in items if k is not None]
    return {(d, k) for d, t in docs if (g := grams(words(t))) for k, h in it if g & h}


def test_leaks_equal_brute_force(spark):
    r = random.Random(9)
    vocab = ["de", "la", "el", "en", "y", "the", "of"] + [f"w{i}" for i in range(40)] + ["niño", "Año", "x1"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randrange(5, 40))) for i in range(30)] + [(90, None), (91, ""), (92, "de la el en y the of " * 3), (None, text(20))]
    docs = []
    for i in range(200):
        t = text(r.randrange(0, 60))
        if r.random() < 0.5:
            w = (r.choice(items)[1] or "").split()
            a = r.randrange(max(1, len(w) - 10))
            t += " ... " + ", ".join(w[a:a + r.randrange(8, 20)]).upper() + "\n> " + text(9)
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, docs[3][1]), (502, docs[3][1]), (503, "de la el en y the of " * 3000)]
    d = spark.createDataFrame([(k, t, 1, 2, "x") for k, t in docs], "doc_id bigint, text string, item int, shift int, at string")
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id bigint, texto string, term int")
    got = {(x.doc_id, x.item_id) for x in leakage.leaks(d, i).collect()}
    assert got == brute_leaks(docs, items) and len(got) >= 30
    assert leakage.leaks(d.limit(0), i).count() == 0 == leakage.leaks(d, i.limit(0)).count()
    report = {x.item_id: x.documents for x in leakage.item_report(leakage.leaks(d, i)).collect()}
    assert report == {k: sum(b == k for _, b in got) for k in {b for _, b in got}}


def test_proximity(spark):
    r = random.Random(12)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.sample(vocab, 30))) for i in range(12)]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(80))) for i in range(60)]
    changed = lambda t: " ".join(x if i % 5 else "otro" for i, x in enumerate(t.split()))  # noqa: E731  a word changed every few words
    grown = lambda t: " ".join(f"{x} nuevo" if i % 7 == 3 else x for i, x in enumerate(t.split()))
    docs += [(100 + i, "uno dos " + changed(t)) for i, t in items] + [(200 + i, grown(t) + " fin") for i, t in items] + [(300, None), (301, "")]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, texto string")
    assert leakage.leaks(d, e).count() == 0
    got = {(x.doc_id, x.item_id) for x in leakage.proximity(d, e).collect()}
    assert {(100 + i, i) for i, _ in items} | {(200 + i, i) for i, _ in items} <= got and len(got) <= 27
    assert leakage.proximity(d.limit(0), e).count() == 0 == leakage.proximity(d, e.limit(0)).count()


PROSE = "La paciente de {} años acudió por dolor en el abdomen y fue tratada con {} ciclos de quimioterapia, según el informe del hospital. En el control no se encontraron signos de recidiva, y la evolución fue buena hasta los {} meses. "
SPAM = [
    "seguro médico barato, seguro médico precio, oncólogo barato, oncólogo precio, seguro médico online, oncólogo online, " * 12,
    "\n".join(f"- clínica en ciudad {i} http://tienda{i}.example/p/{i}" for i in range(30)),
    " ".join(f"#seguromedico{i} #oncologo" for i in range(40)),
    "\n".join(f"Colágeno Premium {i} ml | SKU-{i}11 | S/ {i},90 | Añadir al carrito" for i in range(25)),
    "El mejor cheap scan en Lima ofrece cheap scan con descuento. ¿Por qué elegir cheap scan? Porque cheap scan en Lima es cheap scan de confianza. Si busca cheap scan, nuestro cheap scan es el cheap scan que necesita. " * 5,
]
FINE = [
    "Índice del número\n" + "\n".join(f"Sarcoma de {x}: serie breve ..... {i}" for i, x in enumerate("húmero riñón colon útero tórax ojo piel recto hígado".split())),
    "Referencias\n" + "\n".join(f"{i}. Pérez JA, Díaz M. Un título distinto {i}. Rev Med. 200{i};26(2):139-51. http://doi.example/{i}" for i in range(9)),
    "Glosario\n" + "\n".join(f"{x}: tumor que suele aparecer en la región y cursa con dolor de tipo {i}." for i, x in enumerate("Sarcoma Linfoma Melanoma Teratoma Adenocarcinoma Glioma".split())),
    " ".join(f"El sarcoma de {x} suele presentarse con {y}, y el sarcoma avanzado requiere {z}." for x, y, z in zip("riñón colon útero tórax".split(), "fiebre dolor tos mareo".split(), "biopsia cirugía citología reposo".split())),
]


def test_spam(spark):
    rows = [PROSE.format(i, i % 7, i % 30) * (1 + i % 3) for i in range(120)] + FINE + [None, "", " "] + SPAM
    d = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(rows)], "doc_id bigint, text string, bits int, seq string")
    assert {r.doc_id for r in spam.spam(d).collect()} == set(range(len(rows) - len(SPAM), len(rows)))
    bits = {r.doc_id: r.bits for r in spam.scores(d).collect()}
    assert len(bits) == len(rows) - 3 and all(bits[len(rows) - 1 - k] > bits[0] for k in range(len(SPAM)))
    assert spam.spam(d.limit(0)).count() == 0


def test_spam_is_decided_by_perplexity(spark, monkeypatch):
    lists = [PROSE.format(i, i % 7, i % 30).replace(". ", ", ") + "y así" for i in range(20)]  # no sentences to inform by, yet plain
    rows = [PROSE.format(i, i % 7, i % 30) for i in range(120)] + lists + SPAM
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    want = set(range(len(rows) - len(SPAM), len(rows)))
    assert not any(map(spam.informs, lists + SPAM)) and all(map(spam.informs, [*rows[:120], *FINE]))
    assert {r.doc_id for r in spam.spam(d).collect()} == want
    for constant in (1.0, 99.0):  # without the model nothing is found
        monkeypatch.setattr(spam.Model, "bits", lambda self, seqs, c=constant: [c] * len(seqs))
        assert {r.doc_id for r in spam.spam(d).collect()} != want


def test_spam_does_not_move_the_bound(spark):
    prose = [PROSE.format(i, i % 7, i % 30) * (1 + i % 3) for i in range(80)]
    table = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bound = lambda texts: next((r.centre, r.spread) for r in spam.scores(table(texts)).limit(1).collect())
    links = ["\n".join(f"http://a{i}.example/{k}" for k in range(1 + i % 7)) for i in range(40)]
    assert bound(prose + SPAM * 8) == bound(prose) == bound(prose + links)
    assert {r.doc_id for r in spam.spam(table(prose + links)).collect()} == set(range(80, 120))  # bare links, however few


def test_model_costs_do_not_grow_with_the_corpus():
    import numpy as np

    keys = np.array([5, 900, 70_000])
    seqs = ["", spam.classes("a b."), spam.classes("http://a.example/b #x #y")]
    small, large = (spam.Model(keys, np.array([1, 2, 3]) * k).bits(seqs) for k in (1, 10_000))
    assert small == large and small[0] == 0.0 and spam.Model(np.array([]), np.array([])).bits(seqs)[0] == 0.0
    assert spam.classes("a ..... b") == spam.classes("a . b") and len(spam.classes("http://a.example/b")) == 4
