"""Term lists and patterns, all of them default parameters of the operators that use them."""

from __future__ import annotations

# Stems that mark a title as oncological, strongly or weakly ("masa " keeps its blank).
ONCOLOGY_STRONG = (
    "carcinoma", "adenocarcinoma", "sarcoma", "linfoma", "leucemia", "melanoma", "mieloma", "blastoma", "glioma", "teratoma", "seminoma",
    "neoplasia", "neoplasico", "oncolog", "metastasis", "metastasico", "cancer", "carcinomatosis", "osteosarcoma", "liposarcoma",
)
ONCOLOGY_WEAK = ("tumor", "tumoral", "maligno", "malignidad", "masa ")

# Phrases of titles of case reports.
CASE_PHRASES = (
    "caso clinico", "reporte de caso", "reporte de un caso", "a proposito de un caso", "presentacion de un caso", "case report", "reporte de dos casos",
)

# Lines of the journal site above an article, upper case without accents.
SITE_LINES = (
    "SERVICIOS PERSONALIZADOS", "REVISTA", "ARTICULO", "INDICADORES", "LINKS RELACIONADOS", "COMPARTIR", "OTROS", "COMO CITAR ESTE ARTICULO",
    "SCIELO ANALYTICS", "GOOGLE SCHOLAR H5M5 (2018)",
)

# Section headings, upper case without accents, by the section they open.
SECTIONS = {
    "Resumen": ("RESUMEN",),
    "Abstract(EN)": ("SUMMARY", "ABSTRACT"),
    "Palabras clave": ("PALABRAS CLAVE", "PALABRAS CLAVES", "PALABRAS-CLAVE"),
    "Key words": ("KEY WORDS", "KEYWORDS"),
    "Introducción": ("INTRODUCCION", "INTRODUCTION", "ANTECEDENTES"),
    "Materiales y métodos": (
        "MATERIAL Y METODOS", "MATERIALES Y METODOS", "MATERIAL Y METODO", "PACIENTES Y METODOS", "METODOS", "METODOLOGIA", "METODO",
        "MATERIALS AND METHODS", "METHODS",
    ),
    "Resultados": ("RESULTADOS", "RESULTADO", "RESULTS"),
    "Discusión": ("DISCUSION", "DISCUSSION", "DISCUSION Y CONCLUSIONES"),
    "Conclusiones": ("CONCLUSIONES", "CONCLUSION", "CONCLUSIONS"),
    "Caso clínico": (
        "CASO CLINICO", "REPORTE DE CASO", "REPORTE DE CASOS", "PRESENTACION DEL CASO", "PRESENTACION DE CASO", "DESCRIPCION DEL CASO",
        "CASE REPORT", "CASE PRESENTATION", "CASE",
    ),
    "Referencias": ("REFERENCIAS BIBLIOGRAFICAS", "BIBLIOGRAFIA", "REFERENCIAS", "REFERENCES"),
    "Agradecimientos": ("AGRADECIMIENTOS", "ACKNOWLEDGMENTS", "ACKNOWLEDGEMENTS"),
}

# Labels of article types, upper case without accents, by type.
TYPES = {
    "Reporte de caso": (
        "REPORTE DE CASO", "REPORTE DE CASOS", "REPORTES DE CASOS", "CASO CLINICO", "NOTA CLINICA", "REPORTE DE CASO CLINICO", "CASE REPORT",
        "CLINICAL CASE", "CASE REPORTS",
    ),
    "Artículo original": ("ARTICULO ORIGINAL", "ARTICULOS ORIGINALES", "TRABAJO ORIGINAL", "ORIGINAL", "TRABAJOS ORIGINALES", "ORIGINAL ARTICLE"),
    "Revisión": ("ARTICULO DE REVISION", "REVISION", "REVISION DE TEMA", "REVIEW", "REVIEW ARTICLE"),
    "Editorial": ("EDITORIAL",),
    "Carta al editor": ("CARTA AL EDITOR", "CARTAS AL EDITOR", "LETTER TO THE EDITOR"),
    "Comunicación corta": ("COMUNICACION CORTA", "COMUNICACION BREVE", "COMUNICACIONES CORTAS"),
    "Imágenes en medicina": ("IMAGENES", "IMAGENES EN MEDICINA"),
    "Historia de la medicina": ("HISTORIA DE LA MEDICINA",),
    "Simposio": ("SIMPOSIO",),
    "Actualización": ("ACTUALIZACION",),
    "Artículo especial": ("ARTICULO ESPECIAL",),
    "Sección especial": ("SECCION ESPECIAL",),
}

# Names of journals by ISSN.
JOURNALS = {
    "0034-8597": "Revista de Neuro-Psiquiatría",
    "1018-130X": "Revista Médica Herediana",
    "1019-4355": "Revista Estomatológica Herediana",
    "1022-5129": "Revista de Gastroenterología del Perú",
    "1025-5583": "Anales de la Facultad de Medicina (UNMSM)",
    "1609-9117": "Revista de Investigaciones Veterinarias del Perú (RIVEP)",
    "1726-4634": "Revista Peruana de Medicina Experimental y Salud Pública",
    "1727-558X": "Horizonte Médico (Lima)",
    "1728-5917": "Acta Médica Peruana",
    "2227-4731": "Revista del Cuerpo Médico Hospital Nacional Almanzor Aguinaga Asenjo",
    "2304-5132": "Revista Peruana de Ginecología y Obstetricia",
    "2308-0531": "Revista de la Facultad de Medicina Humana (URP)",
    "2313-2957": "Revista de Investigaciones Altoandinas",
    "2413-4465": "Interacciones (Revista de avances en Psicología)",
}

# Words of English titles and headings of English bodies.
ENGLISH_TITLE_WORDS = ("of", "the", "with", "and", "case", "report", "primary", "syndrome", "tumor")
ENGLISH_HEADINGS = ("case report", "case presentation", "introduction", "discussion", "materials and methods", "results", "background")

# Patterns of headings at which the narrative begins and ends, in order of precedence at equal places. {w} is white space.
STARTS = (
    ("introduccion", r"introducci[oó]n\b"),
    ("presentacion_caso", r"presentaci[oó]n{w}+de{w}*l?{w}+caso\b"),
    ("caso_clinico", r"caso{w}+cl[ií]nic[oa]\b"),
    ("reporte_caso", r"reporte{w}+de{w}*l?{w}+caso\b"),
    ("descripcion_caso", r"descripci[oó]n{w}+de{w}*l?{w}+caso\b"),
    ("antecedentes", r"antecedentes\b"),
)
ENDS = (
    ("referencias", r"referencias({w}+bibliogr[aá]ficas)?\b"),
    ("bibliografia", r"bibliograf[ií]a\b"),
    ("references", r"references\b"),
    ("correspondencia", r"correspondencia\b"),
    ("agradecimientos", r"agradecimiento"),
    ("conflicto_interes", r"conflicto[s]?{w}+de{w}+inter[eé]s"),
    ("financiamiento", r"(financiamiento|fuente[s]?{w}+de{w}+financiamiento)\b"),
    ("declaracion", r"declaraci[oó]n"),
    ("recibido", r"(recibido|aceptado){w}*:"),
)
ENGLISH_ABSTRACT = r"(abstract|summary)\b"
INTRODUCTION = r"introducci[oó]n\b"
TYPE_STARTS = ("reporte_caso", "caso_clinico", "presentacion_caso", "descripcion_caso")

# Folded lines of the journal site inside a text.
SITE_NOISE = (
    "servicios personalizados", "revista", "articulo", "indicadores", "citado por scielo", "links relacionados", "similares en scielo", "compartir",
    "como citar este articulo", "scielo analytics",
)
# Words that open a caption.
CAPTIONS = r"(foto|figura|fig\.?|tabla|cuadro|gr[aá]fico|imagen|l[aá]mina|esquema)"

# Categories of entities.
ENTITY_LABELS = ("ENFERMEDAD", "SINTOMA", "PROCEDIMIENTO", "MEDICAMENTO", "MORFOLOGIA")
