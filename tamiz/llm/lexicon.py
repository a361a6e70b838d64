"""Word lists of the text operators: fixed values, stated as text.

Every list is a default argument of the operator that uses it; pass another one for other languages or sites.
"""

from __future__ import annotations

# Frequent function words of the languages told apart, as the seed for labelling training lines.
FUNCTION_WORDS: dict[str, str] = {
    "es": "de la el en y a los las que un una se con por del al no es su para como más lo o sin sobre entre desde hasta hacia fue ha han está fueron ni este esta cuando pero muy tras según durante debe",
    "en": "the of and to in a is was were with that for on as by at from this be are an or it which has had have not no when he she his her their they we did does any most each other than then",
    "pt": "de a o e do da em que os as um uma com não para por ao na no dos das se foi mais como mas sem sobre entre até são pelo pela nos nas à às é ou seu sua foram havia tem têm há",
    "fr": "de la le les et des en du un une à dans est par pour avec sur au aux ce cette qui que ne pas plus son sa ses ou a été chez moins il elle se dont après ont",
    "it": "di il la e che in un una per con del della non è le i gli da al nel dei delle alla sono si come più o ma su anche dalla ha dopo",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie",
}

# Names and codes by which a label names a language.
LANGUAGE_NAMES: dict[str, str] = {
    "es": "es spa esp español espanol spanish castellano castilian espagnol espanhol",
    "en": "en eng ingles inglés english anglais inglês",
    "pt": "pt por portugues portugués português portuguese portugais",
    "fr": "fr fra fre frances francés français french francais francês",
    "it": "it ita italiano italian italien",
    "de": "de deu ger aleman alemán german deutsch allemand alemão",
}

# Labels of site navigation, written without accents.
NAVIGATION = (
    "inicio|indice|archivo|archivos|autores|autor|idioma|idiomas|avisos|aviso legal|numero actual|numeros anteriores|contacto|contactenos|"
    "buscar|busqueda|ayuda|normas|envios|registrarse|registro|iniciar sesion|cerrar sesion|estadisticas|mapa del sitio|acerca de|"
    "comite editorial|equipo editorial|menu|prensa|accesibilidad|privacidad|reclamos|terminos|terminos y condiciones|politica de cookies|"
    "politica de privacidad|configurar privacidad|aceptar todas|aceptar|rechazar|configurar|mas informacion|descargar pdf|ver en html|"
    "imprimir|enviar por correo|enviar|correo|compartir|copiar enlace|mensajeria|facebook|twitter|whatsapp|linkedin|telegram|"
    "volver arriba|subir|anterior|siguiente|siguiente articulo|articulo anterior|reportar un error|deje un comentario|comentarios|"
    "suscribirse|suscripcion|home|about|contact|search|login|log in|register|current issue|archives|print|share|help|sitemap|menu principal|"
    "home page|privacy|privacy policy|terms of use|cookies|usamos cookies|de acuerdo|portada|noticias|servicios|servicios personalizados|"
    "citas|metricas|enlaces relacionados|rss|tamano de letra"
)

# Headings of side columns and of lists of other articles, written without accents.
SIDE_HEADINGS = (
    "lo mas leido|articulos similares|articulos relacionados|recomendados para usted|temas relacionados|del mismo autor|"
    "mas articulos de este numero|tambien le puede interesar|indicadores|compartir|comparta|mas leidos|related articles|"
    "most read|you may also like|recommended|share"
)

# Phrases that only a page around an article holds. \S stands where an accent or its garbling may be.
PAGE_PHRASES = (
    r"cookies?\b|rastreadores|almacena preferencias|datos de navegaci|su visita de forma|acepta su uso|experiencia de lectura|"
    r"retirar su permiso|avisos afines|derechos reservados|all rights reserved|licencia abierta|published with permission|"
    r"dep\S{1,3}sito legal|ceden los derechos|fondo editorial|responsabilidad exclusiva|copyright|unidad de publicaciones|"
    r"equipo de redacci|sitio desarrollado|en tus redes|con sus colegas|comparta este|comparte este|suscr\S{1,3}base|bolet\S{1,3}n (?:mensual|semanal|de novedades)|"
    r"newsletter|share this|s\S{1,3}guenos|follow us|visitante n|ltima actualizaci|last updated|recuperado de http|retrieved from http|"
    r"correspondencia editorial|saltar al contenido|skip to (?:main )?content|volver arriba|back to top|tama\S{1,3}o de letra|"
    r"anterior \W{1,3} ?siguiente|pol\S{1,3}tica de (?:cookies|privacidad)|issn (?:impreso|electr)|powered by|"
    r"siguiente art\S{1,3}culo|enviar por correo|descargar pdf|reportar un error|deje un comentario|n\S{1,3}mero actual|mapa del sitio|iniciar sesi|comit\S{1,3} editorial"
)

# Words of which each phrase above holds at least one; lines without any of them are not searched.
PAGE_TRIGGERS = (
    "cookie cookies rastreadores almacena datos visita acepta experiencia retirar afines derechos reserved licencia permission legal ceden fondo "
    "exclusiva copyright unidad equipo sitio redes colegas comparta comparte mensual semanal novedades newsletter share siguenos follow visitante "
    "actualizacion updated recuperado retrieved editorial saltar skip arriba top letra anterior privacidad issn powered siguiente correo pdf error comentario "
    "actual iniciar ltima"
)

# Openings of keyword lines, captions and reference headings, written without accents.
KEYWORD_OPENINGS = "palabras clave|palabras-clave|keywords|key words|mots-cles|mots cles|palavras-chave|palavras chave|descriptores|unitermos"
CAPTION_OPENINGS = r"figura|fig\.|figure|tabla|table|tableau|tabela|cuadro|grafico|grafica|foto|imagen|anexo|quadro"
REFERENCE_HEADINGS = "referencias|bibliografia|references|referencias bibliograficas|references bibliographiques|literatura citada|bibliography"
SECTION_HEADINGS = (
    "resumen|abstract|summary|resume|resumo|introduccion|introduction|introducao|antecedentes|caso clinico|case report|case presentation|cas clinique|"
    "relato de caso|reporte de caso|presentacion del caso|descripcion del caso|nota clinica|articulo original|discusion|discussion|discussao|"
    "conclusion|conclusiones|conclusions|conclusao|conclusoes|metodos|methods|resultados|results|agradecimientos|material y metodos"
)
