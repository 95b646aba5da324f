"""DuckDB SQL oracles, one per registered query (same column names, whole tables).

Where the Spark query renders markup, the oracle computes the expected value straight from the
source columns (by construction), so a wrong extraction shows as a difference.
"""

from __future__ import annotations

from ..functions.text import WS_CLASS
from ..operators.notify import DEFAULT_FLAG, FLAGS
from .standins import (CATALOGUE_YEAR, COUNTRIES, DAY_CUTOFF, DETAIL_BASE, FEED_ITEMS, MIN_DATE, MONTHS_ES,
                       PAGE_CARDS, RUN_YEAR, SELECTION, TABLE_ROWS)

_WS_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
WS = "(" + "||".join(f"chr({c})" for c in _WS_CODES) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS_CLASS}+', ' ', 'g'), ' ')"


def dec(x: str) -> str:
    for a, b in (("&quot;", '"'), ("&#x27;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def esc(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def lead30(x: str) -> str:
    return f"array_to_string(list_slice(string_split({collapse(x)}, ' '), 1, 30), ' ')"


COUNTRY_LIST = lst(COUNTRIES)
FLAG_CASE = "CASE pais " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FLAGS.items()) + f" ELSE '{DEFAULT_FLAG}' END"
ORDER_TS = "(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60))"
ISO_FECHA = (f"CASE WHEN o_orderkey % 17 = 0 THEN 'Sin fecha' WHEN o_orderkey % 13 = 0 THEN strftime({ORDER_TS}, '%Y-%m-%dT%H:%M:%S') "
             f"ELSE strftime({ORDER_TS}, '%d-%m-%Y %H:%M') END")
ISO_PARSED = "(o_orderkey % 17 <> 0 AND o_orderkey % 13 <> 0)"
MEXICO_FECHA = ("CASE WHEN o_orderkey % 7 = 0 THEN 'Sin Fecha' WHEN o_orderkey % 13 = 0 THEN '32' || strftime(o_orderdate, '%m%Y') "
                "ELSE strftime(o_orderdate, '%d-%m-%Y') END")
EVENT_ALERTS = """(SELECT 'https://alerts.example.org/' || user_id || '/' || event_type AS url,
        event_type || ' ' || event_id AS titulo, strftime(ts, '%d-%m-%Y %H:%M') AS fecha, event_type AS pais,
        'inst' || (user_id % 5) AS institucion, event_id AS item_pos, user_id FROM events)"""
DOC_ALERTS = f"""(SELECT doc_id, 'https://docs.example.org/' || source || '/' || doc_id AS url,
        CASE WHEN doc_id % 3 = 0 THEN 'https://docs.example.org/pdf/' || doc_id || '.pdf' WHEN doc_id % 3 = 1 THEN '' END AS pdf,
        source || ' #' || doc_id AS titulo, lang AS fecha, {COUNTRY_LIST}[doc_id % 8 + 1] AS pais,
        'Agencia <' || source || '> & "co" ''x''' AS institucion, text FROM documents)"""
ROUTED = f"""(SELECT *, CASE WHEN content_type = 'html' THEN url WHEN pais = 'Perú' AND coalesce(pdf, '') <> '' THEN pdf ELSE url END AS content_key
        FROM (SELECT *, CASE WHEN pais IN ('Argentina', 'Brasil') THEN 'html' ELSE 'pdf' END AS content_type FROM {DOC_ALERTS}))"""
REPORT = f"""(SELECT 'https://alerts.example.org/e/' || event_id AS url, event_type || ' ' || event_id AS titulo,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS fecha, event_type AS pais,
        'inst' || (user_id % 5) AS institucion FROM events)"""
REPORT_F = f"(SELECT * FROM {REPORT} WHERE fecha >= DATE '{MIN_DATE}')"
REPORT_S = f"(SELECT * FROM {REPORT_F} WHERE pais IN {tuple(SELECTION)})"
PAGES_LANG = "(SELECT page_id, url, html, regexp_extract(url, '/([a-z]{2})/', 1) AS lang FROM pages)"
H1 = collapse(dec("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))
ARTICLE = collapse(dec("regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g')"))
NAV_ITEMS = "regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href=\"[^\"]*\">([^<]*)</a>', 1)"
HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"
DETAIL_HOST = DETAIL_BASE.split("/alertas/")[0]
DETAILS = f"""(SELECT p_partkey AS page_id, '{DETAIL_BASE}' || p_partkey || '/' AS url,
        CASE WHEN p_partkey % 5 = 0 THEN 'Sin detalle en H3' ELSE {strip('p_name')} END AS motivo,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE {strip('p_brand')} || {strip('p_type')} END AS producto,
        CASE WHEN p_partkey % 4 = 0 THEN '{DETAIL_HOST}/otros.pdf'
             WHEN p_partkey % 10 = 0 THEN '{DETAIL_BASE}' || p_partkey || '/info.html'
             WHEN p_partkey % 6 = 0 THEN '{DETAIL_BASE}' || p_partkey || '/docs/' || p_partkey || '.pdf'
             WHEN p_partkey % 9 = 0 THEN '{DETAIL_BASE}files/' || p_partkey || '.pdf'
             ELSE '{DETAIL_HOST}/docs/' || p_partkey || '.pdf' END AS pdf FROM part)"""
DETAIL_JOIN = f"""(SELECT d.doc_id, d.source || ' #' || d.doc_id AS t, '{DETAIL_BASE}' || (d.doc_id * 3) || '/' AS url,
        x.motivo, x.producto, x.pdf, x.page_id FROM documents d LEFT JOIN {DETAILS} x ON x.url = '{DETAIL_BASE}' || (d.doc_id * 3) || '/')"""
CONTENT = f"""(SELECT conv_id, nullif({collapse("string_agg(text, ' ' ORDER BY turn)")}, '') AS content
        FROM conversations WHERE turn < 3 AND text <> '' GROUP BY conv_id)"""


def _url_forms() -> str:
    base = "regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)(\\?([^#]*))?', {})"
    sch, host, path, q = (base.format(i) for i in (1, 2, 3, 5))
    d = f"regexp_replace({path}, '[^/]*$', '')"
    up = f"regexp_replace({d}, '[^/]*/$', '')"
    root = f"{sch} || '://' || {host}"
    forms = [
        ("b.pdf", f"{root} || {d} || 'b.pdf'"),
        ("../x.pdf", f"{root} || {up} || 'x.pdf'"),
        ("//cdn.example.org/x.pdf", f"{sch} || '://cdn.example.org/x.pdf'"),
        ("?q=1", f"{root} || {path} || '?q=1'"),
        ("#f", f"{root} || {path} || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END || '#f'"),
        ("./y.pdf", f"{root} || {d} || 'y.pdf'"),
        ("a/../b.pdf?x=/../1", f"{root} || {d} || 'b.pdf?x=/../1'"),
        ("../../../z", f"{root} || '/z'"),
        ("", "url"),
        ("http://o.example/x", "'http://o.example/x'"),
    ]
    parts = [f"SELECT page_id, '{f}' AS link, {e} AS resolved FROM pages" for f, e in forms]
    parts.append("SELECT page_id, NULL AS link, url AS resolved FROM pages")
    parts.append(f"""SELECT page_id, h AS link, {root} || h AS resolved
        FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages)""")
    return " UNION ALL ".join(parts)


def _catalogue() -> str:
    y, mx, ar = CATALOGUE_YEAR, "https://www.gob.mx/cofepris/documentos/alertas-sanitarias-de-", "https://www.argentina.gob.ar/anmat/alertas/"
    cr = "https://www.ministeriodesalud.go.cr/index.php/biblioteca-de-archivos-left/documentos-ministerio-de-salud/alertas-sanitarias/"
    cl = "https://www.ispch.gob.cl/categorias-alertas/"
    bo = "https://apiwww.agemed.gob.bo/api/web/"
    # The 21 listing addresses, written out apart from the operator's table.
    rows = [
        ("peru", 1, "NULL", 1, "https://www.digemid.minsa.gob.pe/webDigemid/publicaciones/alertas-modificaciones/feed/?paged=1"),
        ("chile", 2, "'Alerta Medicamentos'", 1, f"{cl}anamed/feed/"),
        ("chile", 2, "'Alerta Dispositivos Medicos'", 2, f"{cl}dispositivos-medicos/feed/"),
        ("chile", 2, "'Alerta Desinfectantes'", 3, f"{cl}desinfectantes-y-sanitizantes/feed/"),
        ("brasil", 3, "NULL", 1, "https://antigo.anvisa.gov.br/alertas"),
        ("colombia", 4, "NULL", 1, "https://app.invima.gov.co/alertas/alertas-sanitarias-general?field_tipo_de_documento_value=2&field_a_o_value=1"),
        ("mexico", 5, "'Dispositivos Médicos'", 1, f"{mx}dispositivos-medicos"),
        ("mexico", 5, "'Medicamentos'", 2, f"{mx}medicamentos"),
        ("mexico", 5, "'Alimentos'", 3, f"{mx}alimentos"),
        ("mexico", 5, "'Bebidas Alcoholicas'", 4, f"{mx}bebidas-alcoholicas"),
        ("mexico", 5, "'Suplementos Alimenticios'", 5, f"{mx}suplementos-alimenticios"),
        ("argentina", 6, "'Medicamentos'", 1, f"{ar}medicamentos/noticias"),
        ("argentina", 6, "'Alimentos'", 2, f"{ar}alimentos/noticias"),
        ("argentina", 6, "'Productos Médicos'", 3, f"{ar}productosmedicos/noticias"),
        ("argentina", 6, "'Cosmeticos'", 4, f"{ar}cosmeticos/noticias"),
        ("argentina", 6, "'Domisanitarios'", 5, f"{ar}domisanitarios/noticias"),
        ("bolivia", 7, "'Vigilancia y Control'", 1, f"{bo}vigilanciacontrol%7Ccontenido"),
        ("bolivia", 7, "'Seguridad (DTU)'", 2, f"{bo}dtu%7Ccontenido"),
        ("costarica", 8, "'Radiológica'", 1, f"{cr}alertas-radiologicas"),
        ("costarica", 8, "'Productos Mercado'", 2, f"{cr}alertas-por-productos-en-el-mercado/{y}-advertencias-por-productos-en-el-mercado"),
        ("costarica", 8, "'Farmacovigilancia'", 3, f"{cr}alertas-farmacovigilancia/advertencias-farmacovigilancia-{y}"),
    ]
    vals = ", ".join(f"('{s}', {r}, {c}, {k}, '{u}')" for s, r, c, k, u in rows)
    return f"""SELECT s.source_id, CAST(s.source_rank AS INTEGER) AS source_rank, s.categoria, CAST(s.categoria_rank AS INTEGER) AS categoria_rank,
        1 AS page, s.url, d.n_known FROM (VALUES {vals}) s(source_id, source_rank, categoria, categoria_rank, url)
        LEFT JOIN (SELECT doc_id % 8 + 1 AS source_rank, count(*) AS n_known FROM documents GROUP BY 1) d ON d.source_rank = s.source_rank"""


def _union_sources() -> str:
    sids = ["peru", "chile", "brasil", "colombia", "mexico", "argentina", "bolivia", "costarica"]
    inst = ["DIGEMID", "ISPCH", "ANVISA", "INVIMA", "COFEPRIS", "ANMAT", "AGEMED", "MinSalud"]
    return f"""SELECT doc_id, 'https://' || {lst(sids)}[doc_id % 8 + 1] || '.example.org/' || doc_id AS url,
        {COUNTRY_LIST}[doc_id % 8 + 1] AS pais, {lst(inst)}[doc_id % 8 + 1] AS institucion,
        CAST(doc_id % 8 + 1 AS INTEGER) AS source_rank,
        CASE WHEN doc_id % 8 = 0 THEN 'https://peru.example.org/' || doc_id || '.pdf' END AS pdf FROM documents"""


def _outbox(where: str = "") -> str:
    link = "CASE WHEN coalesce(url, '') <> '' THEN '🔗 ' || url WHEN coalesce(pdf, '') <> '' THEN '📥 ' || pdf ELSE '' END"
    msg = (f"{FLAG_CASE} || ' <b>NUEVA ALERTA - ' || pais || '</b>' || chr(10) || '🏛 <b>Institución:</b> ' || {esc('institucion')} "
           f"|| chr(10) || '📅 <b>Fecha:</b> ' || fecha || chr(10) || chr(10) || '⚠️ <b>' || {esc('titulo')} || '</b>' || chr(10) || chr(10) || {link}")
    return f"SELECT url, {msg} AS message, '0' AS batch_id FROM {DOC_ALERTS} {where}"


CR_MONTH = f"{lst(MONTHS_ES)}[o_orderkey % 12 + 1]"
# table pages: blocks of TABLE_ROWS consecutive order keys, so page order then row order is key order
TABLE_PAGES = f"(SELECT *, o_orderkey // {TABLE_ROWS} AS pg FROM orders)"
CR_TITLE = (f"CASE WHEN o_orderkey % 19 = 0 THEN 'Sin título' WHEN o_orderkey % 5 = 3 "
            f"THEN lower((o_orderkey % 28 + 1) || ' de ' || {CR_MONTH} || '. alerta ' || o_orderkey || ' retiro & aviso') "
            f"ELSE 'Alerta ' || o_orderkey || ' retiro & aviso' END")
CR_PREFIX_DOC = f"""CASE doc_id % 5 WHEN 0 THEN (doc_id % 28 + 1) || ' de ' || {lst(MONTHS_ES)}[doc_id % 12 + 1] || ' de 2025. '
    WHEN 1 THEN (doc_id % 28 + 1) || ' DE ' || upper({lst(MONTHS_ES)}[doc_id % 12 + 1]) || ' de 2024- '
    WHEN 2 THEN (doc_id % 28 + 1) || ' de ' || {lst(MONTHS_ES)}[doc_id % 12 + 1] || ' '
    WHEN 3 THEN (doc_id % 28 + 1) || ' de ' || {lst(MONTHS_ES)}[doc_id % 12 + 1] || '. ' ELSE '' END"""
# Fixed value: the leading Spanish date of Costa Rica titles.
CR_PATTERN = r"^\d{1,2}\s+de\s+[a-zA-Záéíóú]+\s+(?:de\s+\d{4})?[.\-]?\s*"


def _capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


MEX_DOC_D8 = ("CASE WHEN doc_id % 13 = 0 THEN '32' || substr(strftime(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER), '%d%m%Y'), 3, 6) "
              "ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER), '%d%m%Y') END")
MEX_DOC_RAW = f"CASE WHEN doc_id % 7 = 0 THEN text || '.pdf' ELSE '_ ' || text || ' _' || {MEX_DOC_D8} || '.pdf ' || source END"

ORACLES: dict[str, str] = {
    # string scalars
    "strip_ws": f"""SELECT doc_id, {strip("(CASE doc_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN chr(9) || chr(10) ELSE ' ' || chr(160) || chr(12288) END) || text || "
                                      "(CASE (doc_id + 1) % 3 WHEN 0 THEN '  ' WHEN 1 THEN chr(9) || chr(10) ELSE ' ' || chr(160) || chr(12288) END)")} AS value FROM documents""",
    "collapse_ws": f"SELECT doc_id, {collapse('text')} AS value FROM documents",
    "html_escape": f"SELECT page_id, {esc('html')} AS value FROM pages",
    "preview": "SELECT doc_id, left(text, 50) AS value FROM documents",
    "title_mexico": f"""SELECT doc_id, CASE WHEN d IS NULL THEN cut ELSE {strip("trim(replace(cut, d, ''), '_')")} END AS titulo
        FROM (SELECT doc_id, split_part(raw, '.pdf', 1) AS cut, nullif(regexp_extract(raw, '[0-9]{{8}}'), '') AS d
              FROM (SELECT doc_id, {MEX_DOC_RAW} AS raw FROM documents))""",
    "title_costarica": f"""SELECT doc_id, {_capitalize('s')} AS titulo FROM (SELECT doc_id,
        {strip(f"regexp_replace(({CR_PREFIX_DOC}) || text, '{CR_PATTERN}', '', 'i')")} AS s FROM documents)""",
    "url_absolute": _url_forms(),
    "flag_lookup": f"""SELECT c_custkey, pais, {FLAG_CASE} AS bandera FROM (SELECT c.c_custkey,
        CASE WHEN n.n_nationkey % 10 < 8 THEN {COUNTRY_LIST}[n.n_nationkey % 10 + 1] ELSE n.n_name END AS pais
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    # dates
    "date_brasil": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN '31/02/' || year(o_orderdate)
        ELSE strftime({ORDER_TS}, '%d-%m-%Y %H:%M') END AS fecha FROM orders""",
    "date_colombia": """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE strftime(o_orderdate, '%d-%m-%Y') END AS fecha,
        CASE WHEN o_orderkey % 13 = 0 THEN 'bad date' END AS error FROM orders""",
    "date_mexico": f"SELECT o_orderkey, {MEXICO_FECHA} AS fecha FROM orders",
    "date_argentina": f"SELECT o_orderkey, {ISO_FECHA} AS fecha FROM orders",
    "date_costarica": f"SELECT o_orderkey, {ISO_FECHA} AS fecha FROM orders",
    "date_bolivia": "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS fecha FROM orders WHERE o_orderkey % 13 <> 0",
    "year_filter_bolivia": f"""SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS fecha FROM orders
        WHERE o_orderkey % 13 <> 0 AND year(o_orderdate) = {RUN_YEAR}""",
    "year_filter_costarica": f"""SELECT o_orderkey, {ISO_FECHA} AS fecha FROM orders
        WHERE NOT {ISO_PARSED} OR year({ORDER_TS}) = {RUN_YEAR}""",
    # feeds
    "feed_items": f"""SELECT event_id // {FEED_ITEMS} AS feed_id,
        row_number() OVER (PARTITION BY event_id // {FEED_ITEMS} ORDER BY event_id) - 1 AS item_pos,
        event_type || ' ' || event_id AS titulo, 'https://feeds.example.org/e/' || event_id AS url,
        CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'Sin Fecha' ELSE strftime(ts, '%d-%m-%Y %H:%M:%S') END AS fecha FROM events""",
    "date_feed": """SELECT 'https://feeds.example.org/e/' || event_id AS url,
        CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'Sin Fecha' ELSE strftime(ts, '%d-%m-%Y %H:%M:%S') END AS fecha FROM events""",
    # listing cards and table rows
    "cards_brasil": f"""SELECT o_orderpriority AS categoria, '/alertas/' || o_orderkey AS url, 'Alerta ' || o_orderkey || ' & retiro' AS titulo,
        CASE WHEN o_orderkey % 13 = 0 THEN '31/02/' || year(o_orderdate) ELSE strftime({ORDER_TS}, '%d-%m-%Y %H:%M') END AS fecha,
        'Brasil' AS pais, 'ANVISA' AS institucion FROM orders WHERE o_orderkey % 11 <> 0""",
    "cards_colombia": """SELECT o_orderpriority AS categoria, '/files/' || o_orderkey || '.pdf' AS url, 'Alerta ' || o_orderkey || ' & retiro' AS titulo,
        strftime(o_orderdate, '%d-%m-%Y') AS fecha, 'Colombia' AS pais, 'INVIMA' AS institucion
        FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""",
    "cards_mexico": f"""SELECT o_orderpriority AS categoria, 'https://www.gob.mx/cofepris/documentos/' || o_orderkey || '.pdf' AS url,
        'Alerta ' || o_orderkey AS titulo, {MEXICO_FECHA} AS fecha, 'México' AS pais, 'COFEPRIS' AS institucion
        FROM orders WHERE o_orderkey % 11 <> 0""",
    "topn_per_category": f"""SELECT o_orderpriority AS categoria, count(*) AS n_alertas
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
        WHERE rn <= 10 AND o_orderkey % 11 <> 0 GROUP BY 1""",
    "cards_argentina": f"""SELECT o_orderpriority AS categoria, 'https://www.argentina.gob.ar/anmat/alertas/' || o_orderkey AS url,
        CASE WHEN o_orderkey % 11 = 0 THEN 'Sin título' ELSE 'Alerta ' || o_orderkey || '&retiro' END AS titulo,
        {ISO_FECHA} AS fecha, 'Argentina' AS pais, 'ANMAT' AS institucion FROM orders""",
    "rows_bolivia": f"""SELECT url, titulo, fecha FROM (
        SELECT 'https://www.agemed.gob.bo/archivo/' || (o_orderkey // 3) || '.pdf' AS url,
               o_orderkey || ' - Alerta & ' || o_orderstatus AS titulo, strftime(o_orderdate, '%d-%m-%Y') AS fecha,
               row_number() OVER (PARTITION BY o_orderkey // 3 ORDER BY pg DESC, o_orderkey DESC) AS rn
        FROM {TABLE_PAGES} WHERE o_orderkey % 13 <> 0 AND year(o_orderdate) = {RUN_YEAR} AND o_orderkey % 11 <> 0) WHERE rn = 1""",
    "rows_costarica": f"""SELECT url, titulo, fecha FROM (
        SELECT 'https://www.ministeriodesalud.go.cr/images/docs/' || (o_orderkey // 2) || '.pdf' AS url, {CR_TITLE} AS titulo,
               {ISO_FECHA} AS fecha,
               row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY pg DESC, o_orderkey DESC) AS rn
        FROM {TABLE_PAGES} WHERE o_orderkey % 11 <> 0 AND (NOT {ISO_PARSED} OR year({ORDER_TS}) = {RUN_YEAR})) WHERE rn = 1""",
    # generic HTML
    "html_blocks": """SELECT page_id, len(regexp_extract_all(html, '<[a-zA-Z][a-zA-Z0-9]*')) AS n_elements,
        len(regexp_extract_all(html, '<p[\\s>/]')) AS n_p, len(regexp_extract_all(html, '<a[\\s>/]')) AS n_a,
        len(regexp_extract_all(html, '<li[\\s>/]')) AS n_li FROM pages""",
    "html_select": f"""SELECT page_id, {strip(dec("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title,
        {strip(dec("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS h1,
        regexp_extract(html, '(?s)<nav>.*?<a href="([^"]*)"', 1) AS nav_href,
        {strip(dec("regexp_extract(html, '(?s)<nav>.*?<a href=\"[^\"]*\">([^<]*)</a>', 1)"))} AS nav_text,
        {strip(dec("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)"))} AS ad,
        {strip(dec("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)"))} AS footer FROM pages""",
    "element_text_modes": f"""SELECT page_id,
        array_to_string(list_transform({NAV_ITEMS}, lambda x: {strip(dec('x'))}), '') AS text_a,
        {strip(f"array_to_string(list_transform({NAV_ITEMS}, lambda x: {dec('x')}), '')")} AS text_b,
        array_to_string(list_filter(list_transform({NAV_ITEMS}, lambda x: {strip(dec('x'))}), lambda x: x <> ''), ' ') AS text_c FROM pages""",
    "rules_scan": f"""SELECT r.lang, r.content_type, r.container, r.selectors, r.remove, c.n_pages FROM
        (VALUES ('en', 'html', 'article', 'h1|p', 'b|script|style'), ('fr', 'html', NULL, 'h1|article', NULL),
                ('es', 'html', 'main', 'p', NULL)) r(lang, content_type, container, selectors, remove)
        JOIN (SELECT lang, count(*) AS n_pages FROM {PAGES_LANG} GROUP BY lang) c ON c.lang = r.lang""",
    "rules_join": f"""SELECT page_id, lang,
        CASE WHEN lang IN ('en', 'fr', 'es') THEN 'html' ELSE 'pdf' END AS content_type,
        CASE lang WHEN 'en' THEN 'article' WHEN 'es' THEN 'main' END AS container,
        CASE lang WHEN 'en' THEN 'h1|p' WHEN 'fr' THEN 'h1|article' WHEN 'es' THEN 'p' ELSE 'article|main|div.content' END AS selectors,
        CASE lang WHEN 'en' THEN 'b|script|style' ELSE 'script|style|nav|footer' END AS remove FROM {PAGES_LANG}""",
    "html_content": f"""SELECT page_id, lang, nullif(CASE lang WHEN 'en' THEN {H1} WHEN 'fr' THEN {collapse(f"{H1} || ' ' || {ARTICLE}")}
        WHEN 'es' THEN NULL ELSE {ARTICLE} END, '') AS content FROM {PAGES_LANG}""",
    # detail pages
    "detail_fields": f"SELECT page_id, url, motivo, producto, pdf FROM {DETAILS}",
    "detail_join": f"""SELECT doc_id, url, motivo, producto, pdf,
        CASE WHEN page_id IS NULL THEN 'detail page missing' WHEN pdf IS NULL THEN 'no pdf link on detail page' END AS fatal FROM {DETAIL_JOIN}""",
    "title_composite": f"""SELECT doc_id, CASE WHEN coalesce(motivo, '') <> '' AND producto IS NOT NULL THEN t || ' - ' || motivo || '. Productos: ' || producto
        WHEN coalesce(motivo, '') <> '' THEN t || ' - ' || motivo ELSE t END AS titulo FROM {DETAIL_JOIN}""",
    # history
    "history_scan": "SELECT 'doc://' || doc_id AS url, text AS titulo, lang AS fecha, source AS institucion FROM documents",
    "history_backfill": """SELECT 'doc://' || doc_id AS url, text AS titulo, lang AS fecha, 'Desconocido' AS pais, source AS institucion,
        '' AS resumen FROM documents""",
    "novelty": f"""SELECT url, titulo, fecha, pais, institucion, titulo AS resumen, item_pos FROM {EVENT_ALERTS} a
        WHERE NOT EXISTS (SELECT 1 FROM {EVENT_ALERTS} h WHERE h.user_id % 3 = 0 AND h.url = a.url)""",
    "history_merge": f"""SELECT url, titulo, CASE WHEN user_id % 3 = 0 THEN '' ELSE titulo END AS resumen, item_pos FROM
        (SELECT *, row_number() OVER (PARTITION BY url ORDER BY item_pos) AS rn FROM {EVENT_ALERTS}) WHERE rn = 1""",
    "dedupe_last": f"""SELECT url, arg_max(titulo, item_pos) AS titulo, min(item_pos) AS item_pos FROM
        (SELECT CASE WHEN item_pos % 50 = 0 THEN '' ELSE url END AS url, titulo, item_pos FROM {EVENT_ALERTS})
        WHERE url <> '' GROUP BY url""",
    "run_counters": f"""SELECT (SELECT count(DISTINCT url) FROM {EVENT_ALERTS} WHERE user_id % 3 = 0) AS history_rows,
        (SELECT count(*) FROM events) AS candidate_rows,
        (SELECT count(*) FROM {EVENT_ALERTS} WHERE user_id % 3 <> 0) AS novelty_rows,
        (SELECT count(DISTINCT url) FROM {EVENT_ALERTS}) AS updated_rows,
        (SELECT CAST(coalesce(sum(length(content)), 0) AS BIGINT) FROM {CONTENT}) AS content_chars""",
    # catalogue, gate, union
    "source_catalogue": _catalogue(),
    "status_gate": "SELECT page_id, url FROM pages WHERE page_id % 17 <> 0",
    "drop_failed_groups": f"""SELECT page_id, url, host FROM (SELECT page_id, url, {HOST} AS host FROM pages) p
        WHERE host NOT IN (SELECT {HOST} FROM pages WHERE page_id % 17 = 0)""",
    "quarantine": f"SELECT page_id, url, {HOST} AS host, 'HTTP 404' AS error FROM pages WHERE page_id % 17 = 0",
    "union_sources": _union_sources(),
    # content, summary, notify
    "content_route": f"SELECT doc_id, pais, content_type, content_key FROM {ROUTED}",
    "enrich": f"""SELECT r.doc_id, CASE WHEN r.doc_id % 3 <> 2 THEN coalesce(nullif({strip(lead30('r.text'))}, ''), r.titulo)
        ELSE r.titulo END AS resumen FROM {ROUTED} r""",
    "summary_fallback": f"""SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN d.source || ' #' || d.doc_id
        WHEN l.quality IS NOT NULL THEN coalesce(nullif({strip(lead30('d.text'))}, ''), d.source || ' #' || d.doc_id)
        ELSE d.source || ' #' || d.doc_id END AS resumen FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "summary_extractive": f"""WITH RECURSIVE d AS (SELECT doc_id AS k, {collapse('text')} AS t FROM documents),
        s AS (SELECT k, unnest(x) AS sentence, generate_subscripts(x, 1) AS sp
              FROM (SELECT k, string_split(regexp_replace(t, '([.!?…]) ', '\\1' || chr(10), 'g'), chr(10)) AS x FROM d WHERE t <> '')),
        p AS (SELECT k, sp, w, unnest(range(0, len(w), 30)) AS c FROM (SELECT k, sp, string_split(sentence, ' ') AS w FROM s)),
        u AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY sp, c) - 1 AS pos, len(w[c + 1:c + 30]) AS n, array_to_string(w[c + 1:c + 30], ' ') AS unit FROM p),
        o AS (SELECT k, pos, unnest(regexp_extract_all(lower(unit), '[\\p{{L}}\\p{{N}}]+')) AS term FROM u),
        tf AS (SELECT k, term, count(*) AS tf FROM o GROUP BY k, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT k, term, CAST(floor(1000.0 * (1 + ln(tf)) * ln(((SELECT count(DISTINCT k) FROM u) + 1.0) / df)) AS BIGINT) AS weight FROM tf JOIN df USING (term)),
        g AS (SELECT k, pos, list(struct_pack(term := term, weight := weight)) AS terms, CAST(sum(weight) AS BIGINT) AS total
              FROM (SELECT DISTINCT k, pos, term FROM o) JOIN w USING (k, term) GROUP BY k, pos),
        c AS (SELECT * FROM (SELECT u.*, g.terms, row_number() OVER (PARTITION BY k ORDER BY total // (n + 5) DESC, pos) AS r FROM u JOIN g USING (k, pos)) WHERE r <= 12),
        pick AS (
            SELECT DISTINCT k, 0 AS i, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS seen, CAST([] AS BIGINT[]) AS chosen FROM c
            UNION ALL
            SELECT k, i + 1, n + b.n, list_distinct(list_concat(seen, b.terms)), list_append(chosen, -b.before) FROM (
                SELECT p.k, p.i, p.n, p.seen, p.chosen, max(struct_pack(
                    gain := coalesce(list_sum(list_transform(list_filter(c.terms, lambda x: NOT list_contains(p.seen, x.term)), lambda x: x.weight)), 0) // (c.n + 5),
                    before := -c.pos, n := c.n, terms := list_transform(c.terms, lambda x: x.term))) AS b
                FROM pick p JOIN c ON c.k = p.k AND p.n + c.n <= 30 AND NOT list_contains(p.chosen, c.pos) WHERE p.n < 20
                GROUP BY p.k, p.i, p.n, p.seen, p.chosen) WHERE b.gain > 0)
        SELECT k AS doc_id, string_agg(unit, ' ' ORDER BY pos) AS summary
        FROM (SELECT k, unnest(arg_max(chosen, i)) AS pos FROM pick GROUP BY k) JOIN u USING (k, pos) GROUP BY k""",
    "summary_lead": f"SELECT doc_id, {lead30('text')} AS summary FROM documents",
    "doc_first_pages": f"SELECT conv_id, content FROM {CONTENT}",
    "outbox": _outbox(),
    "outbox_silent": _outbox("WHERE false"),
    # report
    "dash_dates": f"SELECT url, fecha FROM {REPORT}",
    "dash_filter": f"SELECT url, fecha, pais FROM {REPORT_F}",
    "dash_select": f"SELECT url, fecha, pais FROM {REPORT_S}",
    "dash_select_all": f"SELECT url, fecha, pais FROM {REPORT_F}",
    "kpis": f"""SELECT count(*) AS total_alertas, count(DISTINCT pais) AS paises_activos,
        strftime(max(fecha), '%d-%m-%Y') AS ultima_actualizacion FROM {REPORT_S}""",
    "by_country": f"SELECT pais AS \"País\", count(*) AS \"Cantidad\" FROM {REPORT_F} WHERE pais IS NOT NULL GROUP BY pais",
    "by_day": f"SELECT fecha, count(*) AS \"Alertas\" FROM {REPORT_F} GROUP BY fecha HAVING fecha > DATE '{DAY_CUTOFF}'",
    "countries": f"SELECT DISTINCT pais FROM {REPORT_F} WHERE pais IS NOT NULL",
    "detail": f"SELECT strftime(fecha, '%d-%m-%Y') AS fecha, pais, institucion, titulo, url FROM {REPORT_F}",
}

_FLAG_CONTENT = f"""(SELECT page_id, url, lang, {HOST} AS host,
        {strip(dec("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS titulo,
        nullif(CASE lang WHEN 'en' THEN {H1} WHEN 'fr' THEN {collapse(f"{H1} || ' ' || {ARTICLE}")}
            WHEN 'es' THEN NULL ELSE {ARTICLE} END, '') AS content FROM {PAGES_LANG} WHERE page_id % 3 <> 0)"""
FLAGSHIP_SQL = f"""SELECT url, '{DEFAULT_FLAG} <b>NUEVA ALERTA - Web</b>' || chr(10) || '🏛 <b>Institución:</b> ' || {esc('host')}
        || chr(10) || '📅 <b>Fecha:</b> ' || lang || chr(10) || chr(10) || '⚠️ <b>' || {esc('resumen')} || '</b>' || chr(10) || chr(10)
        || '🔗 ' || url AS message, '0' AS batch_id
    FROM (SELECT *, coalesce(nullif({strip(lead30('content'))}, ''), titulo) AS resumen FROM {_FLAG_CONTENT})"""
