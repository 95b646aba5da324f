"""Source catalogue — one row per source, category and listing page.

The listing addresses are fixed data of the eight sources; pages expand by
``explode(sequence(1, pages))`` and the run year is a parameter (never ``current_date`` inside a
check, so results are reproducible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The listing addresses of the eight sources, in source and category order
# ({page} and {year} are filled per row; a source without categories has one unnamed).
_MX = "https://www.gob.mx/cofepris/documentos/alertas-sanitarias-de-"
_AR = "https://www.argentina.gob.ar/anmat/alertas/"
_CR = "https://www.ministeriodesalud.go.cr/index.php/biblioteca-de-archivos-left/documentos-ministerio-de-salud/alertas-sanitarias/"
LISTINGS = [
    ("peru", 1, None, "https://www.digemid.minsa.gob.pe/webDigemid/publicaciones/alertas-modificaciones/feed/?paged={page}"),
    ("chile", 2, "Alerta Medicamentos", "https://www.ispch.gob.cl/categorias-alertas/anamed/feed/"),
    ("chile", 2, "Alerta Dispositivos Medicos", "https://www.ispch.gob.cl/categorias-alertas/dispositivos-medicos/feed/"),
    ("chile", 2, "Alerta Desinfectantes", "https://www.ispch.gob.cl/categorias-alertas/desinfectantes-y-sanitizantes/feed/"),
    ("brasil", 3, None, "https://antigo.anvisa.gov.br/alertas"),
    ("colombia", 4, None, "https://app.invima.gov.co/alertas/alertas-sanitarias-general?field_tipo_de_documento_value=2&field_a_o_value=1"),
    ("mexico", 5, "Dispositivos Médicos", _MX + "dispositivos-medicos"),
    ("mexico", 5, "Medicamentos", _MX + "medicamentos"),
    ("mexico", 5, "Alimentos", _MX + "alimentos"),
    ("mexico", 5, "Bebidas Alcoholicas", _MX + "bebidas-alcoholicas"),
    ("mexico", 5, "Suplementos Alimenticios", _MX + "suplementos-alimenticios"),
    ("argentina", 6, "Medicamentos", _AR + "medicamentos/noticias"),
    ("argentina", 6, "Alimentos", _AR + "alimentos/noticias"),
    ("argentina", 6, "Productos Médicos", _AR + "productosmedicos/noticias"),
    ("argentina", 6, "Cosmeticos", _AR + "cosmeticos/noticias"),
    ("argentina", 6, "Domisanitarios", _AR + "domisanitarios/noticias"),
    ("bolivia", 7, "Vigilancia y Control", "https://apiwww.agemed.gob.bo/api/web/vigilanciacontrol%7Ccontenido"),
    ("bolivia", 7, "Seguridad (DTU)", "https://apiwww.agemed.gob.bo/api/web/dtu%7Ccontenido"),
    ("costarica", 8, "Radiológica", _CR + "alertas-radiologicas"),
    ("costarica", 8, "Productos Mercado", _CR + "alertas-por-productos-en-el-mercado/{year}-advertencias-por-productos-en-el-mercado"),
    ("costarica", 8, "Farmacovigilancia", _CR + "alertas-farmacovigilancia/advertencias-farmacovigilancia-{year}"),
]


def catalogue(spark: SparkSession, run_year: int, pages: int = 1) -> DataFrame:
    """Rows (source_id, source_rank, categoria, categoria_rank, page, url); ``pages`` listing pages
    for the paged sources (the reference reads one)."""
    ranks: dict[str, int] = {}
    rows = []
    for source, rank, category, url in LISTINGS:
        ranks[source] = ranks.get(source, 0) + 1
        rows.append((source, rank, category, ranks[source], url))
    x = spark.createDataFrame(rows, "source_id string, source_rank int, categoria string, categoria_rank int, template string")
    n = F.when(F.contains("template", F.lit("{page}")), F.lit(pages)).otherwise(F.lit(1))
    x = x.select("*", F.explode(F.sequence(F.lit(1), n)).alias("page"))
    url = F.replace(F.replace(F.col("template"), F.lit("{page}"), F.col("page").cast("string")), F.lit("{year}"), F.lit(str(run_year)))
    return x.select("source_id", "source_rank", "categoria", "categoria_rank", "page", url.alias("url"))
