"""Expected-dataset catalogue (what a complete landing zone should hold)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the portal's published dataset titles and module
# labels so that reconciliation gives the same answers. Kept in list order.
# ---------------------------------------------------------------------------
AIR_TITLES = [
    "Temperatura máxima absoluta",
    "Temperatura mínima absoluta",
    "Temperatura media",
    "Temperatura máxima media",
    "Temperatura mínima media",
    "Humedad relativa media mensual",
    "Radiación global media",
    "Índice UV-B promedio",
    "Concentración de Material Particulado fino respirable (MP2,5) media mensual",
    "Concentración de Material Particulado fino respirable (MP2,5) máxima horaria anual",
    "Concentración de Material Particulado fino respirable (MP2,5) mínima horaria anual",
    "Concentración de Material Particulado fino respirable (MP2,5) al Percentil 50",
    "Concentración de Material Particulado fino respirable (MP2,5) al Percentil 90",
    "Concentración de Material Particulado fino respirable (MP2,5) al Percentil 95",
    "Concentración de Material Particulado fino respirable (MP2,5) al Percentil 98",
    "Concentración de material particulado respirable (MP10) media mensual",
    "Concentración de material particulado respirable (MP10) máxima horaria anual",
    "Concentración de material particulado respirable (MP10) mínima horaria anual",
    "Concentración de material particulado respirable (MP10) al percentil 50",
    "Concentración de material particulado respirable (MP10) al percentil 90",
    "Concentración de material particulado respirable (MP10) al percentil 95",
    "Concentración de material particulado respirable (MP10) al percentil 98",
    "Concentración de ozono (O3) media mensual",
    "Concentración de ozono (O3) máxima horaria anual",
    "Concentración de ozono (O3) mínima horaria anual",
    "Concentración de ozono (O3) al percentil 50",
    "Concentración de ozono (O3) al percentil 90",
    "Concentración de ozono (O3) al percentil 95",
    "Concentración de ozono (O3) al percentil 98",
    "Concentración de ozono (O3) al percentil 99",
    "Concentración de dióxido de azufre (SO2) media mensual",
    "Concentración de dióxido de azufre (SO2) máxima horaria anual",
    "Concentración de dióxido de azufre (SO2) mínima anual",
    "Concentración de dióxido de azufre (SO2) al percentil 50",
    "Concentración de dióxido de azufre (SO2) al percentil 90",
    "Concentración de dióxido de azufre (SO2) al percentil 95",
    "Concentración de dióxido de azufre (SO2) al percentil 99",
    "Concentración de dióxido de nitrógeno (NO2) media mensual",
    "Concentración de dióxido de nitrógeno (NO2) máxima horaria anual",
    "Concentración de dióxido de nitrógeno (NO2) mínima horaria anual",
    "Concentración de dióxido de nitrógeno (NO2) al percentil 50",
    "Concentración de dióxido de nitrógeno (NO2) al percentil 90",
    "Concentración de Dióxido de Nitrógeno (NO2) al percentil 98",
    "Concentración de dióxido de nitrógeno (NO2) al percentil 99",
    "Concentración de monóxido de carbono (CO) media mensual",
    "Concentración de monóxido de carbono (CO) máxima horaria anual",
    "Concentración de monóxido de carbono (CO) mínima horaria anual",
    "Concentración de monóxido de carbono (CO) al percentil 50",
    "Concentración de monóxido de carbono (CO) al percentil 90",
    "Concentración de monóxido de carbono (CO) al percentil 95",
    "Concentración de monóxido de carbono (CO) al percentil 98",
    "Concentración de monóxido de carbono (CO) al percentil 99",
    "Concentración de monóxido de nitrógeno (NO) media mensua",
    "Concentración de monóxido de nitrógeno (NO) máxima horaria anual",
    "Concentración de monóxido de nitrógeno (NO) mínima horaria anual",
    "Concentración de monóxido de nitrógeno (NO) al percentil 50",
    "Concentración de monóxido de nitrógeno (NO) al percentil 90",
    "Concentración de monóxido de nitrógeno (NO) al percentil 98",
    "Concentración de monóxido de nitrógeno (NO) al percentil 99",
    "Concentración de óxidos de nitrógeno (NOx) media mensual",
    "Concentración de óxidos de nitrógeno (NOx) máxima horaria anual",
    "Concentración de óxidos de nitrógeno (NOx) mínima horaria anual",
    "Concentración de óxidos de nitrógeno (NOx) al percentil 50",
    "Concentración de óxidos de nitrógeno (NOx) al percentil 90",
    "Concentración de óxidos de nitrógeno (NOx) al percentil 98",
    "Concentración de óxidos de nitrógeno (NOx) al percentil 99",
    "Concentración de dióxido de azufre (SO2) al percentil 98",
    "Concentración de dióxido de nitrógeno (NO2) al percentil 95",
    "Concentración de monóxido de nitrógeno (NO) al percentil 95",
    "Concentración de óxidos de nitrógeno (NOx) al percentil 95",
    "Número de eventos de olas de calor",
]

WATER_TITLES = [
    "Caudal medio de aguas corrientes",
    "Volumen del embalse, según embalse",
    "Nivel estático de aguas subterráneas",
    "Cantidad de agua caída",
    "Altura de nieve equivalente en agua",
    "Evaporación real, según estación",
    "Número de glaciares, según cuenca hidrográfica",
    "Superficie de glaciares, según cuenca hidrográfica",
    "Volumen de hielo glaciar estimado, según cuenca hidrográfica",
    "Volumen de agua de glaciares estimada, según cuenca hidrográfica",
    "Nivel medio del mar",
    "Temperatura superficial del mar",
    "Concentración de metales disueltos en la matriz acuosa",
    "Concentración de coliformes fecales en matriz acuosa",
    "Concentración de metales totales en la matriz sedimentaria",
    "Concentración de coliformes fecales en matriz biológica",
]

# Scope keys and the module labels used by the reconciliation report.
SCOPE_AIR = "aire"
SCOPE_WATER = "agua"
RECONCILE_MODULE_LABELS = {
    SCOPE_AIR: "Módulo VBA - Estado - Aire",
    SCOPE_WATER: "Módulo VBA - Estado - Agua",
}
# Module labels of the crawl configuration (note the different spacing; key on
# scope, never on label).
CRAWL_MODULE_LABELS = {
    SCOPE_AIR: "Módulo VBA- Estado - Aire",
    SCOPE_WATER: "Módulo VBA- Estado- Agua",
}
# ---------------------------------------------------------------------------

SCOPES = (SCOPE_AIR, SCOPE_WATER)
CATALOG_SCHEMA = "idx INT, scope STRING, module STRING, title STRING"


def catalog_rows(scope: str | None = None) -> list[tuple[int, str, str, str]]:
    """Catalogue rows ``(idx, scope, module, title)`` in list order.

    ``scope`` is matched case- and space-insensitively; an unknown or empty
    scope yields the union of all scopes (air first, then water).
    """
    rows: list[tuple[int, str, str, str]] = []
    idx = 0
    for key, titles in ((SCOPE_AIR, AIR_TITLES), (SCOPE_WATER, WATER_TITLES)):
        for t in titles:
            rows.append((idx, key, RECONCILE_MODULE_LABELS[key], t))
            idx += 1
    wanted = (scope or "").strip().lower()
    if wanted in SCOPES:
        rows = [r for r in rows if r[1] == wanted]
    return rows


_CATALOGS: dict[tuple[int, str], DataFrame] = {}


def catalog(spark: SparkSession, scope: str | None = None) -> DataFrame:
    """The catalogue as a small local DataFrame (87 rows at most); the same
    object per session and scope, so facts derived from it are reused."""
    key = (id(spark), (scope or "").strip().lower())
    df = _CATALOGS.get(key)
    if df is None:
        df = spark.createDataFrame(catalog_rows(scope), CATALOG_SCHEMA)
        _CATALOGS[key] = df
    return df


def reconcile_scopes(scope: str) -> list[str]:
    """Scopes checked by a reconciliation run: ``all`` → both, else one."""
    if scope == "all":
        return list(SCOPES)
    if scope in SCOPES:
        return [scope]
    raise ValueError(f"scope must be one of all, {', '.join(SCOPES)}: {scope!r}")


def expected_counts(spark: SparkSession) -> DataFrame:
    """Expected titles per scope plus a total row (scope = NULL)."""
    return (catalog(spark).rollup("scope").agg(F.count("*").alias("n_expected")))
