"""Fixed values of the oracle, stated here on their own: catalogue, rule table, words.

Nothing is imported from the code under test; a slip on either side shows.
"""

# FIXED VALUES
_TITLES_0 = (
    'Temperatura máxima absoluta',
    'Temperatura mínima absoluta',
    'Temperatura media',
    'Temperatura máxima media',
    'Temperatura mínima media',
    'Humedad relativa media mensual',
    'Radiación global media',
    'Índice UV-B promedio',
    'Concentración de Material Particulado fino respirable (MP2,5) media mensual',
    'Concentración de Material Particulado fino respirable (MP2,5) máxima horaria anual',
    'Concentración de Material Particulado fino respirable (MP2,5) mínima horaria anual',
    'Concentración de Material Particulado fino respirable (MP2,5) al Percentil 50',
    'Concentración de Material Particulado fino respirable (MP2,5) al Percentil 90',
    'Concentración de Material Particulado fino respirable (MP2,5) al Percentil 95',
    'Concentración de Material Particulado fino respirable (MP2,5) al Percentil 98',
    'Concentración de material particulado respirable (MP10) media mensual',
    'Concentración de material particulado respirable (MP10) máxima horaria anual',
    'Concentración de material particulado respirable (MP10) mínima horaria anual',
    'Concentración de material particulado respirable (MP10) al percentil 50',
    'Concentración de material particulado respirable (MP10) al percentil 90',
    'Concentración de material particulado respirable (MP10) al percentil 95',
    'Concentración de material particulado respirable (MP10) al percentil 98',
    'Concentración de ozono (O3) media mensual',
    'Concentración de ozono (O3) máxima horaria anual',
    'Concentración de ozono (O3) mínima horaria anual',
    'Concentración de ozono (O3) al percentil 50',
    'Concentración de ozono (O3) al percentil 90',
    'Concentración de ozono (O3) al percentil 95',
    'Concentración de ozono (O3) al percentil 98',
    'Concentración de ozono (O3) al percentil 99',
    'Concentración de dióxido de azufre (SO2) media mensual',
    'Concentración de dióxido de azufre (SO2) máxima horaria anual',
    'Concentración de dióxido de azufre (SO2) mínima anual',
    'Concentración de dióxido de azufre (SO2) al percentil 50',
    'Concentración de dióxido de azufre (SO2) al percentil 90',
    'Concentración de dióxido de azufre (SO2) al percentil 95',
    'Concentración de dióxido de azufre (SO2) al percentil 99',
    'Concentración de dióxido de nitrógeno (NO2) media mensual',
    'Concentración de dióxido de nitrógeno (NO2) máxima horaria anual',
    'Concentración de dióxido de nitrógeno (NO2) mínima horaria anual',
    'Concentración de dióxido de nitrógeno (NO2) al percentil 50',
    'Concentración de dióxido de nitrógeno (NO2) al percentil 90',
    'Concentración de Dióxido de Nitrógeno (NO2) al percentil 98',
    'Concentración de dióxido de nitrógeno (NO2) al percentil 99',
    'Concentración de monóxido de carbono (CO) media mensual',
    'Concentración de monóxido de carbono (CO) máxima horaria anual',
    'Concentración de monóxido de carbono (CO) mínima horaria anual',
    'Concentración de monóxido de carbono (CO) al percentil 50',
    'Concentración de monóxido de carbono (CO) al percentil 90',
    'Concentración de monóxido de carbono (CO) al percentil 95',
    'Concentración de monóxido de carbono (CO) al percentil 98',
    'Concentración de monóxido de carbono (CO) al percentil 99',
    'Concentración de monóxido de nitrógeno (NO) media mensua',
    'Concentración de monóxido de nitrógeno (NO) máxima horaria anual',
    'Concentración de monóxido de nitrógeno (NO) mínima horaria anual',
    'Concentración de monóxido de nitrógeno (NO) al percentil 50',
    'Concentración de monóxido de nitrógeno (NO) al percentil 90',
    'Concentración de monóxido de nitrógeno (NO) al percentil 98',
    'Concentración de monóxido de nitrógeno (NO) al percentil 99',
    'Concentración de óxidos de nitrógeno (NOx) media mensual',
    'Concentración de óxidos de nitrógeno (NOx) máxima horaria anual',
    'Concentración de óxidos de nitrógeno (NOx) mínima horaria anual',
    'Concentración de óxidos de nitrógeno (NOx) al percentil 50',
    'Concentración de óxidos de nitrógeno (NOx) al percentil 90',
    'Concentración de óxidos de nitrógeno (NOx) al percentil 98',
    'Concentración de óxidos de nitrógeno (NOx) al percentil 99',
    'Concentración de dióxido de azufre (SO2) al percentil 98',
    'Concentración de dióxido de nitrógeno (NO2) al percentil 95',
    'Concentración de monóxido de nitrógeno (NO) al percentil 95',
    'Concentración de óxidos de nitrógeno (NOx) al percentil 95',
    'Número de eventos de olas de calor',
)
_TITLES_1 = (
    'Caudal medio de aguas corrientes',
    'Volumen del embalse, según embalse',
    'Nivel estático de aguas subterráneas',
    'Cantidad de agua caída',
    'Altura de nieve equivalente en agua',
    'Evaporación real, según estación',
    'Número de glaciares, según cuenca hidrográfica',
    'Superficie de glaciares, según cuenca hidrográfica',
    'Volumen de hielo glaciar estimado, según cuenca hidrográfica',
    'Volumen de agua de glaciares estimada, según cuenca hidrográfica',
    'Nivel medio del mar',
    'Temperatura superficial del mar',
    'Concentración de metales disueltos en la matriz acuosa',
    'Concentración de coliformes fecales en matriz acuosa',
    'Concentración de metales totales en la matriz sedimentaria',
    'Concentración de coliformes fecales en matriz biológica',
)
_SCOPES = (('aire', 'Módulo VBA - Estado - Aire', _TITLES_0), ('agua', 'Módulo VBA - Estado - Agua', _TITLES_1),)
MP25_DOT_PATTERN = '\\(mp\\s*2\\.5\\)'
MP25_DOT_REPLACEMENT = '(mp2,5)'
POLLUTANT_TOKENS = ('co', 'no2', 'o3', 'nox', 'no', 'so2', 'mp10', 'mp25')
SCOPE_SUFFIXES = ((('\\bcuenca\\b', 'hidrograf'), 'por_cuenca'),
 (('\\bestacion\\b',), 'por_estacion'),
 (('\\bembalse\\b',), 'por_embalse'))
SEMANTIC_RULES = (('^\\s*concentracion\\s+de\\s+', ''),
 ('\\bozono\\s*(?:\\((?:o3)\\)|\\s+o3)?\\b', 'o3'),
 ('dioxido\\s+de\\s+azufre\\s*(?:\\((?:so2)\\)|\\s+so2)?\\b', 'so2'),
 ('dioxido\\s+de\\s+nitrogeno\\s*(?:\\((?:no2)\\)|\\s+no2)?\\b', 'no2'),
 ('oxidos\\s+de\\s+nitrogeno\\s*(?:\\((?:nox)\\)|\\s+nox)?\\b', 'nox'),
 ('monoxido\\s+de\\s+carbono\\s*(?:\\((?:co)\\)|\\s+co)?\\b', 'co'),
 ('monoxido\\s+de\\s+nitrogeno\\s*(?:\\((?:no)\\)|\\s+no)?\\b', 'no'),
 ('material\\s+particulado(?:\\s+fino)?\\s+respirable\\s*(?:\\(\\s*mp\\s*2[,\\.]?\\s*5\\s*\\)|mp\\s*2[,\\.]?\\s*5|mp\\s*25|mp25)\\b',
  'mp25'),
 ('material\\s+particulado\\s+respirable\\s*(?:\\(\\s*mp\\s*10\\s*\\)|mp\\s*10|mp10)\\b', 'mp10'),
 ('material\\s+particulado\\s+fino\\s+respirable\\s*\\(mp\\s*2[,\\.]?\\s*5\\)', 'mp25'),
 ('\\bmensua\\b', 'mensual'),
 ('\\b(?:al|a\\s+el)?\\s*percentil\\s*(\\d+)\\b', 'perc$1'),
 ('\\bmedia\\s+mensual\\b', 'med_mens'),
 ('\\bpromedio\\b', 'prom'),
 ('\\bmedia\\b', 'med'),
 ('\\bmensual\\b', 'mens'),
 ('\\banual\\b', 'anual'),
 ('\\bmaxima\\s+horaria\\s+anual\\b', 'max_hor_anual'),
 ('\\bminima\\s+horaria\\s+anual\\b', 'min_hor_anual'),
 ('\\bmaxima\\s+horaria\\b', 'max_hor'),
 ('\\bminima\\s+horaria\\b', 'min_hor'),
 ('\\bmaxima\\b', 'max'),
 ('\\bminima\\b', 'min'),
 ('\\btemperatura\\b', 'temp'),
 ('\\bhumedad\\s+relativa\\b', 'humedad_rel'),
 ('\\bradiacion\\s+global\\b', 'rad_global'),
 ('\\bindice\\s+uv[-_ ]?b\\b', 'uvb'),
 ('\\bnumero\\s+de\\s+\\b', 'num_'),
 ('\\bevaporacion\\s+real\\b', 'evaporacion_real'),
 ('\\bsegun\\s+cuenca(?:\\s+hidrografica)?\\b', 'por_cuenca'),
 ('\\bsegun\\s+estacion\\b', 'por_estacion'),
 ('\\bsegun\\s+embalse\\b', 'por_embalse'),
 ('\\bcantidad\\s+de\\s+agua\\s+ca[ií]da\\b', 'cantidad_de_agua_caida'),
 ('\\baltura\\s+de\\s+nieve\\s+equivalente\\s+en\\s+agua\\b', 'altura_nieve_equivalente_en_agua'))
RESERVED_WORDS = ('user', 'table', 'select', 'where', 'group', 'order', 'limit', 'offset', 'insert', 'update', 'delete', 'having',
 'join', 'on', 'from', 'into', 'as', 'and', 'or', 'not', 'by', 'in', 'is', 'null', 'true', 'false')


def catalog_rows(scope: str | None = None) -> list[tuple[int, str, str, str]]:
    """``(idx, scope, module, title)``; ``idx`` counts over all scopes."""
    rows, i = [], 0
    for key, module, titles in _SCOPES:
        for title in titles:
            if scope in (None, key):
                rows.append((i, key, module, title))
            i += 1
    return rows
