"""Golden rows for the name functions (derived by reading the semantics)."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from berth.functions import (ascii_fold, extension, landing_name, norm_key, parse_stem, safe_name,
                             semantic_name, sql_identifier, stem, ts_to_int, with_parsed_stem,
                             with_semantic_name)

SEMANTIC = [
    ("Temperatura_máxima_absoluta", "temp_max_absoluta"),
    ("Humedad_relativa_media_mensual", "humedad_rel_med_mens"),
    ("Índice_UV-B_promedio", "uvb_prom"),
    ("Concentración_de_ozono_O3_media_mensual", "o3_med_mens"),
    ("Concentración de ozono (O3) media mensual", "o3_med_mens"),
    ("Concentración_de_ozono_O3_al_percentil_50", "o3_perc50"),
    ("Concentración_de_dióxido_de_azufre_SO2_mínima_anual", "so2_min_anual"),
    ("Concentración_de_monóxido_de_nitrógeno_NO_media_mensua", "no_med_mens"),
    ("Concentración_de_Material_Particulado_fino_respirable_MP25_máxima_horaria_anual", "mp25_max_hor_anual"),
    ("Concentración_de_material_particulado_respirable_MP10_media_mensual", "mp10_med_mens"),
    ("Concentración de material particulado respirable (MP10) media mensual",
     "material_particulado_respirable_mp10_med_mens"),
    ("Número_de_glaciares_según_cuenca_hidrográfica", "num_glaciares_por_cuenca"),
    ("Evaporación_real_según_estación", "evaporacion_real_por_estacion"),
    ("Altura_de_nieve_equivalente_en_agua", "altura_nieve_equivalente_en_agua"),
    ("co_coliformes", "co_liformes"),
    ("", ""),
    ("Concentración de Material Particulado fino respirable (MP2,5) media mensual", "mp25_med_mens"),
    ("Concentración de Material Particulado fino respirable (MP 2.5) al Percentil 90", "mp25_perc90"),
    ("Volumen del embalse, según embalse", "volumen_del_embalse_por_embalse"),
]


def _one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("out")).first()["out"]


@pytest.mark.parametrize("raw,want", SEMANTIC)
def test_semantic_name_column_form(spark, raw, want):
    assert _one(spark, semantic_name("s"), raw) == want


def test_semantic_name_stepwise_form_agrees(spark):
    df = spark.createDataFrame([(r,) for r, _ in SEMANTIC], "s string")
    got = dict((r["s"], r["out"]) for r in with_semantic_name(df, "s", "out").collect())
    assert got == dict(SEMANTIC)


@pytest.mark.parametrize("raw,want", [
    ("Año (2,5)", "ano_2_5"), ("2020 total", "t_2020_total"), ("Select", "t_select"),
    ("***", "t"), ("a" * 70, "a" * 63), ("selects", "selects"), ("x" * 62 + " y", "x" * 62 + "_"),
])
def test_sql_identifier(spark, raw, want):
    assert _one(spark, sql_identifier("s"), raw) == want


STEMS = [
    ("Nivel_20250914_132907", "Nivel", "20250914_132907", None, 20250914132907),
    ("Nivel-20250914-132907", "Nivel", "20250914_132907", None, 20250914132907),
    ("Nivel_20250914_132907_V3", "Nivel", "20250914_132907", 3, 20250914132907),
    ("Nivel_v2_20250914_132907", "Nivel_v2", "20250914_132907", None, 20250914132907),
    ("Nivel_20251399_999999", "Nivel", "20251399_999999", None, 20251399999999),
    ("Nivel_20250914_132907  ", "Nivel", "20250914_132907", None, 20250914132907),
    ("Nivel", "Nivel", None, None, 0),
]


def test_parse_stem_both_forms(spark):
    df = spark.createDataFrame([(s,) for s, *_ in STEMS], "s string")
    col_form = {r["s"]: (r["p"]["base"], r["p"]["ts"], r["p"]["ver"], r["ti"]) for r in
                df.select("s", parse_stem("s").alias("p"), ts_to_int(parse_stem("s")["ts"]).alias("ti")).collect()}
    step = {r["s"]: (r["base"], r["ts"], r["ver"], r["ti"]) for r in
            with_parsed_stem(df, "s").withColumn("ti", ts_to_int("ts")).collect()}
    want = {s: (b, t, v, i) for s, b, t, v, i in STEMS}
    assert col_form == want
    assert step == want


@pytest.mark.parametrize("name,ext,st", [
    ("a.csv", ".csv", "a"), ("a.", "(sin extensión)", "a."), (".env", "(sin extensión)", ".env"),
    ("..a", ".a", "."), ("a.b.CSV", ".csv", "a.b"), ("a", "(sin extensión)", "a"), ("a. b", ". b", "a"),
])
def test_extension_and_stem_follow_path_suffix_rules(spark, name, ext, st):
    df = spark.createDataFrame([(name,)], "n string")
    r = df.select(extension("n").alias("e"), stem("n").alias("s")).first()
    assert (r["e"], r["s"]) == (ext, st)


def test_safe_and_landing_name(spark):
    df = spark.sql("SELECT 'Volumen del embalse, según embalse (x)' AS t, "
                   "TIMESTAMP_NTZ'2025-09-14 13:29:07' AS ts")
    r = df.select(safe_name("t").alias("s"), landing_name("t", "ts").alias("l")).first()
    assert r["s"] == "Volumen_del_embalse_según_embalse_x"
    assert r["l"] == "Volumen_del_embalse_según_embalse_x_20250914_132907.csv"


def test_norm_key_equates_nfc_and_nfd_and_case(spark):
    a = "Concentración Índice"
    b = unicodedata.normalize("NFD", a.upper())
    df = spark.createDataFrame([(a, b)], "a string, b string")
    r = df.select(norm_key("a").alias("x"), norm_key("b").alias("y")).first()
    assert r["x"] == r["y"] == unicodedata.normalize("NFC", a).lower()


def test_ascii_fold_is_nfkd_without_marks(spark):
    s = "ﬁ º ² Ångström ø 𝐀"
    want = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    assert _one(spark, ascii_fold(F.col("s")), s) == want


def _identifier_reference(raw: str) -> str:
    """Independent Python statement of the identifier rule."""
    import re
    s = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c))
    s = re.sub(r"[^a-z0-9]+", "_", s.lower()).strip("_")
    s = s or "t"
    if s[0].isdigit() or s in {"user", "table", "select", "where", "group", "order", "limit", "offset",
                               "insert", "update", "delete", "having", "join", "on", "from", "into", "as",
                               "and", "or", "not", "by", "in", "is", "null", "true", "false"}:
        s = "t_" + s
    return s[:63]


def test_identifier_property_on_random_text(spark):
    import random
    import re
    rng = random.Random(11)
    alphabet = "abcXYZ019 _-.,()ñÁéÍóúüçÅøßﬁ²º½Ⅻ한́̈\t"
    raws = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    raws += ["select", "SELECT", "2x", "___", "  "]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, r string")
    got = {row["i"]: row["o"] for row in df.select("i", sql_identifier("r").alias("o")).collect()}
    for i, r in enumerate(raws):
        assert re.fullmatch(r"[a-z][a-z0-9_]{0,62}", got[i]), (r, got[i])
        assert got[i] == _identifier_reference(r), (r, got[i])
