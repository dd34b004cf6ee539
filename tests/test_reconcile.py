import unicodedata

import pytest
from pyspark.sql import functions as F

from berth.operators import reconcile as R
from berth.sources.catalog import AIR_TITLES, WATER_TITLES, catalog, catalog_rows

T = "Concentración de ozono (O3) media mensual"
SAFE = "Concentración_de_ozono_O3_media_mensual"


def files(spark, names):
    return spark.createDataFrame([(i, "d", n) for i, n in enumerate(names)], "file_id long, dir string, name string")


def test_catalog_shape(spark):
    assert len(catalog_rows()) == 87 == len(AIR_TITLES) + len(WATER_TITLES)
    assert len(catalog_rows("aire")) == 71 and len(catalog_rows(" AGUA ")) == 16
    assert len(catalog_rows("unknown")) == 87
    assert catalog(spark).count() == 87


@pytest.mark.parametrize("name", [
    T + ".csv", SAFE + ".csv", T + "_20250101_000000.csv", SAFE + "_x.csv", SAFE.upper() + "_1.csv",
    unicodedata.normalize("NFD", SAFE) + ".csv",
])
def test_match_forms(spark, name):
    cat = catalog(spark).where(F.col("title") == T)
    m = R.matched(cat, files(spark, [name]))
    assert m.count() == 1
    assert R.missing(cat, files(spark, [name])).count() == 0


@pytest.mark.parametrize("name", [T + "x.csv", SAFE + ".txt.csv", "x_" + SAFE + ".csv", SAFE + ".CSV.bak"])
def test_non_matches(spark, name):
    cat = catalog(spark).where(F.col("title") == T)
    assert R.extras(cat, files(spark, [name])).count() == 1
    assert R.missing(cat, files(spark, [name])).count() == 1


def test_inline_and_join_paths_agree(spark):
    cat = catalog(spark)
    names = [t + ".csv" for t in AIR_TITLES[:10]] + ["otro.csv", WATER_TITLES[3].replace(" ", "_") + "_v2.csv"]
    f = files(spark, names)
    ix_inline = R.CatalogIndex(cat)
    ix_join = R.CatalogIndex(cat, inline_limit=0)
    assert ix_join.inline is None
    a = sorted(r["file_id"] for r in R.extras(cat, f, ix_inline).collect())
    b = sorted(r["file_id"] for r in R.extras(cat, f, ix_join).collect())
    assert a == b == [10]
    miss = R.missing(cat, f)
    assert miss.count() == 87 - 11
    # properties: missing ∪ present = catalogue; extras ∩ matched = ∅
    present = R.title_matches(cat, f).select("idx").distinct()
    assert miss.select("idx").union(present).distinct().count() == 87
    assert R.extras(cat, f).join(R.matched(cat, f), "file_id").count() == 0


def test_status_and_scope(spark):
    air = [t + ".csv" for t in AIR_TITLES]
    water = [t + ".csv" for t in WATER_TITLES]
    full = files(spark, air + water)
    assert R.status(catalog(spark), full).first().asDict() == {"n_missing": 0, "n_extras": 0, "status": 0}
    # scope aire: water files are extras
    r = R.status(catalog(spark, "aire"), full).first()
    assert (r["n_missing"], r["n_extras"], r["status"]) == (0, 16, 2)
    by = {(x["scope"], x["module"]): (x["n_expected"], x["n_missing"])
          for x in R.missing_by_module(catalog(spark), files(spark, air)).collect()}
    assert by[("aire", "Módulo VBA - Estado - Aire")] == (71, 0)
    assert by[("agua", "Módulo VBA - Estado - Agua")] == (16, 16)
    assert by[(None, None)] == (87, 16)


def test_numbered_labels_never_cut(spark):
    rows = [(i, "aire", "m", f"t{i}") for i in range(105)]
    df = spark.createDataFrame(rows, "idx int, scope string, module string, title string")
    labels = {r["seq"]: r["label"] for r in R.numbered(df).collect()}
    assert labels[1] == "01. t0" and labels[100] == "100. t99"
