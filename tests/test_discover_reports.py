from berth.operators import discover as D
from berth.plans import reports
from berth.sources.catalog import AIR_TITLES, WATER_TITLES, catalog

PORTAL = '''<ul><li class="t opened"><span>Modulo Aire</span><ul>
<li><a class="ds"> Temperatura media </a></li><li><a class="ds">  </a></li>
<li><a class="ds">Temperatura media</a></li><li><a class="ds">Radiacion global</a></li></ul></li>
<li class="t closed"><span>Modulo Agua</span><ul><li><a class="ds">Nivel medio del mar</a></li></ul></li></ul>'''


def pages(spark, html):
    return spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")


def test_module_datasets_in_order_without_blanks_or_repeats(spark):
    p = pages(spark, PORTAL)
    got = [r["text"] for r in D.discover_module_datasets(p, "Modulo Aire").orderBy("ordinal").collect()]
    assert got == ["Temperatura media", "Radiacion global"]
    assert [r["text"] for r in D.discover_module_datasets(p, "Modulo Agua").collect()] == ["Nivel medio del mar"]


def test_nav_links_entities_and_survey(spark):
    html = '<nav><a href="/a">A &amp; B</a><a href="/b"><b>C</b></a><a>A &amp; B</a></nav><span>VBA x</span>'
    p = pages(spark, html)
    assert [r["text"] for r in D.discover_links(p).orderBy("ordinal").collect()] == ["A & B", "C"]
    s = D.element_survey(p).first()
    assert (s["n_a"], s["n_span"], s["n_nav"], s["n_button"]) == (3, 1, 1, 0)
    k = D.keyword_survey(p).first()
    assert (k["n_elements"], k["n_keyword_hits"]) == (1, 1)


def test_module_element_fallback(spark):
    got = {r["module"]: (r["how"], r["text"]) for r in
           D.module_element(pages(spark, PORTAL), ["Modulo Aire", "Otro Agua", "Nada"]).collect()}
    assert got == {"Modulo Aire": ("exact", "Modulo Aire"), "Otro Agua": ("fallback", "Modulo Agua"),
                   "Nada": ("none", None)}


def _text(df):
    return [r["line"] for r in df.orderBy("section", "seq", "ord", "key").collect()]


def test_missing_report_text(spark):
    files = spark.createDataFrame([(i, "d", t + ".csv") for i, t in enumerate(AIR_TITLES)] + [(999, "d", "zz.csv"),
                                  (998, "d", "aa.csv")], "file_id long, dir string, name string")
    lines = _text(reports.missing_report_lines(catalog(spark), files, "STAMP", "DIR"))
    assert lines[:3] == ["REPORTE DE ARCHIVOS FALTANTES - generado STAMP", "Carpeta analizada: DIR", "=" * 72]
    i = lines.index("[Módulo VBA - Estado - Aire]  Faltantes: 0")
    assert lines[i + 1:i + 3] == [" - (sin faltantes)", ""]
    j = lines.index("[Módulo VBA - Estado - Agua]  Faltantes: 16")
    assert lines[j + 1:j + 17] == [" - " + t for t in WATER_TITLES]
    assert "TOTAL FALTANTES: 16" in lines and "Total extras: 2" in lines
    assert lines[-3:] == [" - aa.csv", " - zz.csv", "=" * 72]


def test_run_summary_text(spark):
    d = spark.createDataFrame([("aire", "r/a.csv", 2), ("aire", "r/b.csv", 1)], "module string, path string, file_id long")
    lines = _text(reports.run_summary_lines(d, reports.modules_frame(spark), "S", "D"))
    assert lines[5:10] == ["Módulo: Módulo VBA- Estado - Aire", "Modo: AUTO-DESCUBRIMIENTO",
                           "Archivos descargados: 2", "", "  - b.csv"]
    assert lines[-2:] == ["TOTAL DE ARCHIVOS DESCARGADOS: 2", "=" * 60]


def test_nested_items_and_every_container(spark):
    from berth.operators import discover as D
    html = ('<ul class="treeview"><li class="t"><span>Mod A</span><ul><li class="t sub"><span>s</span><ul><li><a class="ds">one</a></li></ul></li>'
            '<li><a class="x ds">two</a></li></ul></li><li class="t"><span> </span><a class="ds">other</a></li></ul><span>out</span>'
            '<nav><a>n1</a></nav><nav><a>n2</a><a>n1</a></nav>')
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    assert [r["text"] for r in D.discover_module_datasets(pages, "Mod A").orderBy("ordinal").collect()] == ["one", "two"]
    assert [r["text"] for r in D.discover_links(pages).orderBy("ordinal").collect()] == ["n1", "n2"]
    assert {tuple(r) for r in D.tree_survey(pages.where("html is not null")).collect()} == {(1, 3, 2), (2, 0, 0)}


def test_classes_are_whole_words(spark):
    from berth.operators import discover
    html = ('<ul class="treeview"><li class="t-old"><span>Módulo X</span><a class="ds">zero</a></li></ul>'
            '<li class="a t"><span>Módulo X</span><a class="no-ds">one</a><a class="ds">two</a><a class="x ds y">three</a><a class="dst">four</a></li>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.text for r in discover.discover_module_datasets(pages, "Módulo X").orderBy("ordinal").collect()] == ["two", "three"]
