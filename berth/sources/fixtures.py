"""Landing-zone frames derived from the driver tables.

The landing zone the jobs look after is a set of downloaded files. To test at
every scale factor, its listing is derived from ``orders`` (one file per
order): each order names a catalogue title (or an unknown one) in one of five
naming styles, in folders of 450 files. Other frames come from ``part``
(CSV headers), ``events`` (CSV cells) and the landing frame itself (download
ledger). Everything is a projection of a driver table plus a broadcast of the
bounded catalogue, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.functions.stems import stem
from berth.functions.text import safe_name
from berth.sources.catalog import catalog
from berth.sources.tables import table

FILES_PER_DIR = 450
TITLE_SLOTS = 90          # idx = key % 90; 87..89 and every idx ≡ 3 (mod 10) are unknown
NAMING_STYLES = 5
UNKNOWN_PREFIX = "Desconocido "


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, dir, name, mtime, length`` — CSV files only, (dir, name) unique."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    b = o.select(
        k.alias("file_id"),
        (k % TITLE_SLOTS).cast("int").alias("i"),
        F.expr(f"o_orderkey div {TITLE_SLOTS} % {NAMING_STYLES}").alias("v"),
        F.concat(F.lit("run_"), F.expr(f"o_orderkey div {FILES_PER_DIR}").cast("string")).alias("dir"),
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"),
                 F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"),
                 F.lit("0000")).alias("ts"),
        F.timestamp_add("SECOND", F.col("o_custkey") % 86400, F.col("o_orderdate")).alias("mtime"),
        F.floor("o_totalprice").cast("bigint").alias("length"),
    )
    cat = F.broadcast(catalog(spark).select(F.col("idx").alias("i"), "title"))
    t = b.join(cat, "i", "left").withColumn(
        "title",
        F.when(((F.col("i") % 10) == 3) | (F.col("i") >= 87),
               F.concat(F.lit(UNKNOWN_PREFIX), F.col("i").cast("string")))
        .otherwise(F.col("title")))
    safe = safe_name("title")
    name = (F.when(F.col("v") == 0, F.concat("title", F.lit(".csv")))
            .when(F.col("v") == 1, F.concat(safe, F.lit(".csv")))
            .when(F.col("v") == 2, F.concat(safe, F.lit("_"), "ts", F.lit(".csv")))
            .when(F.col("v") == 3, F.concat(safe, F.lit("_"), "ts", F.lit("_v2.csv")))
            .otherwise(F.concat(F.upper(safe), F.lit("_"), "ts", F.lit(".csv"))))
    return t.select("file_id", "dir", name.alias("name"), "mtime", "length")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, path, dir, name, mtime, length`` — every file kind: the landing
    stems with an extension chosen by ``file_id % 7`` (0–3 ``.csv``, 4 ``.PNG``,
    5 ``.txt``, 6 none)."""
    land = landing(spark, sf_dir)
    m = F.col("file_id") % 7
    ext = (F.when(m <= 3, F.lit(".csv")).when(m == 4, F.lit(".PNG"))
           .when(m == 5, F.lit(".txt")).otherwise(F.lit("")))
    name = F.concat(stem("name"), ext)
    return land.select("file_id", F.concat("dir", F.lit("/"), name).alias("path"), "dir",
                       name.alias("name"), "mtime", "length")


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table_id, ordinal, raw_name`` — CSV header cells, one table per
    ``p_size``; names repeat a lot (``p_name`` for even keys, ``p_type`` odd)."""
    from pyspark.sql import Window
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    w = Window.partitionBy("p_size").orderBy("p_partkey")
    return p.select(
        F.concat(F.lit("t"), F.col("p_size").cast("string")).alias("table_id"),
        F.row_number().over(w).cast("bigint").alias("ordinal"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.col("p_type")).alias("raw_name"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table_id, col, row, value`` — CSV cells as text, one table per event day.
    ``value`` has ``n/a`` on every 10th row; ``ts`` lands in a column ``fecha``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    value = F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return e.select(
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd")).alias("table_id"),
        F.col("event_id").alias("row"),
        F.explode(F.array(
            F.struct(F.lit("event_id").alias("col"), F.col("event_id").cast("string").alias("value")),
            F.struct(F.lit("user_id").alias("col"), F.col("user_id").cast("string").alias("value")),
            F.struct(F.lit("event_type").alias("col"), F.col("event_type").alias("value")),
            F.struct(F.lit("value").alias("col"), value.alias("value")),
            F.struct(F.lit("fecha").alias("col"), F.col("ts").cast("string").alias("value")),
            F.struct(F.lit("props").alias("col"), F.col("props").alias("value")),
        )).alias("c"),
    ).select("table_id", "c.col", "row", "c.value")


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``module, path`` — the download ledger: each landing file of a catalogue
    title under the scope of that title."""
    land = landing(spark, sf_dir).withColumn("i", (F.col("file_id") % TITLE_SLOTS).cast("int"))
    cat = F.broadcast(catalog(spark).select(F.col("idx").alias("i"), F.col("scope").alias("module")))
    return (land.join(cat, "i", "inner")
            .where(F.col("i") % 10 != 3)
            .select("module", F.concat("dir", F.lit("/"), "name").alias("path"), "file_id"))


COPY_ID_OFFSET = 1_000_000_000_000
COPY_EVERY = 11


def landing_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing frame plus manual copies ``{stem} v2.csv`` of every 11th
    file (same folder, same times). A copy's stem keeps its ``v2`` (a space,
    not ``_``, precedes it), so it forms its own group whose name meets the
    second member of the original group: destination collisions to resolve."""
    land = landing(spark, sf_dir)
    copies = land.where(F.col("file_id") % COPY_EVERY == 0).select(
        (F.col("file_id") + COPY_ID_OFFSET).alias("file_id"), "dir",
        F.concat(stem("name"), F.lit(" v2.csv")).alias("name"), "mtime", "length")
    return land.unionByName(copies)


MODULE_NAMES = ("Módulo VBA- Estado - Aire", "Módulo VBA- Estado- Agua")


def portal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html`` — pages of the portal's shape made from ``pages``: a tree of
    spans with the module titles (whole on even pages, one word of them on every
    third, none on the others), nested items and ``a.ds`` links named after the page
    and its url, one of them twice and one blank."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    i, url = F.col("page_id").cast("string"), F.col("url")
    air = F.when(F.col("page_id") % 2 == 0, MODULE_NAMES[0]).when(F.col("page_id") % 3 == 0, "Calidad del Aire").otherwise("Otros")
    water = F.when(F.col("page_id") % 4 == 0, MODULE_NAMES[1]).when(F.col("page_id") % 3 == 0, "Agua dulce").otherwise("")
    link = lambda text: F.concat(F.lit('<li><a class="x ds" href="#">'), text, F.lit("</a></li>"))
    html = F.concat(
        F.lit('<html><body><span>Estadísticas de Medio Ambiente</span><ul class="treeview"><li class="t"><span>'), air, F.lit("</span><ul>"),
        link(F.concat(F.lit("serie "), i)), F.lit('<li class="t sub"><span>Estado '), i, F.lit("</span><ul>"), link(url),
        link(F.concat(F.lit("serie "), i)), F.lit("</ul></li>"), link(F.lit("  ")), link(F.concat(F.lit(" final "), i)),
        F.lit('</ul></li><li class="t"><span> '), water, F.lit("</span><ul>"), link(F.concat(F.lit("agua "), i)),
        F.lit("</ul></li>"), F.repeat(F.lit("<span>n</span>"), (F.col("page_id") % 20).cast("int")),
        F.lit("</ul>"), F.repeat(F.lit("<span>pie</span>"), (F.col("page_id") % 20).cast("int")), F.lit("</body></html>"))
    return p.select("page_id", html.alias("html"))


def wild_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html`` — pages made from ``pages`` in the markup that portals really
    send: comments and scripts that hold tags, ``>`` inside attribute values, classes in
    single, double or no quotes, list items without end tags, character references."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    i = F.col("page_id").cast("string")
    url = F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&#62;"))
    html = F.concat(
        F.lit("<!DOCTYPE html><!-- <nav><a>hidden</a></nav> > --><script>if (a < b) x = '<nav><a>code</a></nav>';</script>"),
        F.lit("""<nav data-rule="a > b" class='main menu'><a title="x>y" href=#>enlace&nbsp;"""), i,
        F.lit("""</a><A HREF='/b>c'>M&#243;dulo &#xE1;rea &lt;"""), i, F.lit("&gt;</A><a>dos <b>partes</b><!-- </a> --> juntas</a><a>"), url,
        F.lit(f"""</a></nav><ul class='big treeview'><li class="t-old"><span>{MODULE_NAMES[0]}</span><a class="ds">viejo</a>"""),
        F.lit("""<li class='x t'><span title="</span>">M&oacute;dulo <i>VBA- Estado</i> - Aire</span><ul><li><a class="no-ds">no</a>"""),
        F.lit("""<li><a title=" class='no' >" class="a ds">serie """), i, F.lit("</a><li><a class=ds>literal &amp;amp;</a>"),
        F.repeat(F.lit("<li><A CLASS='ds z'>igual</A>"), (F.col("page_id") % 5).cast("int")),
        F.lit("</ul><li class=t><span>otro</span><a class=ds>ajeno</a></ul>"))
    return p.select("page_id", html.alias("html"))


def land_quoted(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """``events`` as CSV text under ``folder/events``, two header orders by parity."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = quote(F.concat(F.lit('say "'), F.col("event_type"), F.lit('",\nthen \\')))
    half = F.when(F.col("event_id") % 3 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    cells = {"event_id": F.col("event_id").cast("string"), "note": note, "half": half,
             "flag": F.when(F.col("event_id") % 2 == 0, "True").otherwise("FALSE"), "none": F.lit("n/a"),
             "fecha": F.date_format("ts", "yyyy-MM-dd"), "value": F.col("value").cast("string")}
    orders = (list(cells), ["value", "note", "event_id", "fecha", "flag", "half"])
    for parity, names in enumerate(orders):
        rows = e.where((F.col("event_id") % 2 == parity)).select(F.concat_ws(",", *(F.coalesce(cells[n], F.lit("")) for n in names)).alias("line"))
        # a file's first line is its header: every part file gets one
        lines = rows.mapInArrow(_with_header(",".join(names)), "line string")
        lines.write.mode("append").option("compression", "none").text(f"{folder}/text{parity}")
    _as_csv(spark, folder)


def _with_header(header: str):
    import pyarrow as pa

    def run(parts):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["line"])
        yield from (pa.RecordBatch.from_arrays([part.column(0)], ["line"]) for part in parts)
    return run


def _as_csv(spark: SparkSession, folder: str) -> None:
    """Give the part files of ``folder/text*`` the names ``events/*.csv``."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(folder + "/events")
    fs.mkdirs(target)
    for source in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder + "/text*/part-*.txt")):
        path = source.getPath()
        name = path.getParent().getName() + "-" + path.getName().replace(".txt", ".csv")
        fs.rename(path, jvm.org.apache.hadoop.fs.Path(target, name))


def tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rel, name, size``: a file for each customer with orders, in nested folders (one level
    has brackets, the next a space), with hidden, bracketed, accented and upper-case names;
    as many bytes as the customer has orders modulo 5, so that some are empty."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg((F.count("*") % 5).cast("int").alias("size"))
    k = F.col("k").cast("string")
    kind = F.col("k") % 7
    name = (F.when(kind == 0, F.concat(F.lit(".hidden_"), k, F.lit(".csv"))).when(kind == 1, F.concat(F.lit("_under "), k, F.lit(".csv")))
            .when(kind == 2, F.concat(F.lit("[br]ack{et}* "), k, F.lit(".csv"))).when(kind == 3, F.concat(F.lit("Ñandú_"), k, F.lit(".csv")))
            .when(kind == 4, F.concat(F.lit("PLAIN_"), k, F.lit(".CSV"))).when(kind == 5, F.concat(F.lit("note "), k, F.lit(".txt")))
            .otherwise(F.concat(F.lit("plain%20"), k, F.lit(".csv"))))
    level = lambda text, n: F.concat(F.lit(text), (F.col("k") % n).cast("string"))
    folder = (F.when(F.col("k") % 3 == 0, level("a", 5)).when(F.col("k") % 3 == 1, F.concat_ws("/", level("a", 5), level("[b]", 4)))
              .otherwise(F.concat_ws("/", level("a", 5), level("[b]", 4), level("c d", 11))))
    return o.select(F.concat_ws("/", folder, name).alias("rel"), name.alias("name"), "size")


def land_tree(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the files of :func:`tree_files` under ``root``; each task writes its own."""
    def write(rows):
        import posixpath

        from berth.sources.listing import file_system
        for r in rows:
            fs, at = file_system(f"{root}/{r['rel']}")
            fs.create_dir(posixpath.dirname(at), recursive=True)
            with fs.open_output_stream(at) as out:
                out.write(b"x" * r["size"])

    tree_files(spark, sf_dir).foreachPartition(write)


def land_months(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``orders`` as CSV files, a folder for each month; even months have the columns
    ``Número, Fecha Orden, Total``, odd ones ``Fecha Orden, Número, Estado``; dates are day-first."""
    o = table(spark, sf_dir, "orders")
    number, day = F.col("o_orderkey").alias("Número"), F.date_format("o_orderdate", "dd-MM-yyyy").alias("Fecha Orden")
    shapes = ([number, day, F.col("o_totalprice").alias("Total")], [day, number, F.col("o_orderstatus").alias("Estado")])
    for parity, shape in enumerate(shapes):
        rows = o.where(F.month("o_orderdate") % 2 == parity).select(F.date_format("o_orderdate", "yyyyMM").alias("mes"), *shape)
        rows.hint("rebalance", "mes").write.mode("append").partitionBy("mes").option("header", True).csv(root)
