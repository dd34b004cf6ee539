"""Text reports as line frames.

A report is a DataFrame ``section, seq, ord, key, line``; its text is the
``line`` column ordered by the other four. Variable-length parts (missing
titles, extra files, downloaded files) are plain projections of distributed
frames, so a report of millions of lines is written as ordered part files
by a range-partitioned sort — no list is ever gathered on the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.operators import reconcile
from berth.sources.catalog import CRAWL_MODULE_LABELS, SCOPES

# ---------------------------------------------------------------------------
# FIXED VALUES — report wording and rules.
# ---------------------------------------------------------------------------
MISSING_TITLE = "REPORTE DE ARCHIVOS FALTANTES - generado {stamp}"
MISSING_DIR = "Carpeta analizada: {dir}"
MISSING_MODULE = "[{module}]  Faltantes: {n}"
NONE_MISSING = " - (sin faltantes)"
TOTAL_MISSING = "TOTAL FALTANTES: "
EXTRAS_TITLE = "ARCHIVOS CSV EXTRA (no esperados)"
EXTRAS_TOTAL = "Total extras: "
NONE_EXTRA = " - (sin extras)"
ITEM = " - "
RULE_MISSING = 72
SUMMARY_TITLE = "REPORTE DE DESCARGAS - {stamp}"
SUMMARY_DIR = "Directorio de descargas: {dir}"
SUMMARY_MODULE = "Módulo: "
SUMMARY_MODE = "Modo: "
SUMMARY_COUNT = "Archivos descargados: "
SUMMARY_ITEM = "  - "
SUMMARY_TOTAL = "TOTAL DE ARCHIVOS DESCARGADOS: "
RULE_SUMMARY = 60
MODE_AUTO = "AUTO-DESCUBRIMIENTO"
MODE_PRESET = "CONFIGURACIÓN PREDEFINIDA"
# ---------------------------------------------------------------------------

#: Reports of up to so many lines (about 100 MB) are one file.
ONE_FILE_LINES = 1_000_000
LINES_SCHEMA = "section INT, seq INT, ord BIGINT, key STRING, line STRING"


def _ql(q: int, line: Column) -> Column:
    return F.struct(F.lit(q).alias("q"), line.alias("l"))


def _fixed(spark: SparkSession, rows: list[tuple[int, int, str]]) -> DataFrame:
    return spark.createDataFrame([(s, q, 0, "", line) for s, q, line in rows], LINES_SCHEMA)


def _lines(df: DataFrame, section: Column | int, seq: int, ord_: Column | int, key: Column | str,
           line: Column) -> DataFrame:
    def lit(x):
        return F.lit(x) if not isinstance(x, Column) else x
    return df.select(lit(section).cast("int").alias("section"), F.lit(seq).cast("int").alias("seq"),
                     lit(ord_).cast("bigint").alias("ord"), lit(key).cast("string").alias("key"),
                     line.alias("line"))


def missing_report_lines(cat: DataFrame, files: DataFrame, stamp: str, target_dir: str,
                         scope: str = "all") -> DataFrame:
    """The missing-files report of a reconciliation run as a line frame."""
    spark = cat.sparkSession
    scopes = [s for s in SCOPES if scope == "all" or s == scope]
    cat = cat.where(F.col("scope").isin(*scopes))
    ix = reconcile.catalog_index(cat)
    # Missing titles are a subset of the catalogue (bounded by its counted
    # size): computed once, then reused by every part of the report.
    miss_rows = reconcile.missing(cat, files, ix).collect()
    miss = spark.createDataFrame(miss_rows, cat.schema)
    extra = reconcile.extras(cat, files, ix)
    order = F.create_map(*[x for i, s in enumerate(scopes) for x in (F.lit(s), F.lit(i + 1))])
    rule = "=" * RULE_MISSING
    head = _fixed(spark, [(0, 0, MISSING_TITLE.format(stamp=stamp)),
                          (0, 1, MISSING_DIR.format(dir=target_dir)), (0, 2, rule)])
    per_module = (cat.select("idx", "scope", "module")
                  .join(reconcile._maybe_broadcast(miss.select("idx", F.lit(1).alias("m")), ix.n_rows), "idx", "left")
                  .groupBy("scope", "module")
                  .agg(F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("n")))
    sec = order[F.col("scope")]
    head_parts = MISSING_MODULE.replace("{module}", "\0").replace("{n}", "\0").split("\0")
    module_head = _lines(per_module, sec, 0, 0, "",
                         F.concat(F.lit(head_parts[0]), F.col("module"), F.lit(head_parts[1]),
                                  F.col("n").cast("string"), F.lit(head_parts[2])))
    module_none = _lines(per_module.where(F.col("n") == 0), sec, 1, 0, "", F.lit(NONE_MISSING))
    module_items = _lines(miss, sec, 1, F.col("idx"), "", F.concat(F.lit(ITEM), F.col("title")))
    module_gap = _lines(per_module, sec, 2, 0, "", F.lit(""))
    totals = extra.agg(F.count(F.lit(1)).alias("ne")).withColumn("nm", F.lit(len(miss_rows)).cast("bigint"))
    tail_sec = len(scopes) + 1
    tail = totals.select(F.explode(F.array(
        _ql(0, F.lit("-" * RULE_MISSING)),
        _ql(1, F.concat(F.lit(TOTAL_MISSING), F.col("nm").cast("string"))),
        _ql(2, F.lit(rule)),
        _ql(3, F.lit("")),
        _ql(4, F.lit(EXTRAS_TITLE)),
        _ql(5, F.concat(F.lit(EXTRAS_TOTAL), F.col("ne").cast("string"))),
        _ql(6, F.when(F.col("ne") == 0, F.lit(NONE_EXTRA))),
    )).alias("x")).select(F.lit(tail_sec).cast("int").alias("section"), F.col("x.q").cast("int").alias("seq"),
                          F.lit(0).cast("bigint").alias("ord"), F.lit("").alias("key"),
                          F.col("x.l").alias("line")).where(F.col("line").isNotNull())
    extras_lines = _lines(extra, tail_sec + 1, 0, 0, F.col("name"), F.concat(F.lit(ITEM), F.col("name")))
    end = _fixed(spark, [(tail_sec + 2, 0, rule)])
    parts = [head, module_head, module_none, module_items, module_gap, tail, extras_lines, end]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def modules_frame(spark: SparkSession, configured: dict[str, list[str]] | None = None) -> DataFrame:
    """``key, name, datasets`` — crawl modules; empty datasets = discovery."""
    configured = configured or {}
    rows = [(k, CRAWL_MODULE_LABELS[k], configured.get(k, [])) for k in SCOPES]
    return spark.createDataFrame(rows, "key STRING, name STRING, datasets ARRAY<STRING>")


def mode(datasets: Column) -> Column:
    return F.when(F.size(datasets) == 0, F.lit(MODE_AUTO)).otherwise(F.lit(MODE_PRESET))


def downloads_by_module(downloads: DataFrame, modules: DataFrame) -> DataFrame:
    """``module, name, mode, n_files`` per module plus a total row (NULLs)."""
    counts = downloads.groupBy("module").agg(F.count("*").alias("n_files"))
    m = modules.select(F.col("key").alias("module"), "name", mode(F.col("datasets")).alias("mode"))
    j = m.join(counts, "module", "left").fillna({"n_files": 0})
    return j.rollup(F.struct("module", "name", "mode").alias("m")).agg(
        F.sum("n_files").cast("bigint").alias("n_files")).select(
        "m.module", "m.name", "m.mode", "n_files")


def run_summary_lines(downloads: DataFrame, modules: DataFrame, stamp: str, target_dir: str) -> DataFrame:
    """The download-run summary as a line frame: per module its label, mode,
    count and file names (ledger order), then the grand total."""
    spark = downloads.sparkSession
    keys = [r[0] for r in modules.select("key").collect()]  # a handful of modules
    order = F.create_map(*[x for i, k in enumerate(keys) for x in (F.lit(k), F.lit(i + 1))])
    rule = "=" * RULE_SUMMARY
    head = _fixed(spark, [(0, 0, rule), (0, 1, SUMMARY_TITLE.format(stamp=stamp)), (0, 2, rule),
                          (0, 3, SUMMARY_DIR.format(dir=target_dir)), (0, 4, "")])
    per = downloads_by_module(downloads, modules).where(F.col("module").isNotNull())
    sec = order[F.col("module")]
    mod_head = per.select(sec.alias("s"), F.explode(F.array(
        _ql(0, F.concat(F.lit(SUMMARY_MODULE), F.col("name"))),
        _ql(1, F.concat(F.lit(SUMMARY_MODE), F.col("mode"))),
        _ql(2, F.concat(F.lit(SUMMARY_COUNT), F.col("n_files").cast("string"))),
        _ql(3, F.lit("")),
    )).alias("x"))
    mod_head = mod_head.select(
        F.col("s").cast("int").alias("section"), F.col("x.q").cast("int").alias("seq"),
        F.lit(0).cast("bigint").alias("ord"), F.lit("").alias("key"), F.col("x.l").alias("line"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    items = _lines(downloads, order[F.col("module")], 4, F.col("file_id"), "",
                   F.concat(F.lit(SUMMARY_ITEM), name))
    gap = _lines(per, sec, 5, 0, "", F.lit(""))
    total = downloads_by_module(downloads, modules).where(F.col("module").isNull())
    n = len(keys) + 1
    tail = _lines(total, n, 0, 0, "", F.concat(F.lit(SUMMARY_TOTAL), F.col("n_files").cast("string")))
    end = _fixed(spark, [(n, 1, rule)])
    out = head
    for p in (mod_head, items, gap, tail, end):
        out = out.unionByName(p)
    return out


def in_order(lines: DataFrame) -> DataFrame:
    """``line`` in report order."""
    return lines.orderBy("section", "seq", "ord", "key").select("line")


def write_lines(lines: DataFrame, path: str, one_file_lines: int = ONE_FILE_LINES) -> None:
    """Write a line frame as text at ``path``, replacing what is there: one file if it was
    counted and has at most ``one_file_lines`` lines, else a folder of ordered part files."""
    spark = lines.sparkSession
    parts = f"{path.rstrip('/')}.{uuid.uuid4().hex}.parts"
    small = lines.limit(one_file_lines + 1).count() <= one_file_lines
    ordered = in_order(lines.coalesce(1) if small else lines)
    ordered.write.text(parts)
    paths = spark._jvm.org.apache.hadoop.fs
    folder = paths.Path(parts)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    written = folder
    if small:
        written = fs.globStatus(paths.Path(folder, "part-*"))[0].getPath()
    fs.delete(paths.Path(path), True)
    if not fs.rename(written, paths.Path(path)):
        raise OSError(f"the report could not be moved to {path}; it is in {parts}")
    fs.delete(folder, True)
