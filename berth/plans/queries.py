"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed from the driver tables (through the landing-zone fixtures)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.functions.shorten import with_semantic_name_distinct
from berth.functions.stems import landing_name, stem, ts_to_int, with_parsed_stem
from berth.functions.text import sql_identifier
from berth.operators import columns, counts, discover, inference, reconcile, rename
from berth.sources import fixtures
from berth.sources.catalog import catalog


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.landing(spark, sf_dir).select("file_id", "dir", "name")


def missing_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.numbered(reconcile.missing(catalog(spark), _files(spark, sf_dir)))


def extra_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.extras(catalog(spark), _files(spark, sf_dir))


def matched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.matched(catalog(spark), _files(spark, sf_dir))


def title_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.title_matches(catalog(spark), _files(spark, sf_dir))


def missing_by_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.missing_by_module(catalog(spark), _files(spark, sf_dir))


def reconcile_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.status(catalog(spark), _files(spark, sf_dir))


def reconcile_scope_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope ``aire``: water titles are not expected, so water files are extras."""
    return reconcile.status(catalog(spark, "aire"), _files(spark, sf_dir))


def count_by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_by_extension(fixtures.inventory(spark, sf_dir))


def count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_report(fixtures.inventory(spark, sf_dir), catalog(spark))


def sql_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _files(spark, sf_dir)
    return f.select("file_id", "name", sql_identifier(stem("name")).alias("ident"))


def parsed_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _files(spark, sf_dir)
    p = with_parsed_stem(f.select("file_id", stem("name").alias("stem")), "stem")
    return p.select("file_id", "base", "ts", "ver", ts_to_int("ts").alias("ts_int"))


def landing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names downloads land under: ledger title × order timestamp."""
    d = fixtures.landing(spark, sf_dir).select("file_id", "mtime")
    cat = F.broadcast(catalog(spark).select("idx", "title"))
    j = d.join(cat, (F.col("file_id") % 87) == F.col("idx"))
    return j.select("file_id", landing_name("title", "mtime").alias("landing_name"))


def semantic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _files(spark, sf_dir)
    based = with_parsed_stem(f.select("file_id", stem("name").alias("stem")), "stem")
    return with_semantic_name_distinct(based.select("file_id", "base"), "base", "sem")


def _plan_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.landing(spark, sf_dir).select("file_id", "dir", "name", "mtime")


def rename_plan_keep_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename.rename_plan(_plan_input(spark, sf_dir), drop_timestamp=False)


def rename_plan_drop_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename.rename_plan(_plan_input(spark, sf_dir), drop_timestamp=True)


def rename_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename.rename_changes(rename_plan_drop_ts(spark, sf_dir))


def rename_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixtures.landing_with_copies(spark, sf_dir).select("file_id", "dir", "name", "mtime")
    return rename.rename_plan(files, drop_timestamp=True)


def normalized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.normalized_columns(fixtures.headers(spark, sf_dir))


def date_like_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-like flag of every normalised column of the loaded cell tables."""
    cols = fixtures.cells(spark, sf_dir).select("table_id", "col").distinct()
    named = cols.select("table_id", "col", sql_identifier("col").alias("column_name"))
    return named.withColumn("is_date_like", columns.date_like())


def column_type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.column_profile(fixtures.cells(spark, sf_dir))


def lenient_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.cells(spark, sf_dir)
    return inference.typed_cells(cells, inference.column_profile(cells), lenient=True)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.sources.tables import table
    return table(spark, sf_dir, "pages").select("page_id", "html")


def discovered_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.discover_links(_pages(spark, sf_dir))


def element_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.element_survey(_pages(spark, sf_dir))


def keyword_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The collected pages hold no <span>; links are surveyed instead.
    return discover.keyword_survey(_pages(spark, sf_dir), tag="a")


def module_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.sources.catalog import CRAWL_MODULE_LABELS
    return discover.module_element(_pages(spark, sf_dir), list(CRAWL_MODULE_LABELS.values()), tag="a")


REPORT_STAMP = "2025-09-14 13:29:07"
REPORT_DIR = "data/downloads"


def missing_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.plans import reports
    return reports.missing_report_lines(catalog(spark), _files(spark, sf_dir), REPORT_STAMP, REPORT_DIR)


def downloads_by_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.plans import reports
    return reports.downloads_by_module(fixtures.downloads(spark, sf_dir), reports.modules_frame(spark))


def run_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.plans import reports
    return reports.run_summary_lines(fixtures.downloads(spark, sf_dir), reports.modules_frame(spark),
                                     REPORT_STAMP, REPORT_DIR)


#: Modules whose datasets are configured in ``preset_summary_lines``.
CONFIGURED = {"agua": ["Nivel medio del mar"]}


def preset_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The download summary when one module has configured datasets."""
    from berth.plans import reports
    return reports.run_summary_lines(fixtures.downloads(spark, sf_dir), reports.modules_frame(spark, CONFIGURED),
                                     REPORT_STAMP, REPORT_DIR)


@contextmanager
def _loaded_events(spark: SparkSession, sf_dir: str):
    """Land ``events`` as CSV files (one folder per event type) in a scratch folder and load
    them; gives (manifest, target) while the folder is there."""
    from berth.plans import load
    from berth.session import scratch_folder
    from berth.sources.tables import table

    with scratch_folder(spark, "events") as root:
        table(spark, sf_dir, "events").write.partitionBy("event_type").option("header", True).csv(f"{root}/landing")
        target = load.Target(schema="landing", location=f"{root}/tables")
        yield load.load_directory(spark, f"{root}/landing", target, mode="replace", table_from="dir"), target


def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _loaded_events(spark, sf_dir) as (manifest, _):
        return manifest.groupBy("table").agg(F.sum("n_rows").cast("bigint").alias("n_rows"))


def loaded_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from berth.plans import load
    with _loaded_events(spark, sf_dir) as (manifest, target):
        tables = sorted({r[0] for r in manifest.select("table").distinct().collect()})
        rows = [(t, i + 1, c, ty) for t in tables for i, (c, ty) in enumerate(load.table_columns(spark, t, target))]
    return spark.createDataFrame(rows, "table STRING, ordinal BIGINT, column_name STRING, type STRING")


def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files loaded and rows inserted in total; one folder of files for each month of orders."""
    from berth.plans import load
    from berth.session import scratch_folder

    with scratch_folder(spark, "totals") as root:
        fixtures.land_months(spark, sf_dir, f"{root}/landing")
        target = load.Target(schema="landing", location=f"{root}/tables")
        return load.load_totals(load.load_directory(spark, f"{root}/landing", target, table_from="dir")).select("n_tables", "n_rows")


def month_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each month (two layouts, day-first dates), loaded leniently in the same
    few jobs and read back."""
    from berth.plans import load
    from berth.session import scratch_folder

    with scratch_folder(spark, "months") as root:
        fixtures.land_months(spark, sf_dir, f"{root}/landing")
        target = load.Target(schema="landing", location=f"{root}/tables")
        load.load_directory(spark, f"{root}/landing", target, mode="replace", table_from="dir", lenient=True)
        schema = "numero bigint, fecha_orden timestamp, total double, estado string"
        loaded = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/tables")
        name = F.element_at(F.split("_metadata.file_path", "/"), -2)
        day = lambda c: F.date_format(c, "yyyy-MM-dd")
        return (loaded.groupBy(name.alias("table"))
                .agg(F.count("*").alias("n_rows"), F.sum("numero").alias("numbers"), day(F.min("fecha_orden")).alias("first_day"),
                     day(F.max("fecha_orden")).alias("last_day"), F.sum(F.round(F.col("total") * 100).cast("bigint")).alias("cents"),
                     F.count("estado").alias("n_estado")).checkpoint(eager=True))


def expected_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected titles per scope, and of all (scope ``total``), beside the titles that the landing zone holds."""
    found = reconcile.title_matches(catalog(spark), _files(spark, sf_dir)).select("idx").distinct().withColumn("held", F.lit(1))
    rows = catalog(spark).join(F.broadcast(found), "idx", "left")  # at most one row a title
    sums = rows.rollup("scope").agg(F.count("*").alias("n_expected"), F.count("held").alias("n_held"))
    return sums.withColumn("scope", F.coalesce("scope", F.lit("total")))


def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed tree, listed by the ``landing_files`` source: its CSV files in listing order
    (lower-cased name, then name, then folder)."""
    from berth.operators.ranking import rank_within
    from berth.session import scratch_folder
    from berth.sources.files import csv_files
    from berth.sources.listing import absolute

    with scratch_folder(spark, "tree") as root:
        fixtures.land_tree(spark, sf_dir, root)
        files = csv_files(spark, root)
    rel = F.substring("path", len(absolute(root)) + 2, 1 << 20)
    return rank_within(files.select(rel.alias("rel"), "name", "length"), [], [F.lower("name"), F.col("name"), F.col("rel")], "place")


def module_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.discover_module_datasets(fixtures.portal_pages(spark, sf_dir), fixtures.MODULE_NAMES[0])


def tree_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.tree_survey(fixtures.portal_pages(spark, sf_dir))


def portal_keyword_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.keyword_survey(fixtures.portal_pages(spark, sf_dir))


def portal_module_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.module_element(fixtures.portal_pages(spark, sf_dir), fixtures.MODULE_NAMES)


def wild_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.discover_links(fixtures.wild_pages(spark, sf_dir))


def wild_module_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.discover_module_datasets(fixtures.wild_pages(spark, sf_dir), fixtures.MODULE_NAMES[0])


def wild_element_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.element_survey(fixtures.wild_pages(spark, sf_dir))


def wild_module_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.module_element(fixtures.wild_pages(spark, sf_dir), fixtures.MODULE_NAMES)


def quoted_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` landed as CSV text of our own (doubled quotes, line breaks inside
    fields, two header orders, half-numeric, boolean and empty columns), loaded
    leniently and read back."""
    return _quoted(spark, sf_dir)


def ranged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, each read in ranges of 16 KB by many tasks."""
    return _quoted(spark, sf_dir, range_bytes=1 << 14)


def _quoted(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    from berth.plans import load
    from berth.session import scratch_folder

    with scratch_folder(spark, "quoted") as root:
        fixtures.land_quoted(spark, sf_dir, f"{root}/landing")
        target = load.Target(schema="landing", location=f"{root}/tables")
        load.load_directory(spark, f"{root}/landing", target, mode="replace", table_from="dir", lenient=True, **options)
        loaded = spark.read.parquet(f"{root}/tables/landing/events")
        return loaded.withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd HH:mm:ss")).checkpoint(eager=True)
