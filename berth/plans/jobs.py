"""End-to-end jobs over a landing folder (the command-line flags of a
landing-zone tool, as functions with the same defaults)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.operators import counts, reconcile, rename
from berth.operators.ranking import rank_within
from berth.plans import apply, load, reports
from berth.sources.catalog import catalog, reconcile_scopes
from berth.sources.files import FolderNotFound, csv_files, inventory

# FIXED VALUES — names of the reports in the folder.
MISSING_REPORT = "missingfiles.txt"
SUMMARY_REPORT = "scraping_report.txt"


def count_files(spark: SparkSession, folder: str) -> tuple[int, DataFrame | None, DataFrame | None]:
    """Status (0, or 3 for a missing folder), counts by extension, report row."""
    try:
        inv = inventory(spark, folder)
    except FolderNotFound:
        return 3, None, None
    return 0, counts.count_by_extension(inv), counts.count_report(inv, catalog(spark))


def _now() -> str:
    return dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def reconcile_folder(spark: SparkSession, folder: str, scope: str = "all", stamp: str | None = None,
                     report_path: str | None = None) -> tuple[int, DataFrame | None, DataFrame | None]:
    """Missing titles and extra files of ``folder``; the report goes to ``report_path``, or
    to ``missingfiles.txt`` in the folder. Returns (status, status row, report lines)."""
    try:
        files = csv_files(spark, folder)
    except FolderNotFound:
        return reconcile.STATUS_NO_FOLDER, None, None
    scopes = reconcile_scopes(scope)
    cat = catalog(spark).where(F.col("scope").isin(*scopes))
    row = reconcile.status(cat, files).checkpoint(eager=True)
    lines = reports.missing_report_lines(cat, files, stamp or _now(), folder, scope).checkpoint(eager=True)
    reports.write_lines(lines, report_path or f"{folder.rstrip('/')}/{MISSING_REPORT}")
    return int(row.first()["status"]), row, lines


def download_ledger(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``module, path, file_id``: the CSV files of catalogue titles under the scope of their
    title (the first in the catalogue, if several match); ``file_id`` numbers the files of a
    module by time, then path."""
    title = (reconcile.title_matches(catalog(spark), files).groupBy("file_id").agg(F.min("idx").alias("idx"))
             .join(catalog(spark).select("idx", F.col("scope").alias("module")), "idx"))
    held = files.join(title, "file_id").select("module", "path", "mtime")
    return rank_within(held, ["module"], [F.col("mtime"), F.col("path")], "file_id").select("module", "path", "file_id")


def summarize_downloads(spark: SparkSession, folder: str, configured: dict[str, list[str]] | None = None,
                        stamp: str | None = None, report_path: str | None = None) -> tuple[int, DataFrame | None]:
    """Summary of the downloads that ``folder`` holds, by module; ``configured`` names the
    datasets of modules that are not discovered. The report goes to ``report_path``, or to
    ``scraping_report.txt`` in the folder. Returns (0, or 3 for a missing folder; report lines)."""
    try:
        files = csv_files(spark, folder)
    except FolderNotFound:
        return 3, None
    modules = reports.modules_frame(spark, configured)
    lines = reports.run_summary_lines(download_ledger(spark, files), modules, stamp or _now(), folder).checkpoint(eager=True)
    reports.write_lines(lines, report_path or f"{folder.rstrip('/')}/{SUMMARY_REPORT}")
    return 0, lines


def standardize(spark: SparkSession, folder: str, drop_timestamp: bool = False,
                dry_run: bool = False, recursive: bool = False) -> DataFrame:
    """Plan (and unless ``dry_run``, apply) standard names for the CSV files
    of ``folder`` (one level by default; every folder when ``recursive``). Runs that
    stopped half-way are finished first, unless ``dry_run``."""
    if not dry_run:
        apply.recover(spark)
    files = csv_files(spark, folder, recursive=recursive)
    changes = rename.rename_changes(rename.rename_plan(files, drop_timestamp))
    if dry_run:
        return changes
    return apply.apply_plan(spark, changes)


def load_folder(spark: SparkSession, folder: str, schema: str = "public", if_exists: str = "append",
                sep: str = ",", encoding: str = "UTF-8", location: str | None = None,
                jdbc_url: str | None = None, lenient: bool = False) -> DataFrame:
    """Load every CSV under ``folder`` (recursively); returns the manifest."""
    target = load.Target(schema=schema, location=location, jdbc_url=jdbc_url)
    return load.load_directory(spark, folder, target, mode=if_exists, sep=sep, encoding=encoding, lenient=lenient)
