"""File counts of a landing-zone inventory (all file kinds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.functions.stems import extension
from berth.operators.reconcile import CatalogIndex, with_match_flag
from berth.sources.catalog import AIR_TITLES, WATER_TITLES


def count_by_extension(inv: DataFrame) -> DataFrame:
    """``ext, n_files`` — lower-cased suffix (or the no-extension label),
    most frequent first, ties by extension. Partial aggregation keeps the
    shuffle at one row per extension per map task, whatever the skew."""
    return (inv.groupBy(extension("name").alias("ext"))
            .agg(F.count("*").alias("n_files"))
            .orderBy(F.desc("n_files"), F.asc("ext")))


def count_report(inv: DataFrame, cat: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """One row: total files, ``.csv`` files (case-folded), expected titles per
    scope and in total, and CSV files (case-sensitive ``*.csv``) that match no
    expected title — one pass over the inventory."""
    is_csv_glob = F.col("name").endswith(".csv")
    flagged = with_match_flag(cat, inv, index)
    return flagged.agg(
        F.count("*").alias("n_files"),
        F.count_if(extension("name") == ".csv").alias("n_csv"),
        F.lit(len(AIR_TITLES)).cast("bigint").alias("n_expected_aire"),
        F.lit(len(WATER_TITLES)).cast("bigint").alias("n_expected_agua"),
        F.lit(len(AIR_TITLES) + len(WATER_TITLES)).cast("bigint").alias("n_expected"),
        F.count_if(is_csv_glob & ~F.col("__matched")).alias("n_extra_csv"),
    )
