"""File listings of a landing folder as DataFrames (the source itself: :mod:`berth.sources.listing`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.session import ensure_checkpoint_dir
from berth.sources.listing import FolderNotFound, file_system, listing

__all__ = ["FolderNotFound", "csv_files", "file_system", "inventory"]


def inventory(spark: SparkSession, folder: str, recursive: bool = True,
              glob: str | None = None) -> DataFrame:
    """``path, dir, name, mtime, length, file_id`` of every file under
    ``folder`` (its direct children when ``recursive`` is false). ``glob``
    filters file names case-sensitively (``*.csv`` excludes ``B.CSV``).

    The listing is taken once and checkpointed in the shared folder: all that follows sees
    the same files, also while they are being renamed."""
    ensure_checkpoint_dir(spark)
    files = listing(spark, folder, recursive, glob)
    return files.withColumn("file_id", F.xxhash64("path")).checkpoint(eager=True)


def csv_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """CSV files (``*.csv``, case-sensitive) under ``folder``."""
    return inventory(spark, folder, recursive=recursive, glob="*.csv")
