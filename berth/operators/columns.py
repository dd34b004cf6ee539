"""Column naming of loaded CSV files.

A header goes through three steps, in column order per table:

1. the reader's own de-duplication: the k-th repeat of an exact header text
   becomes ``text.k`` and a blank header becomes ``Unnamed: i`` (0-based);
2. the SQL identifier of each text;
3. the n-th repeat (n ≥ 2) of an identifier becomes ``identifier_n``.

Step 3 can itself produce a repeat (``x, x, x_2`` → ``x, x_2, x_2``); it is
kept as such and :func:`collisions` reports it so a load can refuse it.
Both numbering steps are windows partitioned by (table, name): a skewed
table spreads over its distinct names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from berth.functions.text import sql_identifier

# ---------------------------------------------------------------------------
# FIXED VALUES — column-name words that mark a date-like column (matched
# anywhere in the normalised name, so "plano" and "mesa" match too).
# ---------------------------------------------------------------------------
DATE_LIKE_PATTERN = r"(fecha|date|time|datetime|anio|ano|year|mes|month)"
UNNAMED_PREFIX = "Unnamed: "
# ---------------------------------------------------------------------------


def reader_names(headers: DataFrame) -> DataFrame:
    """Add ``read_name``: the header text as the CSV reader reports it."""
    raw = F.col("raw_name")
    blank = raw.isNull() | (raw == "")
    named = headers.withColumn(
        "__h", F.when(blank, F.concat(F.lit(UNNAMED_PREFIX), (F.col("ordinal") - 1).cast("string")))
        .otherwise(raw))
    k = F.row_number().over(Window.partitionBy("table_id", "__h").orderBy("ordinal"))
    return named.withColumn("__k", k).withColumn(
        "read_name", F.when(F.col("__k") == 1, F.col("__h"))
        .otherwise(F.concat("__h", F.lit("."), (F.col("__k") - 1).cast("string")))
    ).drop("__h", "__k")


def normalized_columns(headers: DataFrame) -> DataFrame:
    """``table_id, ordinal, raw_name, column_name`` (input: ``table_id,
    ordinal, raw_name``)."""
    d = reader_names(headers).withColumn("__base", sql_identifier("read_name"))
    n = F.row_number().over(Window.partitionBy("table_id", "__base").orderBy("ordinal"))
    d = d.withColumn("__n", n)
    name = F.when(F.col("__n") == 1, F.col("__base")).otherwise(
        F.concat("__base", F.lit("_"), F.col("__n").cast("string")))
    return d.select("table_id", "ordinal", "raw_name", name.alias("column_name"))


def collisions(columns: DataFrame) -> DataFrame:
    """Normalised names that still repeat within a table (a load must stop)."""
    return (columns.groupBy("table_id", "column_name").agg(F.count("*").alias("n"))
            .where(F.col("n") > 1))


def date_like(name_col: str = "column_name") -> F.Column:
    return F.col(name_col).rlike(DATE_LIKE_PATTERN)
