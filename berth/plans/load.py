"""Load landing CSV files into tables.

Each CSV file feeds the table named by the SQL identifier of its stem (or of
its folder, ``table_from="dir"``). All tables go through the same few jobs,
whatever their number:

1. headers, read by the tasks, a few bytes a file; column names by position (the
   reader's duplicate renaming, identifiers, ``_n`` numbering) for all distinct
   headers at once;
2. records (:mod:`berth.sources.records`): files are cut into ranges, so that a large
   file is read by many tasks; cells are put in their table's column order and written
   once, by *layout* (tables with the same columns);
3. one grouped aggregate over (table, position) picks every column's type, one over
   the files counts rows and finds a record with more fields than its header;
4. a write for each layout and types: tables of a folder target that share both are
   written together and dealt into their folders by the tasks; a catalogue or JDBC
   target takes one table at a time.

The driver holds a row for each layout with its types, and the names of the tables only
for targets that take one at a time.

A name that still repeats stops the load. Files of one table unite by name: the file
that comes first gives the table's columns, a column that another file lacks is NULL
there, and one that the table lacks stops the load, as does a record that is too wide.
Quotes are doubled inside quoted fields and fields may hold line breaks. A table
without any record has text columns. What the load keeps on the way is removed at its end.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from berth.functions.stems import stem
from berth.functions.text import sql_identifier
from berth.operators import columns as C
from berth.operators import inference as I
from berth.session import delete_folder, ensure_checkpoint_dir, scratch_folder
from berth.sources import records as R
from berth.sources.files import FolderNotFound, csv_files, file_system
from berth.sources.listing import absolute, listing

MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
JDBC_BATCH = 10_000
PARALLEL_WRITES = 8


#: No column has this name: identifiers start with a letter.
_TABLE = "__table"


class LoadError(Exception):
    pass


@dataclass
class Target:
    """Where tables go: a catalogue schema, a folder of parquet tables, or a
    JDBC URL (same ``schema`` name as the database schema)."""
    schema: str = "public"
    location: str | None = None
    jdbc_url: str | None = None
    jdbc_properties: dict | None = None


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; nothing for an empty name."""
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema.replace('`', '``')}`")


def ensure_database_schema(spark: SparkSession, target: Target) -> None:
    """The same in the database behind ``target.jdbc_url`` (never run here: no database)."""
    if target.schema:
        manager = spark._jvm.java.sql.DriverManager
        properties = spark._jvm.java.util.Properties()
        for k, v in (target.jdbc_properties or {}).items():
            properties.setProperty(k, str(v))
        connection = manager.getConnection(target.jdbc_url, properties)
        try:
            connection.createStatement().execute('CREATE SCHEMA IF NOT EXISTS "' + target.schema.replace('"', '""') + '"')
        finally:
            connection.close()


def file_tables(files: DataFrame, table_from: str = "stem") -> DataFrame:
    """``path, name, length, table`` for CSV files (``files`` from :func:`csv_files`)."""
    if table_from == "stem":
        source = stem("name")
    elif table_from == "dir":
        source = F.element_at(F.split("dir", "/"), -1)
    else:
        raise ValueError("table_from must be 'stem' or 'dir'")
    return files.select("path", "name", "length", sql_identifier(source).alias("table"))


def layouts(told: DataFrame) -> DataFrame:
    """``told(path, name, table, header, ...)`` with ``names`` (of the file's fields), ``columns``
    (the table's) and ``layout`` (one for equal columns); raises on names that repeat and on
    columns that the table lacks."""
    key = F.sha2(F.to_json(F.struct("table", "header")), 256)
    told = told.withColumn("head", key)
    heads = told.select("head", "table", "header").distinct()
    fields = heads.select(F.col("head").alias("table_id"), F.posexplode("header").alias("pos", "raw_name"))
    named = C.normalized_columns(fields.select("table_id", (F.col("pos") + 1).cast("long").alias("ordinal"), "raw_name"))
    in_order = F.sort_array(F.collect_list(F.struct("ordinal", "column_name")))
    names = named.groupBy(F.col("table_id").alias("head")).agg(F.transform(in_order, lambda c: c["column_name"]).alias("names"))
    names = heads.select("head", "table").join(names, "head").checkpoint(eager=True)
    repeated = names.where(F.size(F.array_distinct("names")) < F.size("names")).head()
    if repeated:
        dupes = sorted({n for n in repeated["names"] if list(repeated["names"]).count(n) > 1})
        raise LoadError(f"table {repeated['table']}: column names repeat after normalising: {dupes}")
    told = told.join(names.select("head", "names"), "head").drop("head")
    first = told.groupBy("table").agg(F.min_by("names", F.struct(F.lower("name").alias("l"), F.col("path"))).alias("columns"))
    told = told.join(first, "table").withColumn("layout", F.sha2(F.to_json("columns"), 256))
    unknown = told.withColumn("unknown", F.array_except("names", "columns")).where(F.size("unknown") > 0).head()
    if unknown:
        raise LoadError(f"table {unknown['table']} has no column {list(unknown['unknown'])}: {unknown['path']}")
    return told


def table_types(rows: DataFrame, tables: DataFrame, lenient: bool, date_formats: tuple[str, ...]) -> DataFrame:
    """``(table, layout, columns, types, empty, write)`` of every table, ``types`` in column order, from
    one aggregate over (table, position) of ``rows(table, cells)``; ``write`` names the tables that
    are written together."""
    formats = date_formats if lenient else ()
    counts = rows.select("table", F.posexplode("cells").alias("pos", "value")).groupBy("table", "pos").agg(*I.kind_counts(F.col("value"), formats))
    named = counts.join(tables, "table").withColumn("column_name", F.get("columns", F.col("pos")))
    chosen = named.select("table", "pos", I.chosen_kind(lenient, C.date_like(), formats).alias("kind"))
    in_order = F.sort_array(F.collect_list(F.struct("pos", "kind")))
    types = chosen.groupBy("table").agg(F.transform(in_order, lambda c: c["kind"]).alias("types"))
    text = F.transform("columns", lambda _: F.struct(F.lit(I.STRING).alias("type"), F.lit(None).cast("string").alias("pattern")))
    return (tables.join(types, "table", "left")
            .select("table", "layout", "columns", F.coalesce("types", text).alias("types"), F.col("types").isNull().alias("empty"))
            .withColumn("write", F.sha2(F.to_json(F.struct("columns", "types", "empty")), 256)))


def typed(rows: DataFrame, columns: list[str], types: list[Row]) -> DataFrame:
    """``table`` and the typed columns of ``rows(table, cells)``."""
    return rows.select(F.col("table").alias(_TABLE), *(I.as_kind(F.get("cells", F.lit(i)), t["type"], t["pattern"]).alias(n)
                                                       for i, (n, t) in enumerate(zip(columns, types))))


def write_table(df: DataFrame, table: str, mode: str, target: Target) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}: {mode!r}")
    writer = df.write.mode(MODES[mode])
    if target.jdbc_url:
        dbtable = f"{target.schema}.{table}" if target.schema else table
        props = dict(target.jdbc_properties or {})
        writer.format("jdbc").option("url", target.jdbc_url).option("dbtable", dbtable) \
            .option("batchsize", JDBC_BATCH).options(**props).save()
    elif target.location:
        writer.parquet(os.path.join(target.location, target.schema or "", table))
    else:
        writer.saveAsTable(f"`{target.schema}`.`{table}`" if target.schema else f"`{table}`")


def _folder(target: Target) -> str:
    return os.path.join(target.location, target.schema or "")


def write_tables(df: DataFrame, tables: DataFrame, mode: str, target: Target) -> None:
    """Write the rows of many tables, ``df(__table, columns...)``, into their folders of a
    folder target: one job writes them all beside the tables, then the tasks move each
    table's files into its folder (a file that is there already is not moved again)."""
    spark, home = df.sparkSession, absolute(_folder(target))
    staging = f"{home}/.staging-{uuid.uuid4().hex}"

    def there(parts):
        for part in parts:
            found = []
            for table in part.column("table").to_pylist():
                fs, at = file_system(f"{home}/{table}")
                found.append(fs.get_file_info(at).type.name != "NotFound")
            yield pa.RecordBatch.from_arrays([part.column("table").filter(pa.array(found))], ["table"])

    def clear(rows):
        for r in rows:
            fs, at = file_system(f"{home}/{r['table']}")
            fs.create_dir(at, recursive=True)
            fs.delete_dir_contents(at)

    def move(rows):
        for r in rows:
            fs, at = file_system(r["path"])
            table = r["dir"].rsplit("=", 1)[1]
            _, to = file_system(f"{home}/{table}")
            fs.create_dir(to, recursive=True)
            if fs.get_file_info(at).is_file:  # else an earlier attempt moved it
                fs.move(at, f"{to}/{r['name']}")

    if mode == "fail" and (found := tables.mapInArrow(there, "table string").head()):
        raise LoadError(f"table exists: {found[0]}")
    try:
        df.hint("rebalance", _TABLE).write.partitionBy(_TABLE).parquet(staging)
        if mode == "replace":
            tables.foreachPartition(clear)
        listing(spark, staging, glob="*.parquet", pushdown=False).select("path", "dir", "name").foreachPartition(move)
    finally:
        delete_folder(spark, staging)


def load_files(files: DataFrame, target: Target | None = None, mode: str = "append", sep: str = ",",
               encoding: str = "UTF-8", parallel_writes: int = PARALLEL_WRITES, lenient: bool = False,
               date_formats: tuple[str, ...] = I.DATE_FORMATS, range_bytes: int = R.RANGE_BYTES) -> DataFrame:
    """Load ``files(path, name, length, table)``; returns the manifest ``path, table,
    n_rows`` (files in lower-cased name order). ``lenient`` converts text columns that hold
    numbers, and those with date-like names that hold dates in one of ``date_formats``."""
    spark, target = files.sparkSession, target or Target()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}: {mode!r}")
    if target.jdbc_url:
        ensure_database_schema(spark, target)
    elif not target.location:
        ensure_schema(spark, target.schema)
    ensure_checkpoint_dir(spark)
    told = R.with_headers(files.select("path", "name", "length", "table"), sep, encoding).checkpoint(eager=True)
    if bare := told.where(F.size("header") == 0).select("path").head():
        raise LoadError(f"no header: {bare[0]}")
    if mode == "fail" and (shared := told.groupBy("table").count().where("count > 1").head()):
        raise LoadError(f"several files map to one table: {shared['table']}")
    planned = layouts(told).checkpoint(eager=True)
    tables = planned.select("table", "layout", "columns").distinct()
    with scratch_folder(spark, "load") as scratch:
        R.records(planned, sep, encoding, range_bytes).write.partitionBy("layout").parquet(scratch)
        rows = spark.read.schema("path string, table string, cells array<string>, wide boolean, layout string").parquet(scratch)
        per_file = rows.groupBy("path").agg(F.count("*").alias("n_rows"), F.max("wide").alias("wide")).checkpoint(eager=True)
        if wide := per_file.where("wide").head():
            raise LoadError(f"a row has more fields than the header: {wide['path']}")
        kinds = table_types(rows, tables, lenient, date_formats).checkpoint(eager=True)
        classes = kinds.groupBy("write", "layout", "columns", "types", "empty").agg(F.count("*").alias("n"), F.min("table").alias("one")).collect()

        def write(c: Row) -> None:
            own = kinds.where(F.col("write") == c["write"]).select("table")
            mine = rows.where(F.col("layout") == c["layout"])
            if c["n"] > 1 and target.location and not target.jdbc_url and not c["empty"]:
                write_tables(typed(mine.join(own, "table"), c["columns"], c["types"]), own, mode, target)
                return
            for t in [c["one"]] if c["n"] == 1 else [r[0] for r in own.toLocalIterator()]:
                write_table(typed(mine.where(F.col("table") == t), c["columns"], c["types"]).drop(_TABLE), t, mode, target)

        # Layouts are independent: their jobs are submitted side by side (the scheduler shares the cluster).
        with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            list(pool.map(write, classes))
    manifest = planned.select("path", "name", "table").join(per_file, "path", "left")
    return manifest.orderBy(F.lower("name"), "path").select(
        "path", "table", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))


def load_directory(spark: SparkSession, folder: str, target: Target | None = None,
                   mode: str = "append", sep: str = ",", encoding: str = "UTF-8",
                   recursive: bool = True, table_from: str = "stem", **options) -> DataFrame:
    """Load every CSV file under ``folder``; ``options`` as in :func:`load_files`."""
    return load_files(file_tables(csv_files(spark, folder, recursive), table_from), target, mode, sep, encoding, **options)


def load_csv(spark: SparkSession, path: str, table: str | None = None, target: Target | None = None,
             mode: str = "append", **options) -> DataFrame:
    """Load one CSV file into ``table`` (by default named after the file)."""
    path = os.path.abspath(path) if "://" not in path and not path.startswith("file:") else path
    fs, at = file_system(path)
    if not fs.get_file_info(at).is_file:
        raise FolderNotFound(path)
    listed = path if "://" in path or path.startswith("file:") else "file:" + path
    one = spark.createDataFrame([(listed, os.path.basename(at), fs.get_file_info(at).size)], "path string, name string, length long")
    name = F.lit(table) if table else stem("name")
    return load_files(one.withColumn("table", sql_identifier(name)), target, mode, **options)


def table_columns(spark: SparkSession, table: str, target: Target) -> list[tuple[str, str]]:
    """``(column, TYPE)`` of a loaded table, in column order."""
    if target.location:
        df = spark.read.parquet(os.path.join(target.location, target.schema or "", table))
    else:
        df = spark.table(f"`{target.schema}`.`{table}`" if target.schema else f"`{table}`")
    names = {"bigint": I.LONG, "double": I.DOUBLE, "boolean": I.BOOLEAN, "string": I.STRING,
             "timestamp": I.TIMESTAMP}
    return [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString().upper()))
            for f in df.schema.fields]


def load_totals(manifest: DataFrame) -> DataFrame:
    """One row: files loaded, the tables they went to and rows inserted in total."""
    return manifest.agg(F.count("*").alias("n_files"), F.count_distinct("table").alias("n_tables"),
                        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"))
