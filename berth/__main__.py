"""Command line: the landing-zone tool's flags, each one Spark job.

    python -m berth --countfiles --dir <folder>
    python -m berth --missingfiles [--scope all|aire|agua] [--report <file>] --dir <folder>
    python -m berth --summary [--configured aire=<title>|<title>] [--report <file>] --dir <folder>
    python -m berth --standardize [--drop-timestamp] [--dry-run] --dir <folder>
    python -m berth --loaddb --dir <folder> [--schema public] [--if-exists append|replace|fail]
                    [--location <tables folder> | --jdbc-url <url>] [--csv-sep ,] [--csv-encoding UTF-8]

Exit codes: 0 done, 2 missing or extra files / load error, 3 folder missing.
The session comes from ``SparkSession.builder`` (spark-submit configures it).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="berth", description="Landing-zone jobs on Spark")
    p.add_argument("--dir", required=True, help="target folder (any Hadoop/pyarrow path)")
    p.add_argument("--countfiles", action="store_true")
    p.add_argument("--missingfiles", action="store_true")
    p.add_argument("--scope", choices=["all", "aire", "agua"], default="all")
    p.add_argument("--summary", action="store_true", help="summary of the downloads by module")
    p.add_argument("--configured", action="append", default=[], metavar="MODULE=TITLE|TITLE",
                   help="datasets of a module that are configured, not discovered")
    p.add_argument("--report", help="where to write the report (default: in the folder)")
    p.add_argument("--standardize", action="store_true")
    p.add_argument("--drop-timestamp", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--recursive", action="store_true", help="standardise every sub-folder too")
    p.add_argument("--loaddb", action="store_true")
    p.add_argument("--schema", default="public")
    p.add_argument("--if-exists", choices=["append", "replace", "fail"], default="append")
    p.add_argument("--location", help="write tables as parquet folders under this path")
    p.add_argument("--jdbc-url", help="write tables through JDBC (batch 10,000)")
    p.add_argument("--csv-sep", default=",")
    p.add_argument("--csv-encoding", default="UTF-8")
    p.add_argument("--lenient", action="store_true", help="convert text columns that hold numbers or dates")
    return p.parse_args(argv)


def _lines(df) -> None:
    """All rows, tab-separated; the driver holds one partition at a time."""
    print("\t".join(df.columns))
    for r in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))


def _report(lines) -> None:
    """A report's lines in order; the driver holds one partition at a time."""
    from berth.plans.reports import in_order

    for r in in_order(lines).toLocalIterator():
        print(r["line"])


def main(argv: list[str] | None = None) -> int:
    from berth.plans import jobs
    from berth.plans.load import LoadError, load_totals
    from berth.session import ensure_checkpoint_dir

    args = parse(argv)
    spark = SparkSession.builder.appName("berth").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.countfiles:
        status, by_ext, report = jobs.count_files(spark, args.dir)
        if status:
            print(f"folder not found: {args.dir}")
            return status
        _lines(by_ext)
        report.show(truncate=False)
        return 0
    if args.missingfiles:
        status, _, lines = jobs.reconcile_folder(spark, args.dir, args.scope, report_path=args.report)
        if lines is None:
            print(f"folder not found: {args.dir}")
        else:
            _report(lines)
        return status
    if args.summary:
        configured = {m: [t for t in titles.split("|") if t] for m, _, titles in (c.partition("=") for c in args.configured)}
        status, lines = jobs.summarize_downloads(spark, args.dir, configured, report_path=args.report)
        if lines is None:
            print(f"folder not found: {args.dir}")
        else:
            _report(lines)
        return status
    if args.standardize:
        try:
            changes = jobs.standardize(spark, args.dir, args.drop_timestamp, args.dry_run, args.recursive)
        except jobs.FolderNotFound:
            print(f"folder not found: {args.dir}")
            return 3
        _lines(changes.select("src", "dst"))
        return 0
    if args.loaddb:
        try:
            manifest = jobs.load_folder(spark, args.dir, args.schema, args.if_exists, args.csv_sep,
                                        args.csv_encoding, args.location, args.jdbc_url, args.lenient)
        except jobs.FolderNotFound:
            print(f"folder not found: {args.dir}")
            return 3
        except LoadError as e:
            print(f"load failed: {e}")
            return 2
        _lines(manifest)
        load_totals(manifest).show()
        return 0
    print("nothing to do: pass --countfiles, --missingfiles, --summary, --standardize or --loaddb")
    return 0


if __name__ == "__main__":
    sys.exit(main())
