import os

import pytest

from berth.plans import jobs
from berth.plans import load as L
from berth.sources.files import FolderNotFound, inventory


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_load_modes_and_manifest(spark, scratch):
    land = os.path.join(scratch, "land")
    write(os.path.join(land, "Año (2,5) x.csv"), "﻿Año,Valor,a b,a-b,Valor\n2020,1.5,x,true,n/a\n2021,2,y,false,3\n")
    write(os.path.join(land, "sub", "B.CSV"), "a\n1\n")
    write(os.path.join(land, "sub", "Año (2,5) x.csv"), "Año,Valor,a b,a-b,Valor\n2022,4,z,true,5\n")
    tgt = L.Target(schema="s", location=os.path.join(scratch, "tables"))
    m = L.load_directory(spark, land, tgt)
    assert sorted((os.path.basename(r["path"]), r["table"], r["n_rows"]) for r in m.collect()) == [
        ("Año (2,5) x.csv", "ano_2_5_x", 1), ("Año (2,5) x.csv", "ano_2_5_x", 2)]
    t = spark.read.parquet(os.path.join(scratch, "tables", "s", "ano_2_5_x"))
    assert t.columns == ["ano", "valor", "a_b", "a_b_2", "valor_1"]
    assert dict(L.table_columns(spark, "ano_2_5_x", tgt)) == {
        "ano": "LONG", "valor": "DOUBLE", "a_b": "STRING", "a_b_2": "BOOLEAN", "valor_1": "LONG"}
    assert t.count() == 3
    L.load_directory(spark, land, tgt, mode="append")
    assert spark.read.parquet(os.path.join(scratch, "tables", "s", "ano_2_5_x")).count() == 6
    L.load_directory(spark, land, tgt, mode="replace")
    assert spark.read.parquet(os.path.join(scratch, "tables", "s", "ano_2_5_x")).count() == 3
    with pytest.raises(L.LoadError):
        L.load_directory(spark, land, tgt, mode="fail")


def test_load_refuses_repeated_names(spark, scratch):
    write(os.path.join(scratch, "l", "t.csv"), "a b,a-b,a_b_2\n1,2,3\n")
    with pytest.raises(L.LoadError):
        L.load_directory(spark, os.path.join(scratch, "l"), L.Target(location=os.path.join(scratch, "o")))


@pytest.mark.parametrize("size", [1, 7, 64, 300, 100_000])
def test_files_read_in_ranges_have_the_same_records(spark, scratch, size):
    """Line breaks, separators and quotes inside quotes; ranges that start anywhere."""
    import csv
    import io
    import random

    from berth.sources import records as R
    rng = random.Random(size)
    cell = lambda: "".join(rng.choice(['a', 'é', ',', '"', '\n', '\r\n', ' ']) for _ in range(rng.randint(0, 9)))
    rows = [[str(i), cell(), cell()] for i in range(80)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\r\n" if size % 2 else "\n").writerows([["id", "x", 'y "z"']] + rows)
    text = out.getvalue()
    for name, data in {"with.csv": text, "without.csv": text.rstrip("\r\n") if text[-3:-1] != '"' else text, "bom.csv": "\ufeff" + text}.items():
        write(os.path.join(scratch, "r", name), data)
    from berth.sources.files import csv_files
    told = L.layouts(R.with_headers(L.file_tables(csv_files(spark, os.path.join(scratch, "r"))), ",", "UTF-8"))
    found = {}
    for r in R.records(told, size=size).collect():
        found.setdefault(os.path.basename(r.path), []).append(list(r.cells))
        assert not r.wide
    assert set(found) == {"with.csv", "without.csv", "bom.csv"}
    for got in found.values():
        assert sorted(got, key=lambda r: int(r[0])) == rows


@pytest.mark.parametrize("size", [100, 100_000])
def test_ranges_are_dealt_to_tasks_by_bytes(spark, scratch, monkeypatch, size):
    """However small the rows that name them, no task gets more than its share and one range."""
    from pyspark.sql import functions as F

    from berth.sources import records as R
    from berth.sources.files import csv_files
    monkeypatch.setattr(R, "TASK_BYTES", 2_000, raising=False)
    for i in range(30):
        write(os.path.join(scratch, "d", f"f{i}.csv"), "a,b\n" + f'{i},"x\n"\n' * (20 + 10 * (i % 7)))
    files = csv_files(spark, os.path.join(scratch, "d"))
    cut = R.ranges(files.select("path", "length"), "UTF-8", size)
    largest = cut.agg(F.max(F.col("end") - F.col("start"))).first()[0]
    loads = [r[1] for r in cut.groupBy(F.spark_partition_id()).agg(F.sum(F.col("end") - F.col("start"))).collect()]
    assert sum(loads) == files.agg(F.sum("length")).first()[0] > 5 * 2_000
    assert max(loads) <= 2_000 + largest


def test_the_end_of_a_record_is_found_in_few_bytes():
    import io

    from berth.sources import records as R

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            self.taken += len(data)
            return data

    line = b'1,"a\nb",2\n'
    f = Counted(line * 400_000)
    assert R._cut(f, 16_387, False, len(line) * 400_000) % len(line) == 0
    assert f.taken < 1 << 14


def test_many_tables_in_the_same_jobs(spark, scratch):
    land, tables = os.path.join(scratch, "many"), os.path.join(scratch, "tables")
    for i in range(60):
        write(os.path.join(land, f"t{i}.csv"), f"a,b\n{i},x\n" if i % 3 else f"b,c d\ny,{i}.5\nz,\n")
    write(os.path.join(land, "none.csv"), "a,b\n")
    target = L.Target(schema="s", location=tables)
    for times, mode in ((1, "append"), (2, "append"), (1, "replace")):
        m = {r["table"]: r["n_rows"] for r in L.load_directory(spark, land, target, mode=mode).collect()}
        assert m == {**{f"t{i}": 1 if i % 3 else 2 for i in range(60)}, "none": 0}
        assert sorted(os.listdir(os.path.join(tables, "s"))) == sorted(m)
        for i in (0, 1, 2, 59):
            t = spark.read.parquet(os.path.join(tables, "s", f"t{i}"))
            assert t.count() == times * m[f"t{i}"] and t.columns == (["a", "b"] if i % 3 else ["b", "c_d"])
    assert dict(L.table_columns(spark, "t0", target)) == {"b": "STRING", "c_d": "DOUBLE"}
    assert dict(L.table_columns(spark, "none", target)) == {"a": "STRING", "b": "STRING"}
    with pytest.raises(Exception, match="exists"):
        L.load_directory(spark, land, target, mode="fail")


def test_the_best_date_format_of_a_column_is_taken(spark, scratch):
    land, target = os.path.join(scratch, "dates"), L.Target(schema="s", location=os.path.join(scratch, "t"))
    write(os.path.join(land, "d.csv"), "fecha,mes,dia\n31-01-2020,2020-02-01,31-01-2020\n01-02-2020 10:30,03/04/2021,x\nnada,04/04/2021,y\n")
    L.load_directory(spark, land, target, lenient=True)
    assert dict(L.table_columns(spark, "d", target)) == {"fecha": "TIMESTAMP", "mes": "TIMESTAMP", "dia": "STRING"}
    rows = spark.read.parquet(os.path.join(scratch, "t", "s", "d")).selectExpr("string(fecha)", "string(mes)").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("2020-01-31 00:00:00", None), ("2020-02-01 10:30:00", "2021-04-03 00:00:00"),
                                                        (None, "2021-04-04 00:00:00")], key=str)
    L.load_directory(spark, land, target, mode="replace", lenient=True, date_formats=("ISO",))
    assert dict(L.table_columns(spark, "d", target)) == {"fecha": "STRING", "mes": "TIMESTAMP", "dia": "STRING"}


def test_missing_folder(spark, scratch):
    with pytest.raises(FolderNotFound):
        inventory(spark, os.path.join(scratch, "nope"))
    assert jobs.reconcile_folder(spark, os.path.join(scratch, "nope"))[0] == 3
    assert jobs.summarize_downloads(spark, os.path.join(scratch, "nope")) == (3, None)
    assert jobs.count_files(spark, os.path.join(scratch, "nope"))[0] == 3


def test_standardize_dry_run_then_apply(spark, scratch):
    d = os.path.join(scratch, "dl")
    for n in ["x v2.csv", "x_20240101_000000.csv", "x.csv",
              "Concentración de ozono (O3) media mensual_20250914_132907.csv", "keep.txt"]:
        write(os.path.join(d, n), "a\n1\n")
    planned = {r["src"]: r["dst"] for r in jobs.standardize(spark, d, drop_timestamp=True, dry_run=True).collect()}
    assert sorted(os.listdir(d))[0] == "Concentración de ozono (O3) media mensual_20250914_132907.csv"
    jobs.standardize(spark, d, drop_timestamp=True)
    assert sorted(os.listdir(d)) == sorted(["keep.txt"] + list(planned.values()))
    assert sorted(planned.values()) == ["o3_med_mens.csv", "x.csv", "x_v2.csv", "x_v3.csv"]
    # Re-running may permute versions (they are parsed, not ranked), but it
    # only ever maps the folder's names onto themselves.
    from berth.operators import rename
    from berth.sources.files import csv_files
    again = rename.rename_plan(csv_files(spark, d, recursive=False), True).collect()
    assert sorted(r["dst"] for r in again) == sorted(r["src"] for r in again)


def test_rename_phases_survive_retries(scratch):
    """A task retried after a partial run (lost executor, speculation) must
    finish the renames without error and without losing a file."""
    from berth.plans.apply import _phase1, _phase2
    d = os.path.join(scratch, "retry")
    for n in ["a.csv", "b.csv"]:
        write(os.path.join(d, n), n)
    rows = [{"dir": "file:" + d, "src": "a.csv", "dst": "b.csv"},
            {"dir": "file:" + d, "src": "b.csv", "dst": "c.csv"}]
    _phase1("r1")(iter(rows[:1]))      # first attempt dies after one row
    _phase1("r1")(iter(rows))          # retry of the whole task
    _phase1("r1")(iter(rows))          # speculative duplicate
    _phase2("r1")(iter(rows[1:]))      # phase 2 partly done
    _phase2("r1")(iter(rows))          # retry
    assert sorted(os.listdir(d)) == ["b.csv", "c.csv"]
    assert open(os.path.join(d, "b.csv")).read() == "a.csv"
    assert open(os.path.join(d, "c.csv")).read() == "b.csv"


@pytest.mark.parametrize("stop", ["before the plan is whole", "in the moves", "before the mark", "in the second step", "before done"])
def test_a_stopped_run_is_finished_by_the_next(spark, scratch, stop):
    """The journal tells where a run stopped; the next run finishes it before it lists the folder."""
    from berth.plans import apply
    d = os.path.join(scratch, "stopped")
    for n in ["a.csv", "b.csv", "x.csv"]:
        write(os.path.join(d, n), n)
    rows = [{"dir": "file:" + d, "src": "a.csv", "dst": "b.csv"}, {"dir": "file:" + d, "src": "b.csv", "dst": "c.csv"}]
    run = apply.Journal(spark, "r" + str(abs(hash(scratch + stop))))
    run.plan(spark.createDataFrame(rows, apply._CHANGES))
    if stop == "before the plan is whole":
        fs, at = run._at("changes/_SUCCESS")
        fs.delete(at, False)
    else:
        apply._phase1(run.run_id)(iter(rows[:1] if stop == "in the moves" else rows))
    if stop in ("in the second step", "before done"):
        run.mark("moved")
        apply._phase2(run.run_id)(iter(rows[1:] if stop == "in the second step" else rows))
    done = apply.recover(spark)
    assert done == ([] if stop == "before the plan is whole" else [run.run_id])
    want = {n: n for n in ("a.csv", "b.csv")} if not done else {"b.csv": "a.csv", "c.csv": "b.csv"}
    assert {n: open(os.path.join(d, n)).read() for n in sorted(os.listdir(d))} == {**want, "x.csv": "x.csv"}
    assert apply.recover(spark) == [] and not run.reached("planned")


def test_files_that_come_meanwhile_are_not_overwritten(spark, scratch):
    from berth.plans import apply
    d = os.path.join(scratch, "meanwhile")
    write(os.path.join(d, "a.csv"), "old")
    rows = [{"dir": "file:" + d, "src": "a.csv", "dst": "b.csv"}]
    run = apply.Journal(spark, "meanwhile")
    run.plan(spark.createDataFrame(rows, apply._CHANGES))
    apply._phase1("meanwhile")(iter(rows))
    write(os.path.join(d, "a.csv"), "new")
    write(os.path.join(d, "b.csv"), "newer")
    with pytest.raises(Exception, match="b.csv"):
        apply.recover(spark)
    os.rename(os.path.join(d, "b.csv"), os.path.join(d, "kept.csv"))
    assert apply.recover(spark) == ["meanwhile"]
    assert {n: open(os.path.join(d, n)).read() for n in os.listdir(d)} == {"a.csv": "new", "b.csv": "old", "kept.csv": "newer"}


def test_reports_past_the_limit_are_folders_of_parts(spark, scratch):
    from berth.plans import reports
    path = os.path.join(scratch, "long.txt")
    lines = spark.range(300).selectExpr("0 section", "0 seq", "id ord", "'' key", "concat('l', id) line").repartition(4)
    for limit in (300, 299):
        reports.write_lines(lines, path, one_file_lines=limit)
        assert os.path.isfile(path) == (limit == 300)
        files = [path] if limit == 300 else sorted(os.path.join(path, n) for n in os.listdir(path) if n.startswith("part-"))
        assert [x for f in files for x in open(f).read().split()] == [f"l{i}" for i in range(300)]
    assert [n for n in os.listdir(scratch) if "long" in n and not n.startswith(".")] == ["long.txt"]


def test_command_line_exit_codes(spark, scratch, capsys):
    from berth.__main__ import main
    from berth.sources.catalog import WATER_TITLES
    d = os.path.join(scratch, "cli")
    write(os.path.join(d, "Temperatura media.csv"), "a\n1\n")
    assert main(["--missingfiles", "--dir", d]) == 2          # 86 titles missing
    report = open(os.path.join(d, "missingfiles.txt"), encoding="utf-8").read().split("\n")
    assert report[1] == f"Carpeta analizada: {d}" and "TOTAL FALTANTES: 86" in report and "Total extras: 0" in report
    assert main(["--missingfiles", "--dir", d]) == 2          # the report is replaced
    assert main(["--missingfiles", "--dir", os.path.join(scratch, "nope")]) == 3
    printed = capsys.readouterr().out.split("\n")
    assert report.count(" - " + WATER_TITLES[0]) == 1 and printed.count(" - " + WATER_TITLES[0]) == 2
    assert main(["--summary", "--configured", "agua=Nivel medio del mar", "--dir", d]) == 0
    summary = open(os.path.join(d, "scraping_report.txt"), encoding="utf-8").read().split("\n")
    assert summary[5:10] == ["Módulo: Módulo VBA- Estado - Aire", "Modo: AUTO-DESCUBRIMIENTO", "Archivos descargados: 1", "",
                             "  - Temperatura media.csv"]
    assert summary[11:14] == ["Módulo: Módulo VBA- Estado- Agua", "Modo: CONFIGURACIÓN PREDEFINIDA", "Archivos descargados: 0"]
    assert sorted(n for n in os.listdir(d) if not n.startswith(".")) == ["Temperatura media.csv", "missingfiles.txt", "scraping_report.txt"]
    assert main(["--countfiles", "--dir", os.path.join(scratch, "nope")]) == 3
    assert main(["--standardize", "--dry-run", "--dir", d]) == 0
    assert main(["--loaddb", "--dir", d, "--location", os.path.join(scratch, "t")]) == 0
    assert os.listdir(os.path.join(scratch, "t", "public")) == ["temperatura_media"]  # stem identifier


def test_listing_is_complete_and_literal(spark, scratch):
    d = os.path.join(scratch, "in[b]ox {x}")
    for n, text in [("Temperatura media.csv", ""), ("_u.csv", "a\n"), (".h", "x"), ("b.csv", "a\n1\n"), ("B.CSV", "a\n"),
                    ("deep/x.csv/inner.csv", "a\n"), ("noext", ""), ("deep/er/+%20.csv", "a\n")]:
        write(os.path.join(d, n), text)
    every = {(r["name"], r["length"]) for r in inventory(spark, d).collect()}
    assert every == {("Temperatura media.csv", 0), ("_u.csv", 2), (".h", 1), ("b.csv", 4), ("B.CSV", 2), ("inner.csv", 2),
                     ("noext", 0), ("+%20.csv", 2)}
    from berth.sources.files import csv_files
    assert {r["name"] for r in csv_files(spark, d, recursive=False).collect()} == {"Temperatura media.csv", "_u.csv", "b.csv"}
    row = next(r for r in inventory(spark, d).collect() if r["name"] == "b.csv")
    assert row["dir"] == "file:" + d and row["path"] == f"file:{d}/b.csv" and row["mtime"] is not None
    with pytest.raises(FolderNotFound):
        inventory(spark, os.path.join(d, "b.csv"))
    assert jobs.count_files(spark, os.path.join(d, "noext"))[0] == 3


def test_quotes_newlines_and_header_orders(spark, scratch):
    land = os.path.join(scratch, "land")
    write(os.path.join(land, "t", "a.csv"), 'id,t\n1,"a ""b"" c"\n2,"line1\nline2"\n3,"c:\\dir\\"\n4,z\n')
    write(os.path.join(land, "t", "b[1]+.csv"), 't,id\n"x,y",5\n')
    write(os.path.join(land, "t", "c.csv"), "id\n6\n")
    tgt = L.Target(schema="", location=os.path.join(scratch, "out"))
    m = L.load_directory(spark, land, tgt, mode="replace", table_from="dir")
    assert [(os.path.basename(r["path"]), r["table"], r["n_rows"]) for r in m.collect()] == [
        ("a.csv", "t", 4), ("b[1]+.csv", "t", 1), ("c.csv", "t", 1)]
    rows = spark.read.parquet(os.path.join(scratch, "out", "t")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'a "b" c'), (2, "line1\nline2"), (3, "c:\\dir\\"), (4, "z"), (5, "x,y"), (6, None)]
    assert L.load_totals(m).first()["n_rows"] == 6


@pytest.mark.parametrize("bad", [{"w.csv": "a,b\n1,2\n4,5,6\n"}, {"w.csv": "x,y\n1,2\n", "z.csv": "y,x,z\n1,2,3\n"}, {"w.csv": ""}])
def test_load_refuses_what_it_would_lose(spark, scratch, bad):
    for n, text in bad.items():
        write(os.path.join(scratch, "l", "t", n), text)
    with pytest.raises(L.LoadError, match="csv"):
        L.load_directory(spark, os.path.join(scratch, "l"), L.Target(location=os.path.join(scratch, "o")), table_from="dir")


def test_single_file_lenient_and_catalogue_table(spark, scratch):
    write(os.path.join(scratch, "x y.csv"), "fecha,half,none\n2024-01-02,1,n/a\nsoon,k,\n")
    for mode, n in (("replace", 2), ("append", 4)):
        m = L.load_csv(spark, os.path.join(scratch, "x y.csv"), "My Table", L.Target(schema="berth_t"), mode=mode, lenient=True)
        assert [tuple(r)[1:] for r in m.collect()] == [("my_table", 2)]
        assert spark.table("berth_t.my_table").count() == n
    assert dict(L.table_columns(spark, "my_table", L.Target(schema="berth_t"))) == {"fecha": "TIMESTAMP", "half": "LONG", "none": "LONG"}
    with pytest.raises(Exception):
        L.load_csv(spark, os.path.join(scratch, "x y.csv"), "My Table", L.Target(schema="berth_t"), mode="fail")
    with pytest.raises(FolderNotFound):
        L.load_csv(spark, os.path.join(scratch, "nope.csv"))
    spark.sql("DROP SCHEMA berth_t CASCADE")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from berth.session import NoSharedFolder, ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(NoSharedFolder):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d)))
