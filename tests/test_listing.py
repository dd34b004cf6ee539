"""The landing_files source: what is listed, how it is split, and what is pushed into the walk."""

import os

import pytest
from pyspark.sql import functions as F

from berth.sources import listing as S
from berth.sources.files import FolderNotFound, csv_files, inventory

FILES = {"top.csv": 3, "top.CSV": 1, "a/.hid.csv": 0, "a/[b]/x.csv": 5, "a/[b]/c d/_y.csv": 2, "e/f/g/z.txt": 7,
         "e/f/g/h%20i+j.csv": 1, "é/ñ*{1}.csv": 4}


@pytest.fixture()
def tree(scratch):
    for rel, size in FILES.items():
        os.makedirs(os.path.dirname(os.path.join(scratch, rel)), exist_ok=True)
        with open(os.path.join(scratch, rel), "wb") as f:
            f.write(b"x" * size)
    return scratch


def rels(df, root):
    return {r.path.removeprefix(S.absolute(root) + "/"): r.length for r in df.collect()}


@pytest.mark.parametrize("partitions", [1, 2, 3, 256])
def test_every_file_once_whatever_the_split(spark, tree, partitions):
    df = S.listing(spark, tree, partitions=partitions)
    rows = df.collect()
    assert len(rows) == len(FILES) and rels(df, tree) == FILES
    assert all(r.path == f"{r.dir}/{r.name}" and r.mtime is not None for r in rows)
    split = S.LandingReader({"path": tree, "partitions": partitions}).partitions()
    assert len(split) <= partitions and sum(len(b.folders) for b in split) >= min(partitions, 7)


def test_globs_and_levels(spark, tree):
    assert set(rels(csv_files(spark, tree), tree)) == {f for f in FILES if f.endswith(".csv")}
    assert set(rels(inventory(spark, tree, recursive=False), tree)) == {"top.csv", "top.CSV"}
    assert set(rels(S.listing(spark, tree, glob="?[!o]*.csv"), tree)) == {f for f in FILES if f.endswith(".csv")} - {"top.csv", "a/[b]/x.csv"}


def test_filters_reach_the_walk(spark, tree):
    root = S.absolute(tree)
    files = S.listing(spark, tree)
    cases = [(F.col("name").endswith(".csv") & F.col("name").startswith("x"), {"a/[b]/x.csv"}),
             (F.col("dir") == f"{root}/a/[b]", {"a/[b]/x.csv"}),
             (F.col("dir").startswith(f"{root}/e/"), {"e/f/g/z.txt", "e/f/g/h%20i+j.csv"}),
             (F.col("name").isin("z.txt", "top.CSV"), {"e/f/g/z.txt", "top.CSV"}),
             (F.col("name").contains("id") & (F.col("length") < 1), {"a/.hid.csv"})]
    for condition, want in cases:
        assert set(rels(files.where(condition), tree)) == want
    plan = files.where(cases[0][0])._jdf.queryExecution().executedPlan().toString()
    assert "EndsWith" not in plan and "StartsWith" not in plan  # applied by the source


def test_branches_without_a_wanted_folder_stay_closed(tree):
    root = S.absolute(tree)
    reader = S.LandingReader({"path": tree})
    reader.wanted = [S.Wanted("dir", "in", (f"{root}/a/[b]",))]
    assert {f for b in reader.partitions() for f, _ in b.folders} == {root, f"{root}/a", f"{root}/a/[b]"}


def test_a_listing_is_a_snapshot(spark, tree):
    files = inventory(spark, tree)
    os.rename(os.path.join(tree, "top.csv"), os.path.join(tree, "moved.csv"))
    assert rels(files, tree) == FILES
    with pytest.raises(FolderNotFound):
        inventory(spark, os.path.join(tree, "top.CSV"))
