import random
import re

from pyspark.sql import functions as F

from berth.operators import rename as RN
from berth.plans import queries as Q

SCHEMA = "file_id long, dir string, name string, mtime timestamp"


def plan(spark, rows, drop):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["src"]: r["dst"] for r in RN.rename_plan(df, drop).collect()}


def test_golden_drop_timestamp(spark):
    rows = [(1, "d", "x v2.csv", None), (2, "d", "x_20240101_000000.csv", None), (3, "d", "x.csv", None)]
    assert plan(spark, rows, True) == {"x v2.csv": "x_v2.csv", "x_20240101_000000.csv": "x.csv", "x.csv": "x_v3.csv"}
    keep = plan(spark, rows, False)
    assert keep == {"x v2.csv": "x_v2.csv", "x_20240101_000000.csv": "x_20240101_000000.csv", "x.csv": "x.csv"}
    changed = RN.rename_changes(RN.rename_plan(spark.createDataFrame(rows, SCHEMA), False))
    assert changed.count() == 1


def test_recency_order_and_tie_breaks(spark):
    from datetime import datetime
    rows = [(1, "d", "a_20240101_000000.csv", datetime(2024, 1, 1)),
            (2, "d", "a_20240301_000000.csv", datetime(2020, 1, 1)),
            (3, "d", "A.csv", datetime(2025, 1, 1)),
            (4, "d", "a.csv", datetime(2025, 1, 1)),
            (5, "e", "a.csv", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["dir"], r["src"]): r["dst"] for r in RN.rename_plan(df, True).collect()}
    # newest timestamp first; no timestamp → by mtime, then lower-cased name, then name
    assert got[("d", "a_20240301_000000.csv")] == "a.csv"
    assert got[("d", "a_20240101_000000.csv")] == "a_v2.csv"
    assert (got[("d", "A.csv")], got[("d", "a.csv")]) == ("a_v3.csv", "a_v4.csv")
    assert got[("e", "a.csv")] == "a.csv"


def _sequential(entries):
    """Independent sequential statement of the collision rule."""
    taken, out = set(), {}
    for key, d in entries:
        if d in taken:
            base = re.sub(r"_v\d+$", "", d, flags=re.IGNORECASE)
            n = 2
            while f"{base}_v{n}" in taken:
                n += 1
            d = f"{base}_v{n}"
        taken.add(d)
        out[key] = d
    return out


def test_collisions_on_groups_match_the_sequential_rule_on_files(spark):
    rng = random.Random(7)
    rows, expected = [], {}
    fid = 0
    for fam in range(60):
        keys = [f"f{fam}{t}" for t in ("", "_v2", "_v3", "_V2", "_v02", "_v5", "_v2_v2", "_v9", "_v1")]
        rng.shuffle(keys)
        entries = []
        for order, key in enumerate(keys[:rng.randint(1, 9)]):
            for rank in range(1, rng.choice([1, 1, 2, 3, 12]) + 1):
                entries.append((fid, key if rank == 1 else f"{key}_v{rank}"))
                rows.append((fid, "dir", f"{fam:03d}-{order:03d}-{rank:03d}", key, rank))
                fid += 1
        expected.update(_sequential(entries))
    planned = spark.createDataFrame(rows, "file_id long, dir string, name string, gkey string, rank int")
    got = {r["file_id"]: r["final_stem"] for r in RN.resolve_collisions(planned).collect()}
    assert got == expected


def test_a_hot_group_stays_spread(spark):
    """One folder and stem with most files: no exchange gathers its rows in one partition."""
    n = 60_000
    files = spark.range(n).select(
        F.col("id").alias("file_id"), F.lit("d").alias("dir"),
        F.concat(F.lit("x_"), F.lpad(F.col("id").cast("string"), 8, "2"), F.lit("_000000.csv")).alias("name"),
        F.lit(None).cast("timestamp").alias("mtime"))
    plan_ = RN.rename_plan(files, True)
    sizes = [r["count"] for r in plan_.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == n == plan_.select("dst").distinct().count()
    assert len(sizes) > 1 and max(sizes) <= 2 * n / len(sizes)


def test_registered_collision_query_gives_unique_destinations(spark):
    from tests.conftest import SF_SMALL
    p = Q.rename_collisions(spark, SF_SMALL)
    n = p.count()
    assert n == p.select("dir", "dst").distinct().count()
    assert n == Q.fixtures.landing_with_copies(spark, SF_SMALL).count()


def test_rank_within_matches_window_on_a_hot_group(spark):
    from pyspark.sql import Window

    from berth.operators.ranking import rank_within
    rows = [("hot", i % 97, i) for i in range(3000)] + [("g%d" % (i % 7), i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, a int, b int")
    order = [F.desc("a"), F.asc("b")]
    got = {(r["g"], r["b"]): r["rank"] for r in rank_within(df, ["g"], order, num_partitions=8).collect()}
    ref = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    want = {(r["g"], r["b"]): r["rank"] for r in ref.collect()}
    assert got == want
