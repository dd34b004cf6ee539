"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.session import delete_folder, ensure_checkpoint_dir

#: Characters that separate words in every contract of this package.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where the folders of stashed tables are noted, inside :func:`collected_scratch`.
_collected: list[str] | None = None


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the cluster's shared folder and read it
    back: later steps then never recompute what led to it, and survive a lost
    executor. It stays until :func:`drop` or :func:`drop_scratch` remove it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _collected is not None:
        _collected.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove tables of :func:`stash` that nothing unwritten reads any more."""
    for t in tables:
        delete_folder(t.sparkSession, t.stashed_at)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files that only written tables needed: it does so for
    what the driver's collector has found unused, and that may not run for long."""
    spark._jvm.System.gc()


@contextmanager
def collected_scratch(folders: list[str]) -> Iterator[None]:
    """Notes in ``folders`` what :func:`stash` writes inside the block."""
    global _collected
    before, _collected = _collected, folders
    try:
        yield
    finally:
        _collected = before


def drop_scratch(spark: SparkSession, folders: list[str]) -> None:
    """Remove the folders of collected tables."""
    while folders:
        delete_folder(spark, folders.pop())


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges(a, b)`` (longs).

    Returns ``(id, component)`` for every node but the smallest of each
    component; ``component`` is that smallest node. Alternating large-star and
    small-star rounds: each is two aggregations with map-side minima and an
    equi-join whose hot keys adaptive execution may split, so no component is
    ever gathered. Each round is written to the shared folder.
    """
    live = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    live = stash(live.where("u <> v").distinct())
    seen = None
    while True:
        state = live.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or tuple(state) == seen:
            return live.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = tuple(state)
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        live = stash(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())


class Forest:
    """Union-find over 0..n-1 inside one task; the smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        return True

    def join_all(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            self.join(x, y)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def chunks(total: int, step: int) -> Iterator[slice]:
    for at in range(0, total, step):
        yield slice(at, min(total, at + step))
