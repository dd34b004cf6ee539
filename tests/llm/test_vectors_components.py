"""Exact top-k and connected components against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from berth.llm import kdtree
from berth.llm.common import components

SCHEMA = "vec_id long, embedding array<float>, rank int, id string"


def brute_top_k(rows, every, k):
    valid = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            valid.setdefault(i, set()).add(tuple(math.floor(64 * float(np.float32(x))) for x in v))
    out = []
    for q, mine in valid.items():
        if q % every:
            continue
        scores = [(-max(sum(a * b for a, b in zip(x, y)) for x in mine for y in own), c) for c, own in valid.items() if c != q]
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard,block,leaf", [(16384, 4096, 128), (40, 7, 4)])
def test_top_k_equals_brute_force(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "QUERY_ROWS", block)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", leaf)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-0.5, 0.5) for _ in range(8)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 380)]  # ties
    rows += [(400, None), (401, [0.1, None]), (402, [float("nan")] * 8), (403, [float("inf")] + [0.0] * 7), (None, rows[0][1]),
             (404, [0.5] * 3), (405, []), (7, rows[7][1]), (11, [0.25] * 8), (20, [0.4] * 8), (406, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(3)
    got = kdtree.top_k(kdtree.integer_vectors(df, "vec_id", "embedding"), F.col("id") % 20 == 0, k=20)
    assert sorted(tuple(r) for r in got.collect()) == brute_top_k(rows, 20, 20)


def test_few_candidates_large_values_and_empty(spark):
    rows = [(0, [1e8, 1.0]), (20, [1e6, -1.0]), (1, [3.0, 2.0])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    vectors = kdtree.integer_vectors(df, "vec_id", "embedding")
    got = kdtree.top_k(vectors, F.col("id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    none = kdtree.integer_vectors(df.limit(0), "vec_id", "embedding")
    assert kdtree.top_k(none, F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)]
    edges += [(900, i) for i in range(901, 950)] + edges[:5] + [(3, 3)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
