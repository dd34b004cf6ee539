"""Exact top-k inner product with a KD-tree in each shard.

Candidates are dealt by id into shards of about ``SHARD_ROWS`` vectors, queries
into blocks of about ``QUERY_ROWS``; a task holds one shard and one block. It
builds the shard's KD-tree (median splits of the widest dimension, tight boxes)
and visits leaves best first: a box's largest inner product with a query bounds
all vectors in it, leaves are taken in falling order of that bound (a parent's
bound is never below its children's, so this is the order in which a best-first
descent reaches them), and a query stops when the bound falls below its k-th
score. Each block first searches one home shard; its k-th scores then go along
to all other shards as a floor.

Scores are exact integers (in double arithmetic while they stay below 2^53, else
in Python integers, limited to the range of a long); ties go to the smaller id.

Defined cases: vectors that are null or hold null or non-finite components take
no part; shorter vectors count as padded with zeros; exact repeats of a row count
once; if an id has several vectors, two ids score the best of their pairs; a
null id takes no part; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from berth.llm.common import stash

SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
LEAF_ROWS = 128
_LOW = np.iinfo(np.int64).min


def _scaled(scale: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, vectors = [], []
            for i, v in zip(part.column("id").to_pylist(), part.column("vector")):
                if i is None or not v.is_valid:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if v.values.null_count or not np.isfinite(x).all():
                    continue
                ids.append(i)
                vectors.append(np.floor(x * scale).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], ["id", "vector"])
    return run


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: float = 64.0) -> DataFrame:
    """``(id, vector)``: ``floor(scale * x)`` as little-endian doubles, of the valid rows."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    return rows.mapInArrow(_scaled(scale), "id long, vector binary").distinct()


def _matrix(rows: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, b in enumerate(rows):
        v = np.frombuffer(b, np.float64)
        out[i, :len(v)] = v
    return out


def leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row indices of the leaves of a KD-tree: median splits of the widest dimension."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(points[rows], axis=0) if len(rows) > size and points.shape[1] else np.zeros(1)
        if len(rows) <= size or not spread.max() > 0:
            out += np.array_split(rows, max(1, -(-len(rows) // size)))
            continue
        half = len(rows) // 2
        order = np.argpartition(points[rows, int(spread.argmax())], half)
        todo += [rows[order[half:]], rows[order[:half]]]
    return out


def _products(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (q @ v.T).astype(np.int64)
    ints = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    limit = 2**63 - 1
    return np.array([[max(-limit, min(limit, int(np.dot(a, b)))) for b in ints(v)] for a in ints(q)], np.int64).reshape(len(q), len(v))


def search(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's best k candidates with another
    id and a score of at least ``floor``; ties to the smaller id."""
    order = np.argsort(v_ids, kind="stable")
    v, v_ids = v[order], v_ids[order]
    exact = max(v.shape[1], 1) * max(np.abs(q).max(initial=0), 1) * max(np.abs(v).max(initial=0), 1) < 2**53
    parts = leaves(v, LEAF_ROWS)
    lo, hi = np.stack([v[p].min(0) for p in parts]), np.stack([v[p].max(0) for p in parts])
    bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    if not exact:
        bound = np.nextafter(bound * (1 + np.sign(bound) * 1e-12), np.inf)
    visit = np.argsort(-bound, axis=1, kind="stable")
    score = np.full((len(q), k), _LOW)
    row = np.full((len(q), k), len(v))
    alive = np.arange(len(q))
    for step in range(len(parts)):
        at = visit[alive, step]
        worst = np.maximum(score[alive, k - 1], floor[alive])
        keep = bound[alive, at] >= worst
        alive, at = alive[keep], at[keep]
        if not len(alive):
            break
        for leaf in np.unique(at):
            who, rows = alive[at == leaf], parts[leaf]
            s = _products(q[who], v[rows], exact)
            s[q_ids[who][:, None] == v_ids[rows]] = _LOW
            s[s < floor[who][:, None]] = _LOW
            better = (s >= score[who, k - 1][:, None]) & (s != _LOW)
            some = better.any(1)
            if not some.any():
                continue
            who, s = who[some], s[some]
            all_s = np.concatenate([score[who], s], 1)
            all_r = np.concatenate([row[who], np.broadcast_to(rows, s.shape)], 1)
            best = np.lexsort((all_r, -np.maximum(all_s, _LOW + 1)), axis=1)[:, :k]
            score[who] = np.take_along_axis(all_s, best, 1)
            row[who] = np.take_along_axis(all_r, best, 1)
    i, j = np.nonzero(score != _LOW)
    return i, order[row[i, j]], score[i, j]


_FOUND = "query_id long, vec_id long, score long"


def _task(k: int):
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        queries = queries.rename(columns={"query": "id", "point": "vector"})
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if queries.empty or shard.empty:
            return none
        dim = max(queries["vector"].map(len).max(), shard["vector"].map(len).max()) // 8
        q, v = _matrix(queries["vector"], dim), _matrix(shard["vector"], dim)
        q_ids, v_ids = queries["id"].to_numpy(np.int64), shard["id"].to_numpy(np.int64)
        most = k * int(np.unique(v_ids, return_counts=True)[1].max())  # an id with several vectors
        i, j, s = search(q, q_ids, queries["floor"].to_numpy(np.int64), v, v_ids, most)
        return pd.DataFrame({"query_id": q_ids[i], "vec_id": v_ids[j], "score": s})
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` over ``vectors(id, vector)``; ``is_query`` marks
    the query rows by ``id``."""
    vectors = stash(vectors)
    n, n_queries = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-(n_queries or 0) // QUERY_ROWS))
    cands = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    queries = vectors.where(is_query).select(F.col("id").alias("query"), F.col("vector").alias("point"),
                                             F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    all_blocks = F.sequence(F.lit(0), F.lit(blocks - 1))
    home = lambda b: F.pmod(b, F.lit(shards))

    def meet(q: DataFrame, c: DataFrame) -> DataFrame:
        return q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard")).applyInPandas(_task(k), _FOUND)

    at_home = cands.withColumn("block", F.explode(F.filter(all_blocks, lambda b: home(b) == F.col("shard"))))
    first = stash(meet(queries.withColumn("shard", home(F.col("block")))
                       .withColumn("floor", F.lit(_LOW + 1).cast("long")), at_home))
    floors = (_best(first, k).groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
              .where(F.col("n") >= k).select(F.col("query_id").alias("query"), F.col("kth").alias("floor")))
    away = cands.withColumn("block", F.explode(F.filter(all_blocks, lambda b: home(b) != F.col("shard"))))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home(F.col("block")))
    asked = queries.join(floors, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(_LOW + 1).cast("long")))
    rest = meet(asked.withColumn("shard", F.explode(others)), away)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
with v as (
  select distinct vec_id as id, list_transform(embedding, lambda x: floor(64.0 * x::double)) as vec
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select q.id as query_id, c.id as vec_id, cast(list_inner_product(q.vec, c.vec) as bigint) as score
  from v q join v c on c.id <> q.id where q.id % 20 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from p qualify rank <= 20
"""
