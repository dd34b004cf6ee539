"""Broadcast only what is measured to be small.

A side derived from the data (per-group slices, distinct names) has no size
bound known in advance. Two ways are used:

* when the side is cheap to recompute (e.g. an aggregate of a checkpointed
  frame), it is counted up to ``max_rows`` first and broadcast only under
  that bound (:func:`join_small`);
* beyond that bound the join is left to AQE: a sort-merge join whose skewed
  partitions it splits.

:func:`map_distinct` counts the mapping of the distinct values first, so the rows
that carry them are not shuffled while those are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.session import ensure_checkpoint_dir

BROADCAST_MAX_ROWS = 500_000


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` with a cheap-to-recompute ``small`` side, broadcasting it
    only when counted under ``max_rows``."""
    return big.join(F.broadcast(small) if fits(small, max_rows) else small, on, how)


def map_distinct(df: DataFrame, src: str, mapper, key: str = "__map_key") -> DataFrame:
    """Apply ``mapper`` (DataFrame → DataFrame adding columns, keyed by
    column ``key``) to the distinct values of ``src`` only — a partial
    aggregate before its shuffle — and join the new columns back NULL-safely.
    The mapping is made once and checkpointed, then counted, and broadcast
    under the bound."""
    ensure_checkpoint_dir(df.sparkSession)
    mapped = mapper(df.select(F.col(src).alias(key)).distinct()).checkpoint(eager=True)
    side = F.broadcast(mapped) if fits(mapped) else mapped
    return df.join(side, df[src].eqNullSafe(mapped[key]), "left").drop(key)
