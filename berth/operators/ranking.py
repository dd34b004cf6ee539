"""Row numbers within groups that stay balanced when one group is huge.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task;
a group holding a third of the data would make that task a third of the job.
Here the rows are range-partitioned on (group, order) instead, so a large
group is split across many partitions by its order keys:

1. range partition + sort within partitions on (group, order);
2. each row's position inside its partition (from the partition-local,
   increasing row id);
3. per (group, partition): row count and first position — one row per
   group per partition it touches, so a hot group adds only as many rows as
   partitions;
4. a running sum of those counts over partitions gives each slice's offset;
5. join back on (group, partition): rank = offset + position - first + 1.

The order must be total within a group (tie-break on a unique column). The
numbered slices are checkpointed (reliable checkpoint in the shared folder)
before they are counted and joined back, so both sides see the same ids.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from berth.operators.sizing import join_small
from berth.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | row index


def rank_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 1-based row number of each row within its group by ``order``."""
    spark = df.sparkSession
    g = [F.col(c) for c in groups]
    # One range slice per core by default (cluster-wide), so the sort and the
    # checkpoint use every core whatever the byte size of the rows.
    n = num_partitions or spark.sparkContext.defaultParallelism
    ranged = df.repartitionByRange(n, *g, *order).sortWithinPartitions(*g, *order)
    mid = F.monotonically_increasing_id()
    r = ranged.withColumn("__pid", F.shiftright(mid, 33)).withColumn("__pos", mid.bitwiseAND(F.lit(_LOW_BITS)))
    # Partition ids and positions must be the same in both uses below; a
    # recomputation (or a differently coalesced read) could change them, so
    # they are written once to the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    r = r.checkpoint(eager=True)
    slices = (r.groupBy(*groups, "__pid")
              .agg(F.count(F.lit(1)).alias("__cnt"), F.min("__pos").alias("__first")))
    w = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0))).drop("__cnt")
    j = join_small(r, slices, [*groups, "__pid"])
    return j.withColumn(out, (F.col("__off") + F.col("__pos") - F.col("__first") + 1).cast("int")) \
        .drop("__pid", "__pos", "__first", "__off")
