"""Mixing sources to target weights by Pareto order sampling.

Sources in code-point order (null last) weigh ``weights`` in turn and share
``share`` times all words; no source gets more than ``most`` times its own
words, the excess goes to the others by weight until none is above. A document
is taken ``floor(target / source words)`` times for certain; what is left of the
target is a fixed-size sample: documents are ranked by their random odds divided
by their inclusion odds (Pareto order), and taken in that order while the middle
of a document lies within the rest.

Nothing is gathered by source. Word counts are reduced per source with map-side
sums; the running sums of the ranking are kept in buckets of the draw (uniform by
hash, about ``BUCKET_ROWS`` documents each), so a source with a third of all rows
is spread evenly; the decision reduces to one cut per source.

Defined cases: null text has size 0; a null source is a source of its own, last;
draws depend on doc_id alone, so reruns agree and rows that repeat a doc_id are
taken or left together; sources without words have target 0; an empty table
gives an empty result; other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from berth.llm.common import SPACE, stash, unused

#: Documents of one source whose ranking one window group holds, on average.
BUCKET_ROWS = 5000


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, f"[{SPACE}]+"))).cast("long")


def draw(doc_id: Column) -> Column:
    """A reproducible uniform number in (0, 1) for each document."""
    digits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(2**52))


def pareto_key(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds."""
    return (u / (F.lit(1.0) - u)) / (p / (F.lit(1.0) - p))


def ordinals(df: DataFrame, column: str) -> DataFrame:
    """``df`` with its 0-based rank ``ordinal`` by ``column`` (nulls last), without one
    task seeing all rows: ranks inside the range partitions of a sort, plus offsets."""
    placed = stash(df.orderBy(F.col(column).asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before = placed.groupBy("part").count()
    before = before.withColumn("offset", F.sum("count").over(Window.orderBy("part")) - F.col("count"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last()))
    return (placed.withColumn("inside", inside).join(before.select("part", "offset"), "part")
            .withColumn("ordinal", F.col("inside") + F.col("offset") - 1).drop("part", "inside", "offset"))


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """``(source, source_size, n_docs, target, whole, rest)`` for ``sizes(source, size)``."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    cycle = F.array(*(F.lit(w) for w in weights))
    sources = stash(ordinals(sums, "source").select(
        "source", "source_size", "n_docs",
        F.element_at(cycle, (F.col("ordinal") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("top")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while True:
        full = F.lit(False) if capped is None else F.lit(level) * F.col("weight") > F.col("top")
        n, held, weight = sources.agg(F.count_if(full), F.sum(F.when(full, F.col("top")).otherwise(0)),
                                      F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if n == capped or not weight:
            break
        level, capped = (share * total - held) / weight, n
    target = F.least(F.col("top").cast("double"), F.lit(level) * F.col("weight"))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return stash(sources.select("source", "source_size", "n_docs", target.alias("target"), whole.alias("whole"),
                                (target - whole * F.col("source_size")).alias("rest")))


def _odds(df: DataFrame) -> DataFrame:
    p = F.col("rest") / F.col("source_size")
    return df.withColumn("u", draw(F.col("doc_id"))).withColumn(
        "key", F.when(F.col("rest") > 0, pareto_key(F.col("u"), p)))


def plan(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, whole, copies, key)`` per document."""
    sizes = stash(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    goal = targets(sizes, **options).withColumnRenamed("source", "of")
    ranked = _odds(sizes.join(goal, F.col("source").eqNullSafe(F.col("of")))).drop("of")
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    ranked = stash(ranked.withColumn("bucket", F.floor(F.col("u") * buckets)))
    sums = ranked.where("key is not null").groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("bucket").alias("b"),
                       F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    near = F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("b"))
    upto = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("key", "doc_id")) + F.col("before")
    extra = F.col("key").isNotNull() & (2 * upto - F.col("size") <= 2 * F.col("rest"))
    return ranked.join(sums, near, "left").withColumn("extra", extra).select(
        "doc_id", "source", "size", "source_size", "target", "whole", "rest", "key",
        (F.col("whole") + F.coalesce(F.col("extra"), F.lit(False)).cast("long")).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as it is taken, columns unchanged.

    Only the per-source cut travels: a document is taken once more if its place in
    the Pareto order is not behind the last one taken of its source.
    """
    picked = stash(plan(docs.select("doc_id", "source", "text"), **options))
    name = {x: unused(docs, f"__{x}") for x in ("whole", "rest", "size", "cut", "source", "copies", "copy")}
    own = {x: F.col(n) for x, n in name.items()}
    cut = picked.groupBy("source").agg(
        F.first("whole").alias(name["whole"]), F.first("rest").alias(name["rest"]), F.first("source_size").alias(name["size"]),
        F.max(F.when(F.col("copies") > F.col("whole"), F.struct("key", "doc_id"))).alias(name["cut"])).withColumnRenamed("source", name["source"])
    joined = docs.join(cut, docs["source"].eqNullSafe(own["source"]))
    p = own["rest"] / own["size"]
    key = F.when(own["rest"] > 0, pareto_key(draw(docs["doc_id"]), p))
    inside = F.struct(key.alias("key"), docs["doc_id"].alias("doc_id")) <= own["cut"]
    copies = own["whole"] + F.coalesce(key.isNotNull() & inside, F.lit(False)).cast("long")
    return (joined.withColumn(name["copies"], copies).where(own["copies"] > 0)
            .withColumn(name["copy"], F.explode(F.sequence(F.lit(1), own["copies"].cast("int"))))
            .select(*(docs[c] for c in docs.columns)))


ORACLE_SQL = """
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         (('0x' || substr(md5(cast(doc_id as varchar)), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as o
  from d group by source),
w as (select source, source_size, source_size * 2 as top, [3, 1, 2][cast(o % 3 as int) + 1] as weight from s),
r as (select *, row_number() over (order by top::double / weight, source) as pos from w),
c as (
  select a.pos, (select 1.5 * sum(source_size) from w) as total,
         coalesce((select sum(top) from r b where b.pos < a.pos), 0) as held,
         (select sum(weight) from r b where b.pos >= a.pos) as rest_weight, a.top, a.weight
  from r a),
l as (select (total - held)::double / rest_weight::double as level from c
      where ((total - held)::double / rest_weight::double) * weight <= top order by pos limit 1),
t as (
  select source, source_size, least(top::double, coalesce((select level from l), 1e300) * weight) as target from w),
g as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t),
h as (select *, target - whole * source_size as rest from g),
k as (
  select d.*, h.source_size, h.target, h.whole, h.rest,
         case when rest > 0 then (u / (1.0::double - u)) / ((rest / h.source_size) / (1.0::double - rest / h.source_size)) end as key
  from d join h on d.source is not distinct from h.source),
z as (
  select *, case when key is not null then sum(size) over (partition by source, key is null order by key, doc_id) end as upto from k)
select doc_id, size, source_size, target,
       cast((whole + case when key is not null and 2 * upto - size <= 2 * rest then 1 else 0 end) * size as bigint) as taken
from z
"""
