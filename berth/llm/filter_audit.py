"""Audit of how filters interact: what each order of them removes, and at whose cost.

Every filter leaves one table of the ids that fail it. What a filter does behind
others depends on the set of those before it alone, so the prefixes of all orders
are the subsets of the filters:

1. **survivors** of a prefix: ids of failing documents, left anti the tables of the
   prefix (documents that fail nothing survive everything and are only counted);
2. **removed** by a filter behind a prefix: its table, left semi the survivors;
3. **redundant** there: its table, left anti the survivors;
4. label losses are sums over the removed; what fails one filter only is what that
   filter removes behind all others; Shapley values weigh the removals of each prefix
   by the number of orders that begin with it.

All prefixes go through the three joins at once, keyed by (id, prefix), which no value
of the data can make uneven; counts per part are reduced before they are exchanged.
The ids are row numbers given when the facts are written, so nulls and repeats in
``doc_id`` need no care.

Defined cases: a null text is empty; a null part is the empty string; rows that repeat
a doc_id are documents of their own, equal ids count as neither smaller; a null doc_id
is neither smaller nor greater than another and has no labels; where labels repeat a
doc_id, one mark of 1 suffices; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.llm.common import SPACE, stash


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions on one text (not null): few words, few distinct words, many
    capitals, symbols."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failing_ids(docs: DataFrame, labels: DataFrame, rules: Mapping[str, Column], copies: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(facts, tables): one row of facts for each document, ``uid, part, good, toxic``, and the
    table of failing ``uid`` for each rule on ``text`` and, under the name ``copies``, for
    documents whose text a smaller doc_id has as well."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    told = stash(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "part",
                             F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                             *(rule.alias(f"fails_{name}") for name, rule in rules.items())))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")))
    facts = stash(told.select("uid", "doc_id", "part").join(marks, "doc_id", "left")
                  .select("uid", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    tables = {name: stash(told.where(f"fails_{name}").select("uid")) for name in rules}
    # written first: a join of two exchanges is one whose hot keys adaptive execution may split
    first = stash(told.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
                  .select("digest", "first"))
    tables[copies] = stash(told.join(first, "digest").where("doc_id > first").select("uid"))
    return facts, tables


def audit(facts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley)`` for every order of the filters, from ``facts`` and one table of failing ids each."""
    names = sorted(tables)
    bit = {name: 1 << i for i, name in enumerate(names)}
    every = (1 << len(names)) - 1
    fails = reduce(DataFrame.unionByName, (tables[n].select("uid", F.lit(bit[n]).alias("filter")) for n in names))
    touched = facts.join(fails.select("uid"), "uid", "left_semi")
    prefixes = F.array(*(F.lit(s) for s in range(every + 1)))
    behind = F.explode(F.filter(prefixes, lambda s: s.bitwiseAND(F.col("filter")) == 0))
    under = F.explode(F.filter(prefixes, lambda s: s.bitwiseAND(F.col("filter")) != 0))

    alive = stash(touched.select("uid", "part", F.explode(prefixes).alias("prefix"))
                  .join(fails.select("uid", under.alias("prefix")), ["uid", "prefix"], "left_anti"))
    later = stash(fails.join(facts, "uid")).select("*", behind.alias("prefix"))
    ids = alive.select("uid", "prefix")
    removed = (later.join(ids, ["uid", "prefix"], "left_semi").groupBy("part", "prefix", "filter")
               .agg(F.count("*").alias("removed"), F.lit(0).cast("long").alias("redundant"),
                    F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")))
    redundant = (later.join(ids, ["uid", "prefix"], "left_anti").groupBy("part", "prefix", "filter")
                 .agg(F.lit(0).cast("long").alias("removed"), F.count("*").alias("redundant"),
                      F.lit(0).cast("long").alias("good_lost"), F.lit(0).cast("long").alias("toxic_lost")))
    counts = ("removed", "redundant", "good_lost", "toxic_lost")
    cells = stash(removed.unionByName(redundant).groupBy("part", "prefix", "filter").agg(*(F.sum(c).alias(c) for c in counts)))

    survivors = stash(alive.groupBy("part", "prefix").agg(F.count("*").alias("alive")))
    parts = facts.groupBy("part").agg(F.count("*").alias("docs"))
    failing = touched.groupBy("part").agg(F.count("*").alias("failing"))
    parts = parts.join(failing, "part", "left").select("part", (F.col("docs") - F.coalesce("failing", F.lit(0))).alias("clean"))
    before = F.bit_count("prefix")
    orders = reduce(lambda c, k: c.when(before == k, factorial(k) * factorial(len(names) - 1 - k)), range(1, len(names)),
                    F.when(before == 0, factorial(len(names) - 1)))
    alone = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == every - F.col("filter"), F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(orders * F.col("removed")).alias("shapley"))

    steps = [(sum(bit[x] for x in order[:k]), bit[order[k]], "".join(order), k + 1) for order in permutations(names) for k in range(len(names))]
    grid = F.explode(F.array(*(F.struct(F.lit(s).alias("prefix"), F.lit(f).alias("filter"), F.lit(o).alias("filter_order"), F.lit(k).alias("step"))
                               for s, f, o, k in steps)))
    lost = parts.select("part", "clean", grid.alias("at")).select("part", "clean", "at.*")
    upto = survivors.select("part", F.col("prefix").alias("upto"), "alive")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (lost.withColumn("upto", F.col("prefix").bitwiseOR(F.col("filter")))
            .join(upto, ["part", "upto"], "left").join(cells, ["part", "prefix", "filter"], "left").join(alone, ["part", "filter"], "left")
            .select("part", "filter_order", "step", (F.col("clean") + F.coalesce("alive", F.lit(0))).alias("kept"),
                    *(zero(c) for c in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))))


ORACLE_SQL = """
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
f as (
  select d.doc_id, part,
         case when len(w) < 200 then 1 else 0 end
         + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
         + case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) then 4 else 0 end
         + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
         + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as m
  from d),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
      from labels group by doc_id),
c as (select part, m, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
      from f left join l using (doc_id) group by part, m),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as name, unnest([1, 2, 4, 8, 16]) as bit),
o as (
  select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from x a, x b, x c, x d, x e where (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s as (
  select filter_order, step, bits[step] as bit, cast(list_sum(bits[1:step]) - bits[step] as int) as prefix
  from o, (select unnest([1, 2, 3, 4, 5]) as step)),
p as (select distinct part from c),
z as (
  select p.part, filter_order, step, s.bit,
         sum(case when m & (prefix | s.bit) = 0 then n else 0 end) as kept,
         sum(case when m & prefix = 0 and m & s.bit <> 0 then n else 0 end) as removed,
         sum(case when m & prefix <> 0 and m & s.bit <> 0 then n else 0 end) as redundant,
         sum(case when m = s.bit then n else 0 end) as unique_fails,
         sum(case when m & prefix = 0 and m & s.bit <> 0 then good else 0 end) as good_lost,
         sum(case when m & prefix = 0 and m & s.bit <> 0 then toxic else 0 end) as toxic_lost
  from p join c using (part), s group by p.part, filter_order, step, s.bit)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from z
"""
