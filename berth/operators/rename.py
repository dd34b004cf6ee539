"""Plan stable, versioned, collision-free names for the CSV files of a folder.

For each file: stem → (base, timestamp, version) → semantic name → SQL
identifier. Files are grouped per folder by that identifier (plus the
timestamp unless ``drop_timestamp``); inside a group the newest file (by
timestamp, then modification time, then lower-cased name) keeps the bare
name and the others get ``_v2``, ``_v3`` … Groups are walked in the order
their first file appears in the folder listing (sorted by lower-cased name).

Destinations can still collide across groups (a group named ``x_v2`` meets
member 2 of group ``x``). Collisions are resolved greedily in plan order: a
taken destination gets the smallest free ``_vN`` (N >= 2). Every alternative
stays in its *family* — the destination stem with one trailing ``_vN``
removed — so families are independent.

The rule needs groups, not files. In plan order a group is one single name
(its first member) and one range of slots 2..n in the family of its own name,
and a range that meets slots already taken takes the free ones in rising order:
member ``k`` moves up by one for every taken slot at or below it. So a family
is settled over one row per group (name, size, first position), only where
several groups meet, and the outcome is a first name and a short list of slots
to skip per group. Files get theirs by a join on the group and an expression
on their rank; no file row is ever gathered by family. A family is settled by one
``aggregate()`` over the sorted array of its groups' pieces, inside Spark's expressions.

Plan shape: the semantic mapping runs on distinct bases; ranks come from range
slices (:mod:`berth.operators.ranking`); groups are a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.functions.shorten import with_semantic_name
from berth.functions.stems import TIMESTAMP_SUFFIX, stem, ts_to_int, with_parsed_stem
from berth.functions.text import sql_identifier
from berth.operators.ranking import rank_within
from berth.operators.sizing import join_small, map_distinct
from berth.session import ensure_checkpoint_dir

CSV = ".csv"
_VER_TAIL = r"(?i)_v\d+$"


def _base_identifiers(files: DataFrame) -> DataFrame:
    """Add ``base_raw, ts, ver, ts_int, base_sql`` (semantic mapping computed
    once per distinct base and joined back)."""
    d = with_parsed_stem(files.withColumn("stem", stem("name")), "stem", base="base_raw")
    d = map_distinct(d, "base_raw", lambda keys: with_semantic_name(keys, "__map_key", "__sem").select(
        "__map_key", sql_identifier("__sem").alias("base_sql")))
    return d.withColumn("ts_int", ts_to_int("ts"))


def plan_targets(files: DataFrame, drop_timestamp: bool = False) -> DataFrame:
    """``file_id, dir, name, gkey, rank`` before collision
    resolution. ``files`` needs ``file_id, dir, name, mtime``."""
    d = _base_identifiers(files)
    gkey = F.col("base_sql") if drop_timestamp else F.when(
        F.col("ts").isNull(), F.col("base_sql")).otherwise(F.concat("base_sql", F.lit("_"), "ts"))
    # Only what ranking and the plan need goes on (and into the checkpoint).
    d = d.select("file_id", "dir", "name", "mtime", "ts_int", gkey.alias("gkey"),
                 F.lower("name").alias("lname"))
    # Unreadable modification time counts as "now": newest. Ranking is
    # skew-safe (a hot folder/group is split by its order keys).
    newest_first = [F.desc("ts_int"), F.desc_nulls_first("mtime"), F.asc("lname"), F.asc("name")]
    d = rank_within(d, ["dir", "gkey"], newest_first, "rank")
    return d.select("file_id", "dir", "name", "gkey", "rank")


_OUTCOME = "array<struct<gkey:string,first_stem:string,skips:array<int>>>"


def _settled(pieces: Column, family: Column) -> Column:
    """One family's outcome: its pieces, sorted in plan order, folded over what is taken so far:
    ``names`` and their ``slots`` (in order), and ``full``: all slots from 2 to it."""
    empty = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("slots"),
                     F.lit(1).alias("full"), F.array().cast(_OUTCOME).alias("out"))

    def after(slots: Column, full: Column) -> Column:
        return F.filter(slots, lambda s: s > full)

    def told(p: Column, first_stem: Column, skips: Column) -> Column:
        return F.array(F.struct(p["gkey"].alias("gkey"), first_stem.cast("string").alias("first_stem"), skips.cast("array<int>").alias("skips")))

    def ranged(a: Column, p: Column) -> Column:
        # member k moves up by one for every taken slot at or below it
        skips = F.filter(F.transform(after(a["slots"], F.lit(1)), lambda s, i: s - i), lambda s: s <= p["n"])
        return F.struct(a["names"].alias("names"), a["slots"].alias("slots"), (p["n"].cast("int") + F.size(skips)).alias("full"),
                        F.concat(a["out"], told(p, F.lit(None), skips)).alias("out"))

    def single(a: Column, p: Column) -> Column:
        taken = F.array_contains(a["names"], p["want"]) | F.coalesce(p["slot"].between(2, a["full"]), F.lit(False))
        # the taken slots right behind ``full`` are those as far from it as their index
        ahead = F.size(F.filter(F.transform(after(a["slots"], a["full"]), lambda s, i: s - i), lambda s: s == a["full"] + 1))
        slot = F.when(taken, a["full"] + 1 + ahead).otherwise(p["slot"])
        want = F.when(taken, F.concat(family, F.lit("_v"), slot.cast("string"))).otherwise(p["want"])
        slots = F.when(slot.isNull(), a["slots"]).otherwise(F.sort_array(F.array_union(a["slots"], F.array(slot))))
        return F.struct(F.concat(a["names"], F.array(want)).alias("names"), slots.alias("slots"), a["full"].alias("full"),
                        F.concat(a["out"], told(p, want, F.lit(None))).alias("out"))

    return F.aggregate(pieces, empty, lambda a, p: F.when(p["kind"] == 1, ranged(a, p)).otherwise(single(a, p)), lambda a: a["out"])


def resolve_collisions(planned: DataFrame, drop_timestamp: bool = False) -> DataFrame:
    """``file_id, dir, name, final_stem`` of ``file_id, dir, name, gkey, rank``."""
    # A timestamp can survive inside the base; the first member's stem drops it.
    bare = F.regexp_replace("gkey", TIMESTAMP_SUFFIX, "") if drop_timestamp else F.col("gkey")
    groups = planned.groupBy("dir", "gkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.lower("name").alias("l"), F.col("name").alias("n"))).alias("first"))
    own = F.regexp_replace(bare, _VER_TAIL, "")
    # a slot is written plainly: the family, ``_v`` and a number without leading zeros
    number = F.regexp_extract(bare, r"_v([1-9][0-9]{0,8})$", 1)
    slot = F.when(F.concat(own, F.lit("_v"), number) == bare, F.nullif(number, F.lit("")).cast("int"))
    single = F.struct(F.lit(0).alias("kind"), own.alias("family"), bare.alias("want"), slot.alias("slot"))
    ranged = F.struct(F.lit(1).alias("kind"), F.col("gkey").alias("family"), F.lit(None).cast("string").alias("want"), F.lit(None).cast("int").alias("slot"))
    pieces = groups.select("dir", "gkey", "n", "first", F.explode(F.when(F.col("n") > 1, F.array(single, ranged)).otherwise(F.array(single))).alias("p"))
    piece = F.struct(F.col("first.l").alias("l"), F.col("first.n").alias("f"), "p.kind", "gkey", "n", "p.want", "p.slot")
    families = (pieces.groupBy("dir", F.col("p.family").alias("family"))
                .agg(F.min("gkey").alias("lo"), F.max("gkey").alias("hi"), F.collect_list(piece).alias("pieces")).where("lo <> hi"))
    settled = families.select("dir", F.explode(_settled(F.sort_array("pieces"), F.col("family"))).alias("s"))
    settled = settled.groupBy("dir", F.col("s.gkey").alias("gkey")).agg(F.max("s.first_stem").alias("first_stem"), F.max("s.skips").alias("skips"))
    ensure_checkpoint_dir(planned.sparkSession)
    d = join_small(planned, settled.checkpoint(eager=True), ["dir", "gkey"], "left")  # settled once, counted and joined
    ahead = F.coalesce(F.size(F.filter("skips", lambda s: s <= F.col("rank"))), F.lit(0))
    stem_final = F.when(F.col("rank") == 1, F.coalesce("first_stem", bare)).otherwise(
        F.concat("gkey", F.lit("_v"), (F.col("rank") + ahead).cast("string")))
    return d.select("file_id", "dir", "name", stem_final.alias("final_stem"))


def rename_plan(files: DataFrame, drop_timestamp: bool = False) -> DataFrame:
    """``file_id, dir, src, dst`` for every CSV file of every folder."""
    r = resolve_collisions(plan_targets(files, drop_timestamp), drop_timestamp)
    return r.select("file_id", "dir", F.col("name").alias("src"),
                    F.concat("final_stem", F.lit(CSV)).alias("dst"))


def rename_changes(plan: DataFrame) -> DataFrame:
    """Only the files whose name changes."""
    return plan.where(F.col("src") != F.col("dst"))
