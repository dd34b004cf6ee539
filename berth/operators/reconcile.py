"""Reconcile a landing zone with the expected catalogue.

A title is *present* when some file name, compared NFC + lower case, equals
``{title}.csv`` or ``{safe title}.csv``, or starts with ``{title}_`` or
``{safe title}_``. Missing titles and extra files are the two anti joins.

Plan shape. The prefix test is turned into equality: a file contributes its
name without ``.csv`` and every prefix that ends right before a ``_``; a title
contributes its raw and safe forms. Matching is then an equi join against the
catalogue keys, which are bounded by the catalogue size and broadcast:

* missing titles: explode keys → broadcast hash join → partial ``distinct idx``
  (at most one row per title leaves each map task) → anti join the catalogue;
* extra / matched files: an in-row membership test against the catalogue key
  set (no join, no shuffle) while that set is small; past ``inline_limit`` keys
  it becomes a semi/anti join on ``file_id``.

A hot prefix shared by a third of the files costs nothing extra: the probe side
is never shuffled by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.functions.text import norm_key, safe_name

# Above this many catalogue keys the key set is joined instead of inlined.
INLINE_KEY_LIMIT = 20_000
# Above this many catalogue rows the catalogue side is not broadcast.
BROADCAST_CATALOG_ROWS = 1_000_000

STATUS_OK = 0
STATUS_DIFFERENCES = 2
STATUS_NO_FOLDER = 3


class CatalogIndex:
    """Driver-side facts about a catalogue, all bounded: its row count (the
    size check that licenses a broadcast), the distinct lengths of its keys
    in bytes (at most the longest title), and — while small — the key set itself."""

    def __init__(self, cat: DataFrame, inline_limit: int = INLINE_KEY_LIMIT):
        self.cat = cat
        self.keys = catalog_keys(cat)
        # One bounded collect answers all three questions for a small
        # catalogue; a large one falls back to aggregates.
        head = self.keys.select("idx", "key", F.octet_length("key").alias("n")) \
            .limit(inline_limit + 1).collect()
        if len(head) <= inline_limit:
            self.n_rows = len({r["idx"] for r in head})
            self.lengths = sorted({r["n"] for r in head})
            self.inline = sorted({r["key"] for r in head})
        else:
            self.n_rows = cat.count()
            self.lengths = sorted(r[0] for r in self.keys.select(F.octet_length("key")).distinct().collect())
            self.inline = None

    def keys_side(self) -> DataFrame:
        return _maybe_broadcast(self.keys, 2 * self.n_rows)


def catalog_index(cat: DataFrame) -> CatalogIndex:
    """The index of ``cat``, computed once and kept with the catalogue object."""
    if "_berth_index" not in vars(cat):
        cat._berth_index = CatalogIndex(cat)
    return cat._berth_index


def catalog_keys(cat: DataFrame) -> DataFrame:
    """``idx, key`` — raw and safe form of every title, matching-normalised."""
    return (cat.select("idx", F.explode(F.array_distinct(F.array(
        norm_key("title"), norm_key(safe_name("title"))))).alias("key")))


def _maybe_broadcast(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_CATALOG_ROWS else df


_UNDERSCORE = bytearray(b"_")
_CSV = bytearray(b".csv")


def _name_bytes(name: str) -> Column:
    # Offsets on the UTF-8 bytes are O(1); a byte prefix that is followed by
    # the ASCII ``_`` always ends on a character boundary, so it is exact.
    return norm_key(name).cast("binary")


def _exact_key(b: Column) -> Column:
    n = F.length(b)
    return F.when((n > 4) & (F.substring(b, n - 3, 4) == F.lit(_CSV)),
                  F.substring(b, F.lit(1), n - 4).cast("string"))


def _prefix_key(b: Column, length: Column | int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.when(F.substring(b, length + 1, F.lit(1)) == F.lit(_UNDERSCORE),
                  F.substring(b, F.lit(1), length).cast("string"))


def exploded_name_keys(files: DataFrame, lengths: list[int], name: str = "name") -> DataFrame:
    """``file_id, key`` — one row per candidate key: the normalised name without
    ``.csv`` and its prefixes followed by ``_``, at the byte lengths that catalogue
    keys have; a generator over these lengths, filtered in the same stage."""
    d = files.select("file_id", _name_bytes(name).alias("__b"))
    g = d.select("file_id", "__b", F.explode(F.array(*[F.lit(l) for l in [-1] + lengths])).alias("__l"))
    b, l = F.col("__b"), F.col("__l")
    key = F.when(l < 0, _exact_key(b)).otherwise(_prefix_key(b, l))
    return g.select("file_id", key.alias("key")).where(F.col("key").isNotNull())


def title_matches(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """``file_id, idx`` — every (file, title) pair that matches."""
    ix = index or catalog_index(cat)
    exploded = exploded_name_keys(files, ix.lengths)
    return exploded.join(ix.keys_side(), "key", "inner").select("file_id", "idx")


def missing(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """Catalogue rows (``idx, scope, module, title``) that no file matches."""
    ix = index or catalog_index(cat)
    found = title_matches(cat, files, ix).select("idx").distinct()
    return cat.join(_maybe_broadcast(found, ix.n_rows), "idx", "left_anti")


def with_match_flag(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None,
                    out: str = "__matched") -> DataFrame:
    """Add boolean ``out``: does the file match some title. While the key set
    is inlined this is an in-row test — an OR over the catalogue's key
    lengths of "``_`` at that byte and the prefix is one of the keys of that
    length" (short-circuiting, no per-row array); otherwise a left join on the
    name, which alone decides."""
    ix = index or catalog_index(cat)
    if ix.inline is not None:
        by_len: dict[int, list[str]] = {}
        for k in ix.inline:
            by_len.setdefault(len(k.encode("utf-8")), []).append(k)
        d = files.withColumn("__b", _name_bytes("name"))
        b = F.col("__b")
        terms = [_exact_key(b).isin(*ix.inline)] if ix.inline else []
        for length, keys in sorted(by_len.items()):
            terms.append(_prefix_key(b, length).isin(*keys))
        cond = F.lit(False)
        for t in terms:
            cond = cond | F.coalesce(t, F.lit(False))
        return d.withColumn(out, cond).drop("__b")
    names = files.select("name", F.col("name").alias("file_id")).distinct()
    hit = title_matches(cat, names, ix).select(F.col("file_id").alias("name")).distinct().withColumn(out, F.lit(True))
    return files.join(hit, "name", "left").select(*files.columns, F.coalesce(out, F.lit(False)).alias(out))


def extras(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """Files that match no title (duplicate names in other folders kept)."""
    return with_match_flag(cat, files, index).where(~F.col("__matched")).drop("__matched")


def matched(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """Files that match at least one title."""
    return with_match_flag(cat, files, index).where(F.col("__matched")).drop("__matched")


def missing_by_module(cat: DataFrame, files: DataFrame,
                      index: CatalogIndex | None = None) -> DataFrame:
    """``scope, module, n_expected, n_missing`` per module plus a total row
    (scope and module NULL); modules with nothing missing show 0."""
    ix = index or catalog_index(cat)
    miss = missing(cat, files, ix).select("idx", F.lit(1).alias("m"))
    j = cat.join(_maybe_broadcast(miss, ix.n_rows), "idx", "left")
    g = (j.rollup("scope", "module")
         .agg(F.count("*").alias("n_expected"),
              F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("n_missing"),
              F.grouping("scope").alias("gs"), F.grouping("module").alias("gm")))
    return g.where((F.col("gs") == F.col("gm"))).drop("gs", "gm")


def status(cat: DataFrame, files: DataFrame, index: CatalogIndex | None = None) -> DataFrame:
    """One row ``n_missing, n_extras, status``: 0 when nothing is missing and
    nothing is extra, else 2 (a missing folder, status 3, is caught before
    any listing by the job)."""
    ix = index or catalog_index(cat)
    flags = (missing(cat, files, ix).select(F.lit(1).alias("m"), F.lit(0).alias("e"))
             .unionByName(extras(cat, files, ix).select(F.lit(0).alias("m"), F.lit(1).alias("e"))))
    agg = flags.agg(F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("n_missing"),
                    F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("n_extras"))
    return agg.withColumn(
        "status",
        F.when((F.col("n_missing") == 0) & (F.col("n_extras") == 0), F.lit(STATUS_OK))
        .otherwise(F.lit(STATUS_DIFFERENCES)))


def numbered(missing_titles: DataFrame) -> DataFrame:
    """Missing titles numbered per module in catalogue order, with the
    console label ``NN. title`` (two digits at least, never cut)."""
    from pyspark.sql import Window
    w = Window.partitionBy("module").orderBy("idx")
    return (missing_titles.withColumn("seq", F.row_number().over(w).cast("bigint"))
            .withColumn("label", F.format_string("%02d. %s", F.col("seq"), F.col("title"))))
