"""File-name anatomy: extension, stem, version and timestamp suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.functions.text import safe_name

# ---------------------------------------------------------------------------
# FIXED VALUES — suffix patterns and formats of landing file names.
# ---------------------------------------------------------------------------
VERSION_SUFFIX = r"(?i)_v(\d+)$"                       # trailing _vN, any case
TIMESTAMP_SUFFIX = r"[\-_](\d{8})[\-_](\d{6})\s*$"     # _YYYYMMDD_HHMMSS or -…-…
LANDING_TS_FORMAT = "yyyyMMdd_HHmmss"
LANDING_EXT = ".csv"
NO_EXTENSION_LABEL = "(sin extensión)"
# ---------------------------------------------------------------------------

# Last dot that is neither the first nor the last character starts the suffix.
_SUFFIX = r"(?s)^.+(\.[^.]+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extension(c: Column | str, label: str | None = NO_EXTENSION_LABEL) -> Column:
    """Lower-cased suffix of a file name (``.csv``); ``label`` when there is none."""
    ext = F.lower(F.regexp_extract(_col(c), _SUFFIX, 1))
    if label is None:
        return ext
    return F.when(ext == "", F.lit(label)).otherwise(ext)


def stem(c: Column | str) -> Column:
    """File name without its last suffix (``a.b.csv`` → ``a.b``; ``.env`` stays)."""
    return F.regexp_replace(_col(c), r"(?s)^(.+)\.[^.]+$", "$1")


def strip_version(c: Column | str) -> Column:
    """Struct ``(rest, ver)``: a trailing ``_vN`` removed; ``ver`` NULL if absent."""
    c = _col(c)
    ver = F.regexp_extract(c, VERSION_SUFFIX, 1)
    return F.struct(
        F.regexp_replace(c, VERSION_SUFFIX, "").alias("rest"),
        F.when(ver != "", ver.try_cast("bigint")).alias("ver"),
    )


def strip_timestamp(c: Column | str) -> Column:
    """Struct ``(rest, ts)``: a trailing timestamp removed; ``ts`` as
    ``YYYYMMDD_HHMMSS`` whichever separator the name used, NULL if absent."""
    c = _col(c)
    has = c.rlike(TIMESTAMP_SUFFIX)
    ts = F.concat_ws("_", F.regexp_extract(c, TIMESTAMP_SUFFIX, 1),
                     F.regexp_extract(c, TIMESTAMP_SUFFIX, 2))
    return F.struct(
        F.regexp_replace(c, TIMESTAMP_SUFFIX, "").alias("rest"),
        F.when(has, ts).alias("ts"),
    )


def parse_stem(c: Column | str) -> Column:
    """Struct ``(base, ts, ver)``: version suffix first, then timestamp.
    Column form for small inputs; :func:`with_parsed_stem` evaluates each
    regex once per row."""
    v = strip_version(c)
    t = strip_timestamp(v["rest"])
    return F.struct(t["rest"].alias("base"), t["ts"].alias("ts"), v["ver"].alias("ver"))


# Whole-suffix forms: one regex each, the parts are then cut by offsets.
_VERSION_MATCH = r"(?i)_v\d+$"
_TIMESTAMP_MATCH = r"[\-_]\d{8}[\-_]\d{6}\s*$"


def with_parsed_stem(df: DataFrame, src: str, base: str = "base", ts: str = "ts",
                     ver: str = "ver") -> DataFrame:
    """Add ``base``, ``ts`` and ``ver`` parsed from stem column ``src``."""
    c = F.col(src)
    d = df.withColumn("__vm", F.regexp_extract(c, _VERSION_MATCH, 0))
    vm = F.col("__vm")
    d = d.select("*", F.substring(c, F.lit(1), F.length(c) - F.length(vm)).alias("__rest"),
                 F.when(vm != "", F.substring(vm, 3, 1 << 30).try_cast("bigint")).alias(ver))
    r = F.col("__rest")
    d = d.withColumn("__tm", F.regexp_extract(r, _TIMESTAMP_MATCH, 0))
    tm = F.col("__tm")
    d = d.select("*", F.substring(r, F.lit(1), F.length(r) - F.length(tm)).alias(base),
                 F.when(tm != "", F.concat(F.substring(tm, 2, 8), F.lit("_"),
                                           F.substring(tm, 11, 6))).alias(ts))
    return d.drop("__vm", "__rest", "__tm")


def ts_to_int(ts: Column | str) -> Column:
    """``YYYYMMDD_HHMMSS`` → comparable BIGINT (no calendar check); NULL → 0."""
    return F.coalesce(F.replace(_col(ts), F.lit("_"), F.lit("")).try_cast("bigint"),
                      F.lit(0).cast("bigint"))


def landing_name(title: Column | str, ts: Column | str) -> Column:
    """Name a download lands under: ``{safe title}_{YYYYMMDD_HHMMSS}.csv``."""
    return F.concat(safe_name(title), F.lit("_"),
                    F.date_format(_col(ts), LANDING_TS_FORMAT), F.lit(LANDING_EXT))
