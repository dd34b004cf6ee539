"""Unicode folding, safe names and SQL identifiers as Spark Column expressions.

Normalisation runs JVM-side: ICU (shipped with Spark for collations) is reached
through the built-in ``reflect`` function, and only for rows that hold a
non-ASCII character, so plain ASCII names stay inside whole-stage codegen.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"

# ---------------------------------------------------------------------------
# FIXED VALUES — reserved words that get a ``t_`` prefix in identifiers.
# ---------------------------------------------------------------------------
RESERVED_WORDS = (
    "user", "table", "select", "where", "group", "order", "limit", "offset", "insert",
    "update", "delete", "having", "join", "on", "from", "into", "as", "and", "or", "not",
    "by", "in", "is", "null", "true", "false",
)
IDENTIFIER_MAX_LEN = 63
EMPTY_IDENTIFIER = "t"
IDENTIFIER_PREFIX = "t_"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@functools.lru_cache(maxsize=1)
def combining_marks() -> str:
    """Every code point with a non-zero canonical combining class, derived
    from the Unicode database (a rule, not a list). Deleted with
    ``translate``, which is a hash lookup per character; a regex class of
    these ranges would be scanned range by range."""
    return "".join(chr(cp) for cp in range(0x110000)
                   if not 0xD800 <= cp <= 0xDFFF and unicodedata.combining(chr(cp)))


def _has_non_ascii(c: Column) -> Column:
    return c.rlike("[^\\x00-\\x7F]")


def nfc(c: Column | str) -> Column:
    """Unicode NFC of ``c`` (NULL stays NULL)."""
    c = _col(c)
    composed = F.reflect(F.lit(_ICU_NORMALIZER), F.lit("compose"), c, F.lit(False))
    return F.when(_has_non_ascii(c), composed).otherwise(c)


def norm_key(c: Column | str) -> Column:
    """Matching key of a name: NFC, then lower case; NULL → ''."""
    return F.lower(nfc(F.coalesce(_col(c), F.lit(""))))


def ascii_fold(c: Column | str) -> Column:
    """Compatibility decomposition (NFKD) with combining marks removed.

    Characters without a decomposition (e.g. ``ø``) stay as they are.
    """
    c = _col(c)
    decomposed = F.reflect(F.lit(_ICU_NORMALIZER), F.lit("decompose"), c, F.lit(True))
    stripped = F.translate(decomposed, combining_marks(), "")
    return F.when(_has_non_ascii(c), stripped).otherwise(c)


def safe_name(c: Column | str) -> Column:
    """Landing-file prefix of a title: spaces → ``_``; ``(``, ``)``, ``,`` dropped."""
    return F.translate(_col(c), " (),", "_")


def snake(c: Column | str) -> Column:
    """ASCII fold, lower case, runs outside ``[a-z0-9]`` → ``_``, edges trimmed."""
    s = F.lower(ascii_fold(F.coalesce(_col(c), F.lit(""))))
    return F.btrim(F.regexp_replace(s, "[^a-z0-9]+", "_"), F.lit("_"))


def identifier_from_snake(s: Column) -> Column:
    """The identifier rules applied to an already snake-cased column (each
    input referenced once, so nothing is evaluated twice)."""
    reserved = "|".join(RESERVED_WORDS)
    s = F.regexp_replace(s, "^$", EMPTY_IDENTIFIER)
    s = F.regexp_replace(s, f"^(?=[0-9]|(?:{reserved})$)", IDENTIFIER_PREFIX)
    return F.substring(s, 1, IDENTIFIER_MAX_LEN)


def sql_identifier(c: Column | str, max_len: int = IDENTIFIER_MAX_LEN) -> Column:
    """A lower-case identifier safe for SQL engines.

    Empty → ``t``; a leading digit or a reserved word gets a ``t_`` prefix; the
    result is cut to ``max_len`` last, so a trailing ``_`` may remain.
    """
    out = identifier_from_snake(snake(c))
    return out if max_len == IDENTIFIER_MAX_LEN else F.substring(out, 1, max_len)
