"""Semantic shortening of long dataset titles into compact snake_case names.

The rule table is data: an ordered list of (pattern, replacement) pairs that is
folded over the column with ``regexp_replace``. Order is part of the meaning
(e.g. "media mensual" must win over "media"). Patterns run on ASCII-folded,
lower-cased text whose ``_``/whitespace runs were turned into single spaces.
"""

from __future__ import annotations

import functools
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.functions.text import ascii_fold, snake

# ---------------------------------------------------------------------------
# FIXED VALUES — domain abbreviation rules, in application order (Java regex
# syntax; ``$1`` is the first group). Groups: header, pollutants, statistics,
# common variables, "según …" scopes, hydrology.
# ---------------------------------------------------------------------------
SEMANTIC_RULES: tuple[tuple[str, str], ...] = (
    (r"^\s*concentracion\s+de\s+", ""),
    (r"\bozono\s*(?:\((?:o3)\)|\s+o3)?\b", "o3"),
    (r"dioxido\s+de\s+azufre\s*(?:\((?:so2)\)|\s+so2)?\b", "so2"),
    (r"dioxido\s+de\s+nitrogeno\s*(?:\((?:no2)\)|\s+no2)?\b", "no2"),
    (r"oxidos\s+de\s+nitrogeno\s*(?:\((?:nox)\)|\s+nox)?\b", "nox"),
    (r"monoxido\s+de\s+carbono\s*(?:\((?:co)\)|\s+co)?\b", "co"),
    (r"monoxido\s+de\s+nitrogeno\s*(?:\((?:no)\)|\s+no)?\b", "no"),
    (r"material\s+particulado(?:\s+fino)?\s+respirable\s*"
     r"(?:\(\s*mp\s*2[,\.]?\s*5\s*\)|mp\s*2[,\.]?\s*5|mp\s*25|mp25)\b", "mp25"),
    (r"material\s+particulado\s+respirable\s*(?:\(\s*mp\s*10\s*\)|mp\s*10|mp10)\b", "mp10"),
    (r"material\s+particulado\s+fino\s+respirable\s*\(mp\s*2[,\.]?\s*5\)", "mp25"),
    (r"\bmensua\b", "mensual"),
    (r"\b(?:al|a\s+el)?\s*percentil\s*(\d+)\b", "perc$1"),
    (r"\bmedia\s+mensual\b", "med_mens"),
    (r"\bpromedio\b", "prom"),
    (r"\bmedia\b", "med"),
    (r"\bmensual\b", "mens"),
    (r"\banual\b", "anual"),
    (r"\bmaxima\s+horaria\s+anual\b", "max_hor_anual"),
    (r"\bminima\s+horaria\s+anual\b", "min_hor_anual"),
    (r"\bmaxima\s+horaria\b", "max_hor"),
    (r"\bminima\s+horaria\b", "min_hor"),
    (r"\bmaxima\b", "max"),
    (r"\bminima\b", "min"),
    (r"\btemperatura\b", "temp"),
    (r"\bhumedad\s+relativa\b", "humedad_rel"),
    (r"\bradiacion\s+global\b", "rad_global"),
    (r"\bindice\s+uv[-_ ]?b\b", "uvb"),
    (r"\bnumero\s+de\s+\b", "num_"),
    (r"\bevaporacion\s+real\b", "evaporacion_real"),
    (r"\bsegun\s+cuenca(?:\s+hidrografica)?\b", "por_cuenca"),
    (r"\bsegun\s+estacion\b", "por_estacion"),
    (r"\bsegun\s+embalse\b", "por_embalse"),
    (r"\bcantidad\s+de\s+agua\s+ca[ií]da\b", "cantidad_de_agua_caida"),
    (r"\baltura\s+de\s+nieve\s+equivalente\s+en\s+agua\b", "altura_nieve_equivalente_en_agua"),
)

# "mp 2.5" in parentheses is rewritten to the comma form before the rules.
MP25_DOT_PATTERN = r"\(mp\s*2\.5\)"
MP25_DOT_REPLACEMENT = "(mp2,5)"

# Scope words: if present before the rules and the "por_*" token is not in the
# result, the token is appended. (flag pattern(s), token)
SCOPE_SUFFIXES: tuple[tuple[tuple[str, ...], str], ...] = (
    ((r"\bcuenca\b", r"hidrograf"), "por_cuenca"),
    ((r"\bestacion\b",), "por_estacion"),
    ((r"\bembalse\b",), "por_embalse"),
)

# Leading pollutant tokens whose immediate repetition is collapsed (o3o3_ → o3_).
POLLUTANT_TOKENS = ("co", "no2", "o3", "nox", "no", "so2", "mp10", "mp25")
# ---------------------------------------------------------------------------

# Unicode-aware \b, \s, \d, like the text they were written for.
_U = "(?U)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dup_prefix_pattern(tokens: Sequence[str] = POLLUTANT_TOKENS) -> str:
    return r"(?i)^(" + "|".join(tokens) + r")(?:_?\1)+_?"


def collapse_dup_prefix(c: Column | str) -> Column:
    """A leading pollutant token repeated (``o3o3_x``, ``co_co_x``) → once + ``_``."""
    return F.regexp_replace(_col(c), dup_prefix_pattern(), "$1_")


def apply_rules(c: Column, rules: Sequence[tuple[str, str]] = SEMANTIC_RULES) -> Column:
    """Fold the ordered rule table over ``c``."""
    return functools.reduce(
        lambda acc, rule: F.regexp_replace(acc, _U + rule[0], rule[1]), rules, c)


def _prepare(raw: Column) -> Column:
    s = F.lower(ascii_fold(raw))
    return F.trim(F.regexp_replace(s, _U + r"[_\s]+", " "))


def _flag(s: Column, patterns: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [s.rlike(_U + p) for p in patterns])


def _shorten(s: Column, rules: Sequence[tuple[str, str]]) -> Column:
    s = F.regexp_replace(s, _U + MP25_DOT_PATTERN, MP25_DOT_REPLACEMENT)
    s = apply_rules(s, rules)
    return F.trim(F.regexp_replace(s, _U + r"\s+", " "))


def _append_scopes(r: Column, flags: Sequence[Column]) -> Column:
    for flag, (_patterns, token) in zip(flags, SCOPE_SUFFIXES):
        r = F.concat(r, F.when(flag & ~r.contains(token), F.lit(" " + token)).otherwise(F.lit("")))
    return r


def _finish(o: Column, raw: Column) -> Column:
    o = F.when(o == "", snake(raw)).otherwise(o)
    return F.when(raw.isNull() | (raw == ""), F.lit("")).otherwise(collapse_dup_prefix(o))


def with_semantic_name(df: DataFrame, src: str, out: str,
                       rules: Sequence[tuple[str, str]] = SEMANTIC_RULES) -> DataFrame:
    """Add column ``out``: the compact snake_case name of column ``src``.

    Computed in stepwise projections so the ASCII fold and the rule chain run
    once per row (an expression tree would repeat them in every branch).
    """
    raw = F.col(src)
    d = df.withColumn("__sem_s", _prepare(raw))
    s = F.col("__sem_s")
    flags = [_flag(s, pats).alias(f"__sem_f{i}") for i, (pats, _t) in enumerate(SCOPE_SUFFIXES)]
    d = d.select("*", *flags, _shorten(s, rules).alias("__sem_r"))
    fcols = [F.col(f"__sem_f{i}") for i in range(len(SCOPE_SUFFIXES))]
    d = d.withColumn("__sem_o", snake(_append_scopes(F.col("__sem_r"), fcols)))
    d = d.withColumn(out, _finish(F.col("__sem_o"), raw))
    return d.drop("__sem_s", "__sem_r", "__sem_o", *[f"__sem_f{i}" for i in range(len(SCOPE_SUFFIXES))])


def with_semantic_name_distinct(df: DataFrame, src: str, out: str,
                                rules: Sequence[tuple[str, str]] = SEMANTIC_RULES) -> DataFrame:
    """:func:`with_semantic_name` computed once per distinct ``src`` value and
    joined back. Landing names repeat (the same dataset downloaded many
    times), so the rule chain runs on far fewer rows; the distinct is
    partially aggregated before its shuffle, and the mapping is broadcast
    only when measured small (else a sort-merge join, which AQE splits when
    one name is hot)."""
    from berth.operators.sizing import map_distinct
    return map_distinct(df, src, lambda keys: with_semantic_name(keys, "__map_key", out, rules))


def semantic_name(c: Column | str,
                  rules: Sequence[tuple[str, str]] = SEMANTIC_RULES) -> Column:
    """Column form of :func:`with_semantic_name` for small inputs (repeats
    sub-expressions; prefer the DataFrame form on large frames).

    Empty or NULL input → ''. If the rules leave nothing, the plain snake form
    of the input is used. Repeated leading pollutant tokens are collapsed last.
    """
    raw = _col(c)
    s = _prepare(raw)
    flags = [_flag(s, pats) for pats, _t in SCOPE_SUFFIXES]
    return _finish(snake(_append_scopes(_shorten(s, rules), flags)), raw)
