"""Quality rules as a learned decision list, in Spark expressions only.

Statistics are built-in expressions over each whole text. A base rule rejects
short and repetitive texts; behind it stands a decision list learned from
labelled statistics by sequential covering: a conjunction of thresholds grows
condition by condition (FOIL gain on two thirds of the labelled rows), its tail
is pruned on the held-out third, rows it covers are set aside, and the next rule
is learned. The list becomes one ordered ``CASE WHEN``.

Learning sees all labelled rows through grouped counts: each step counts labels
by (feature, bin), at most ``features * (thresholds + 1) * 2`` rows on the driver,
so it grows with the data only as a filter and a map-side count.

Defined cases: null text has no words; texts without words fail the base rule;
without labels (or without a rule that is precise enough) the list is empty and
keeps whatever passes the base; a null label is no label; rows that repeat a
doc_id are judged one by one; an empty table gives an empty result; other columns
pass through ``keep_good`` untouched, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.llm.common import SPACE, stash

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLDS = 24
MAX_RULES, MAX_CONDITIONS = 8, 3
#: A rule must be this precise on held-out rows and cover so many bad ones there.
MIN_PRECISION, MIN_COVERED = 0.95, 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``STATS`` (longs, named with ``prefix``)."""
    own = list(docs.columns)
    keep = [F.col(f"`{c}`") for c in own]
    p = lambda name: f"__quality_step_{name}"
    clean = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(clean, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
    lines = F.filter(F.split(clean, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    gone = lambda pattern: F.char_length(clean) - F.char_length(F.regexp_replace(clean, pattern, ""))
    step = docs.select(*keep, words.alias(p("words")), lines.alias(p("lines")),
                       gone("[#*$%&|<>]").cast("long").alias(p("n_symbols")),
                       gone("\\p{Lu}").cast("long").alias(p("n_upper")))
    held = [p("n_symbols"), p("n_upper")]
    step = step.select(
        *keep, *held, F.size(p("words")).cast("long").alias(p("n_words")),
        F.char_length(F.array_join(p("words"), "")).cast("long").alias(p("word_chars")),
        F.size(p("lines")).cast("long").alias(p("n_lines")),
        (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("long").alias(p("n_dup_lines")),
        F.transform(p("words"), lambda w: F.xxhash64(w)).alias(p("h")))
    held += [p("n_words"), p("word_chars"), p("n_lines"), p("n_dup_lines")]
    # fingerprints of 2, 4 and 8 words in a row, each from two of the half size
    for width in (1, 2, 4):
        n = F.size(p("h")) - width
        pairs = F.zip_with(F.slice(p("h"), F.lit(1), n), F.slice(p("h"), F.lit(width + 1), n), lambda a, b: F.xxhash64(a, b))
        step = step.select(*keep, *held, F.when(n > 0, pairs).otherwise(F.array().cast("array<bigint>")).alias(p("h")))
    repeats = F.size(F.array_distinct(p("h"))) < F.size(p("h"))
    step = step.select(*keep, *held, F.when(repeats, F.array_sort(F.transform(
        p("h"), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias(p("s")))
    twice = F.filter(p("s"), lambda e, j: (
        F.coalesce(F.get(F.col(p("s")), j - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get(F.col(p("s")), j + 1)["h"] == e["h"], F.lit(False))))
    step = step.select(*keep, *held, F.array_sort(F.transform(twice, lambda e: e["i"])).alias(p("at")))
    m = F.size(p("at")) - 1
    gaps = F.zip_with(F.slice(p("at"), F.lit(1), m), F.slice(p("at"), F.lit(2), m), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda a, x: a + x) + WINDOW
    step = step.select(*keep, *held, F.when(F.coalesce(F.size(p("at")), F.lit(0)) > 0, covered)
                       .otherwise(0).cast("long").alias(p("n_repeat_words")))
    return step.select(*keep, *(F.col(p(s)).alias(prefix + s) for s in STATS))


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def features(prefix: str = "") -> dict[str, Column]:
    c = lambda name: F.col(prefix + name).cast("double")
    words, chars = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("word_chars"), F.lit(1.0))
    return {
        "symbol_share": c("n_symbols") / chars,
        "dup_line_share": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)),
        "repeat_share": c("n_repeat_words") / words,
        "upper_share": c("n_upper") / chars,
        "word_length": chars / words,
        "n_words": c("n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > F.lit(self.threshold) if self.above else of[self.feature] <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, of: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, (c.column(of) for c in rule), F.lit(True))


def _any(rules: list[Rule], of: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, (_all(r, of) for r in rules), F.lit(False))


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The decision list as an ordered conditional: False where a rule fires, else True."""
    of = features(prefix)
    out = None
    for rule in rules:
        out = F.when(_all(rule, of), False) if out is None else out.when(_all(rule, of), False)
    return F.lit(True) if out is None else out.otherwise(True)


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many cuts lie below the feature's value."""
    below = F.array(*(F.lit(t) for t in cuts)).cast("array<double>")
    return F.size(F.filter(below, lambda t: t < F.col(feature)))


def _entropy(p: float, n: float) -> float:
    return math.log2(p / (p + n))


def learn(labelled: DataFrame, prefix: str = "") -> list[Rule]:
    """Rules that find the bad rows of ``labelled`` (statistics, ``bad`` boolean, ``fold`` 0..2)."""
    names = list(features(prefix))
    rows = stash(labelled.where(~base_failed(prefix)).select(
        *(c.alias(n) for n, c in features(prefix).items()), "bad", "fold"))
    of = {n: F.col(n) for n in names}
    grow, prune = rows.where("fold < 2"), rows.where("fold = 2")
    steps = [(i + 1) / (THRESHOLDS + 1) for i in range(THRESHOLDS)]
    cuts = grow.groupBy("bad").agg(*(F.percentile_approx(n, steps, 10000).alias(n) for n in names)).collect()
    cuts = {n: sorted({float(x) for r in cuts for x in r[n] or []}) for n in names}
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            left = grow.where(~_any(rules, of) & _all(rule, of))
            binned = F.array(*(F.struct(F.lit(n).alias("feature"), _bin(n, cuts[n]).alias("bin")) for n in names))
            counts: dict[str, dict[tuple[int, bool], int]] = {n: {} for n in names}
            for r in left.select("bad", F.explode(binned).alias("e")).groupBy("e.feature", "e.bin", "bad").count().collect():
                counts[r["feature"]][(r["bin"], r["bad"])] = r["count"]
            bad = sum(v for (_, b), v in counts[names[0]].items() if b)
            good = sum(v for (_, b), v in counts[names[0]].items() if not b)
            best: tuple[float, Condition, int] | None = None
            for n in names:
                low = {True: 0, False: 0}
                for i, t in enumerate(cuts[n]):
                    for b in low:
                        low[b] += counts[n].get((i, b), 0)
                    for above in (True, False):
                        p, q = (bad - low[True], good - low[False]) if above else (low[True], low[False])
                        if p > 0 and (p, q) != (bad, good):
                            gain = p * (_entropy(p, q) - _entropy(bad, good))
                            if gain > 1e-9 and (best is None or gain > best[0]):
                                best = (gain, Condition(n, above, t), q)
            if best is None:
                break
            rule += (best[1],)
            if best[2] == 0:
                break
        if not rule:
            break
        held = prune.where(~_any(rules, of))
        ends = range(1, len(rule) + 1)
        row = held.agg(*(f(_all(rule[:e], of) & is_bad).alias(f"{kind}{e}") for e in ends for kind, f, is_bad in
                         (("p", F.count_if, F.col("bad")), ("n", F.count_if, ~F.col("bad"))))).first()
        worth = {e: (row[f"p{e}"] - row[f"n{e}"]) / max(1, row[f"p{e}"] + row[f"n{e}"]) for e in ends}
        end = max(ends, key=lambda e: (worth[e], -e))
        p, n = row[f"p{end}"], row[f"n{end}"]
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule[:end])
    return rules


def rules_for(stats: DataFrame, labels: DataFrame, prefix: str = "") -> list[Rule]:
    """Learn from ``labels(doc_id, quality)``: quality 0 is bad."""
    marks = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("__id"), (F.col("quality") == 0).alias("bad"))
    slim = stats.select("doc_id", *(prefix + s for s in STATS)).join(marks, F.col("doc_id") == F.col("__id"))
    return learn(slim.withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))), prefix)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, statistics, base_failed, kept)`` for every row of ``docs(doc_id, text)``."""
    stats = stash(with_statistics(docs.select("doc_id", "text")).drop("text"))
    rules = rules_for(stats, labels)
    return stats.select("doc_id", *STATS, base_failed().alias("base_failed"),
                        F.when(base_failed(), False).otherwise(verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    prefix = "__quality_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    told = stash(with_statistics(docs, prefix=prefix))
    rules = rules_for(told, labels, prefix)
    return told.where(~base_failed(prefix) & verdict(rules, prefix)).select(*(F.col(f"`{c}`") for c in docs.columns))
