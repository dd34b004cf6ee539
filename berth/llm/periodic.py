"""Periodic runs of words, by maximal pairs of an LCP-interval tree.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) that no neighbouring word extends; runs of at least ``max(24, 3 * q)``
words are wanted. Two suffixes at ``i < j`` that share exactly ``l`` words and
whose words before them differ are a *maximal pair*; with ``p = j - i`` the stretch
``[i, i + l + p)`` has period ``p`` and cannot be extended. So the runs are the
maximal pairs whose distance satisfies ``l >= max(24 - p, 2 * p)``, the least ``p``
for each stretch: nothing is extended word by word.

A document's suffixes are ranked by prefix doubling; the LCP of neighbours comes
from the same ranks. The LCP intervals of 16 words or more (shorter ones satisfy
no distance) are visited bottom-up. Each holds its suffixes in lists by their left
word; when two children meet, the smaller one looks in the larger one's lists of
*other* left words for positions near enough, then moves in, so that a suffix moves
a logarithmic number of times.

Documents are independent: one pass over the table without any exchange. A task
holds one document's ranks, about 8 bytes a word and doubling.

Defined cases: a null text is empty and has no words; a null doc_id stays null; rows
that repeat a doc_id are documents of their own; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least words of a run, and least number of whole periods in it.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: No pair that shares fewer words than this satisfies the distances.
LEAST_SHARED = min(max(LEAST_WORDS - p, (LEAST_PERIODS - 1) * p) for p in range(1, LEAST_WORDS))

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def ranks(codes: np.ndarray) -> list[np.ndarray]:
    """For 1, 2, 4, ... words: the rank of each suffix by its first words (a suffix that
    ends earlier comes first), until all ranks differ; nothing if no two suffixes share
    ``LEAST_SHARED`` words."""
    n, k = len(codes), 1
    out = [np.unique(codes, return_inverse=True)[1].astype(np.int32)]
    while True:
        rank = out[-1]
        if k >= LEAST_SHARED and int(rank.max()) == n - 1:
            return out
        follow = np.zeros(n, np.int64)
        follow[:n - k] = rank[k:].astype(np.int64) + 1
        values, inverse = np.unique(rank * np.int64(n + 1) + follow, return_inverse=True)
        out.append(inverse.astype(np.int32))
        k *= 2
        if len(values) == n and k <= LEAST_SHARED:
            return []


def shared(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words the suffixes i and j (arrays, i <> j) share."""
    n = len(levels[0])
    size = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[level], -1)
        a, b = np.minimum(i + size, n), np.minimum(j + size, n)
        size += (1 << level) * ((rank[a] == rank[b]) & (a < n) & (b < n))
    return size


class Node:
    """Suffixes of an LCP interval: all positions in order, and by left word."""

    __slots__ = ("all", "by_left")

    def __init__(self, position: int, left: int):
        self.all = [position]
        self.by_left = {left: [position]}


def _meet(one: Node, two: Node, words: int, left: list[int], found: dict) -> Node:
    """Pairs between two children of an interval of ``words`` shared words, then their union."""
    small, large = (one, two) if len(one.all) <= len(two.all) else (two, one)
    most, least = words // (LEAST_PERIODS - 1), max(1, LEAST_WORDS - words)
    if least <= most:
        for own, positions in small.by_left.items():
            for at in positions:
                low, high = bisect_left(large.all, at - most), bisect_right(large.all, at + most)
                if high - low <= len(large.by_left):
                    near = [x for x in large.all[low:high] if left[x] != own]
                else:
                    near = []
                    for other, places in large.by_left.items():
                        if other != own:
                            near += places[bisect_left(places, at - most):bisect_right(places, at + most)]
                for x in near:
                    period = abs(x - at)
                    if period >= least:
                        start = min(x, at)
                        stretch = (start, words + period)
                        if found.get(stretch, period) >= period:
                            found[stretch] = period
    for own, positions in small.by_left.items():
        here = large.by_left.setdefault(own, [])
        for at in positions:
            insort(here, at)
            insort(large.all, at)
    return large


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a list of words, by start, then period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    number: dict = {}
    codes = [number.setdefault(w, len(number)) for w in words]
    if len(number) > n - (LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS):
        return []  # a run repeats at least so many words
    levels = ranks(np.array(codes, np.int64))
    if not levels:
        return []
    order = np.argsort(levels[-1], kind="stable")
    lcp = shared(levels, order[:-1], order[1:])
    left = [-1, *codes[:-1]]
    found: dict[tuple[int, int], int] = {}
    suffix, lcp = order.tolist(), lcp.tolist()
    lcp.append(0)
    stack: list[tuple[int, Node]] = []
    node = None
    for t, place in enumerate(suffix):
        words_shared = lcp[t]
        if words_shared < LEAST_SHARED and not stack:
            continue
        node = Node(place, left[place])
        while stack and stack[-1][0] > words_shared:
            held, top = stack.pop()
            node = _meet(top, node, held, left, found)
        if words_shared < LEAST_SHARED:
            continue
        if stack and stack[-1][0] == words_shared:
            stack[-1] = (words_shared, _meet(stack[-1][1], node, words_shared, left, found))
        else:
            stack.append((words_shared, node))
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts = part.column("text")
        for at in range(0, len(texts), 256):
            n_words, found, collapsed = [], [], []
            for text in texts.slice(at, 256):
                words = (text.as_py() or b"").split()  # exactly 0x20 and 0x09-0x0D separate
                runs = runs_of(words)
                n_words.append(len(words))
                found.append([{"start": s, "length": m, "period": p} for s, m, p in runs])
                collapsed.append(b" ".join(collapse(words, runs)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").slice(at, 256), pa.array(n_words, pa.int64()), pa.array(found, kind),
                 pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for each row of ``docs(doc_id, text)``: the runs by
    start, then period, and the words outside repeated periods, joined by one space."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = texts.mapInArrow(_found, f"doc_id long, n_words long, runs {_RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _before(a: Column, b: Column) -> Column:
    """Comparator: the greater exact exponent first, then the smaller start, then the smaller period."""
    one, two = a["length"] * b["period"], b["length"] * a["period"]
    later = (one < two) | ((one == two) & ((a["start"] > b["start"]) | ((a["start"] == b["start"]) & (a["period"] > b["period"]))))
    return F.when(later, F.lit(1)).otherwise(F.lit(-1))


def digests(found: DataFrame) -> DataFrame:
    """The strongest run and digests of all runs and of the collapsed text."""
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, x: F.when(_before(top, x) == 1, x).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    told = found.withColumn("best", best)
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
