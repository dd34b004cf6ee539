"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few shape statistics (one vectorised pass over its bytes and
words). Cyclic boosting visits the features in turn and adds a shallow tree,
grown on the gradients of that feature's bins alone, to the feature's lookup
table; then the pairs whose joint bins explain most of what is left get
two-dimensional tables the same way. A score is the sum of table entries through
a logistic.

The model is fitted on at most ``FIT_ROWS`` labelled rows (the smallest by hash
of doc_id among those offered); every row is scored. Only text statistics enter:
labels, language, source and id never do.

Defined cases: null text counts as empty; empty texts score by the table entries
of zero statistics; a doc_id with several labels trains on each; without labels
every score is 0.5; null labels and null ids do not train; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.llm import wordhash

#: Labelled rows that the fit reads at most.
FIT_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.15
#: Pseudo-rows that hold a leaf towards zero.
PRIOR = 4.0
FEATURES = ("log_bytes", "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "stop_share", "shout_share",
            "wide_share", "distinct_share", "top_share", "repeat_share", "line_words", "dup_line_share")

_CLASS = np.full(256, 8, np.uint8)  # other
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 0
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CLASS[list(b"0123456789")] = 2
_CLASS[list(b"#*$%&|<>")] = 3
_CLASS[list(b".,;:")] = 4
_CLASS[list(b"!?")] = 5
_CLASS[128:] = 6
_CLASS[list(b" \t\n\v\f\r")] = 7


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text of a batch."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    count = np.bincount(doc * 9 + _CLASS[raw], minlength=9 * n).reshape(n, 9).astype(np.float64)
    word, at = wordhash.words(raw, offsets)
    words = np.diff(at).astype(np.float64)
    distinct, top, again = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        w = word[at[i]:at[i + 1]]
        if len(w):
            again[i] = np.count_nonzero(w[1:] == w[:-1])
            s = np.sort(w)
            cuts = np.flatnonzero(s[1:] != s[:-1])
            distinct[i] = len(cuts) + 1
            top[i] = np.diff(np.concatenate([[-1], cuts, [len(s) - 1]])).max()
    # lines by the hash of the words in them, lines without words left out
    breaks = np.flatnonzero(raw == 10)
    line = np.zeros(len(raw) + 1, np.int64)
    line[breaks + 1] = 1
    line[offsets[:-1]] = 1
    line = np.cumsum(line)
    lines, dups = np.zeros(n), np.zeros(n)
    if len(word):
        sums = wordhash.prefix_sums(word)
        # the first byte of each word finds its line
        inside = ~wordhash._WS[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[heads] = inside[heads]
        own = line[np.flatnonzero(first)]
        start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        end = np.append(start[1:], len(own))
        print_ = wordhash.spans(sums, start, end)
        of = np.searchsorted(at, start, "right") - 1
        lines = np.bincount(of, minlength=n).astype(np.float64)
        order = np.lexsort((print_, of))
        same = (print_[order][1:] == print_[order][:-1]) & (of[order][1:] == of[order][:-1])
        dups = np.bincount(of[order][1:][same], minlength=n).astype(np.float64)
    some = lambda x: np.maximum(x, 1.0)
    ink = some(size - count[:, 7])
    return np.stack([
        np.log1p(size), np.log1p(words), (size - count[:, 7]) / some(words), count[:, 1] / some(count[:, 0] + count[:, 1]),
        count[:, 2] / ink, count[:, 3] / ink, count[:, 4] / ink, count[:, 5] / ink, count[:, 6] / ink,
        distinct / some(words), top / some(words), again / some(words), words / some(lines), dups / some(lines)], 1)


def _features(columns: list[str], finish, kind: pa.DataType):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, raw, offsets in wordhash.batches(part.column("text")):
                x = statistics(raw, offsets)
                yield pa.RecordBatch.from_arrays([*(part.column(c).slice(at, len(x)) for c in columns), finish(x, kind)], [*columns, "out"])
    return run


def _packed(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([r.tobytes() for r in x], kind)


# -- the model ---------------------------------------------------------------

def _split_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin of a shallow tree on gradient sums ``g`` and weights ``h``."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + PRIOR)
    edges = [0, len(g)]
    for _ in range(leaves - 1):
        best = None
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = worth(a, cut) + worth(cut, b) - worth(a, b)
                i = int(gain.argmax())
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                    best = (gain[i], int(cut[i]))
        if best is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + PRIOR)
    return out


def _split_grid(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Cell values of the best tree with one split of each axis."""
    sums = lambda m: np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    sg, sh, (a, b) = sums(g), sums(h), g.shape
    best, out = 0.0, np.zeros_like(g)
    for i in range(1, a):
        for j in range(1, b):
            quads = [(0, i, 0, j), (0, i, j, b), (i, a, 0, j), (i, a, j, b)]
            part = [(sg[q[1], q[3]] - sg[q[0], q[3]] - sg[q[1], q[2]] + sg[q[0], q[2]],
                     sh[q[1], q[3]] - sh[q[0], q[3]] - sh[q[1], q[2]] + sh[q[0], q[2]]) for q in quads]
            gain = sum(x * x / (y + PRIOR) for x, y in part)
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for q, (x, y) in zip(quads, part):
                    out[q[0]:q[1], q[2]:q[3]] = x / (y + PRIOR)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Lookup tables of the features and of their strongest pairs."""
    base = float(np.log((y.sum() + 1.0) / (len(y) - y.sum() + 1.0)))
    if not len(y):
        return {"base": 0.0, "cuts": [], "tables": [], "pairs": []}
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    bins = [np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    z = np.full(len(y), base)
    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            p = _sigmoid(z)
            step = RATE * _split_tree(np.bincount(b, y - p, len(tables[f])), np.bincount(b, p * (1 - p), len(tables[f])))
            tables[f] += step
            z += step[b]
    coarse_cuts = [np.unique(np.quantile(c, np.arange(1, PAIR_BINS) / PAIR_BINS)) for c in x.T]
    coarse = [np.searchsorted(c, v, "right") for c, v in zip(coarse_cuts, x.T)]
    p = _sigmoid(z)
    found = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            cell, shape = coarse[i] * PAIR_BINS + coarse[j], PAIR_BINS * PAIR_BINS
            g, h = np.bincount(cell, y - p, shape), np.bincount(cell, p * (1 - p), shape)
            found.append((float((g * g / (h + PRIOR)).sum()), i, j))
    pairs = [(i, j, coarse_cuts[i], coarse_cuts[j], np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in sorted(found, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, grid in pairs:
            p, cell = _sigmoid(z), coarse[i] * PAIR_BINS + coarse[j]
            shape = grid.size
            step = RATE * _split_grid(np.bincount(cell, y - p, shape).reshape(grid.shape), np.bincount(cell, p * (1 - p), shape).reshape(grid.shape))
            grid += step
            z += step.ravel()[cell]
    return {"base": base, "cuts": cuts, "tables": tables, "pairs": pairs}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), model["base"])
    for cuts, table, v in zip(model["cuts"], model["tables"], x.T):
        z += table[np.searchsorted(cuts, v, "right")]
    for i, j, ci, cj, grid in model["pairs"]:
        z += grid[np.searchsorted(ci, x[:, i], "right"), np.searchsorted(cj, x[:, j], "right")]
    return _sigmoid(z)


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> dict:
    """Fit on at most ``rows`` of ``labels(doc_id, label)``, by hash of doc_id."""
    marks = labels.where("doc_id is not null and label is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("label").cast("int").alias("label"))
    marks = marks.orderBy(F.xxhash64("id"), "id", "label").limit(rows)  # bounded: broadcast below
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")).join(F.broadcast(marks), "id")
    found = texts.select("text", "label").mapInArrow(_features(["label"], _packed, pa.binary()), "label int, out binary").collect()
    x = np.array([np.frombuffer(r.out, np.float64) for r in found]).reshape(len(found), len(FEATURES))
    y = np.array([r.label for r in found], np.float64)
    order = np.lexsort((*x.T, y))  # the same sums whatever order the rows came in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: dict, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, score)`` for every row of ``docs(doc_id, text)``."""
    tables = docs.sparkSession.sparkContext.broadcast(model)

    def finish(x: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.array(predict(tables.value, x), kind)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text"))
    return (rows.mapInArrow(_features(["doc_id", "held_out"], finish, pa.float64()), "doc_id long, held_out boolean, out double")
            .withColumnRenamed("out", "score"))
