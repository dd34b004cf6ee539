"""Context-tree weighting over bytes.

A text's symbols are the bytes of its lower-cased (A-Z) words joined by one
blank, then one end symbol (a line feed, which no word holds); before the first
symbol stand ``depth`` end symbols. Each byte is eight binary decisions; each of
the 255 decision nodes has a context tree over the bytes before. Every node
estimates by Krichevsky-Trofimov, and the weighting mixes a node with its
children at all depths, bottom up from the counts of the whole training corpus;
scoring uses the frozen posterior weights.

Every context seen in training is a node. A decision that a context has not met has
probability 1/2 there and below, so only (context, decision) pairs that occur are kept,
and a context that no training text holds is one whose counts are 0: the symbols and
contexts (*grams*) of the texts that do not train take part with a count of 0, and the
tree gives the log probability of every gram of the table.

Counting is one pass (n-gram counts and word counts, reduced in each task before they are
shuffled). The tree is solved in tasks: a task has whole contexts of ``CUT`` bytes with all
that is below them, works up from their grams, and sends its sums to the contexts one byte
shorter (``256 ** (CUT - 1)`` at most, whatever the corpus), which the driver solves and
broadcasts; a second pass of the same tasks goes down. Grams and words: the ``HOT_GRAMS``
and ``HOT_WORDS`` commonest are broadcast, the others meet the tree and the vocabulary in a
join of what is left, so neither is held whole.

Defined cases: a null text is empty, its only token is the end; a null doc_id
counts as an empty id; repeated rows count and score one by one; without
training rows every bit has probability 1/2; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.llm.common import chunks, stash

DEPTH = 5
#: Contexts of so many bytes are solved whole in a task, shorter ones on the driver.
CUT = 3
#: Commonest words and grams broadcast with their values; the others are joined.
HOT_WORDS, HOT_GRAMS = 200_000, 2_000_000
_END = b"\n"
_BATCH = 1_000_000
_NODES = 2_048
#: Grams that are worked on at a time, and one context of ``CUT`` bytes more.
_GRAMS = 400_000
_SMALL = 1 << 16


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


class Windows:
    """Symbols of a run of texts, each behind ``depth`` end symbols."""

    def __init__(self, texts: list[bytes], depth: int):
        pad = _END * depth
        self.depth = depth
        self.symbols = np.frombuffer(b"".join([pad + t + _END for t in texts]), np.uint8)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + depth)[:-1]])
        self.real = np.ones(len(self.symbols), bool)
        for d in range(depth):
            self.real[self.starts + d] = False

    def back(self, k: int) -> np.ndarray:
        """The symbol k places before each place from ``depth`` on."""
        return self.symbols[self.depth - k:len(self.symbols) - k]

    def codes(self) -> np.ndarray:
        """The gram of each real place: the context, nearest byte first, then the symbol."""
        out = self.back(0).astype(np.int64)
        for k in range(1, self.depth + 1):
            out |= self.back(k).astype(np.int64) << (8 * (self.depth + 1 - k))
        return out[self.real[self.depth:]]


def _texts(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes], list[list[bytes]]]]:
    """Runs of about ``_BATCH`` bytes: other columns' values, normalised texts, words."""
    for part in parts:
        names = [n for n in part.schema.names if n != "text"]
        others = list(zip(*(part.column(n).to_pylist() for n in names))) if names else [()] * part.num_rows
        rows, texts, words, size = [], [], [], 0
        for other, text in zip(others, part.column("text")):
            found = tokens(text.as_py())
            rows.append(other)
            words.append(found)
            texts.append(b" ".join(found))
            size += len(texts[-1])
            if size >= _BATCH:
                yield rows, texts, words
                rows, texts, words, size = [], [], [], 0
        if rows:
            yield rows, texts, words


def _merge(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal sorted keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _counted(depth: int):
    """``held_out, text`` to training counts: (gram) by gram, 0 for those that only other
    texts hold, (word) by word, and ends."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        key, n, ends = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        held: dict[bool, list[np.ndarray]] = {False: [], True: []}

        def fold(key, n):
            keys, counts = [key], [n]
            for out, codes in held.items():
                grams = np.sort(np.concatenate([np.zeros(0, np.int64), *codes]))
                at = _runs(grams)
                keys.append(grams[at])
                counts.append(np.zeros(len(at), np.int64) if out else np.diff(np.append(at, len(grams))))
                codes.clear()
            return _merge(np.concatenate(keys), np.concatenate(counts))

        def spill(words, key, n):
            names = ["gram", "word", "n"]
            for s in range(0, len(key), 100_000):
                k = key[s:s + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.nulls(len(k), pa.binary()), pa.array(n[s:s + 100_000])], names)
            some = list(words.items())
            for s in range(0, len(some), 100_000):
                w = some[s:s + 100_000]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(w), pa.int64()), pa.array([x[0] for x in w], pa.binary()),
                                                  pa.array([x[1] for x in w], pa.int64())], names)

        for rows, texts, found in _texts(parts):
            for out in (False, True):
                mine = [t for t, r in zip(texts, rows) if bool(r[0]) == out]
                if mine:
                    held[out].append(Windows(mine, depth).codes())
                    ends += 0 if out else len(mine)
            for w, r in zip(found, rows):
                if not r[0]:
                    words.update(w)
            if sum(len(c) for codes in held.values() for c in codes) > 4 * _BATCH:
                key, n = fold(key, n)
            if len(words) > 250_000 or len(key) > 2_000_000:
                yield from spill(words, key, n)
                words.clear()
                key, n = key[:0], n[:0]
        key, n = fold(key, n)
        yield from spill(words, key, n)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([ends], pa.int64())], ["gram", "word", "n"])
    return run


# -- the weighted tree -------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + 8.0
    up = np.ones_like(z)
    for i in range(8):
        up = up * (x + i)
    r = 1.0 / (z * z)
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r / 1260)) / z - np.log(up)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability (natural) of n0 zeros and n1 ones under the KT estimator."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Estimated probability of a one."""
    return (n1 + 0.5) / (n0 + n1 + 1.0)


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of 256 symbols to zeros and ones of the 255 decision nodes, root first."""
    zeros, ones, level = [], [], counts
    while level.shape[1] > 1:
        pair = level.reshape(len(level), -1, 2)
        zeros.append(pair[:, :, 0])
        ones.append(pair[:, :, 1])
        level = pair.sum(2)
    return np.concatenate(zeros[::-1], 1), np.concatenate(ones[::-1], 1)


def symbol_logs(p1: np.ndarray) -> np.ndarray:
    """Log10 probability of the 256 symbols from P(one) of the 255 decision nodes."""
    out, at, width = np.zeros((len(p1), 1)), 0, 1
    while width < 256:
        p = p1[:, at:at + width]
        both = np.stack([np.log10(1.0 - p), np.log10(p)], 2).reshape(len(p1), -1)
        out = out.repeat(2, 1) + both
        at, width = at + width, width * 2
    return out


def solve(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], depth: int) -> dict:
    """The frozen tree of a few given contexts, all symbols of a node at once (the form that
    tests hold against; tables take :func:`gram_logs`). ``levels[d] = (contexts, row, symbol,
    count)``: the contexts of depth d that are nodes, and their symbol counts; what a node's
    own children leave over is one pooled child.

    Returns ``child`` (node by column of the context byte), ``column`` (byte to
    column) and ``logs`` (node by symbol, log10).
    """
    order, parents, counts = [], [], []
    for d in range(depth + 1):
        contexts = np.sort(levels[d][0])
        order.append(contexts)
        own = np.zeros((len(contexts), 256))
        if len(contexts):
            np.add.at(own, (np.searchsorted(contexts, levels[d][1]), levels[d][2]), levels[d][3])
        counts.append(own)
        parents.append(np.searchsorted(order[d - 1], contexts & np.uint64((1 << (8 * (d - 1))) - 1)) if d else np.zeros(len(contexts), np.int64))
    # only weights and the pool's estimates are kept, in single precision; a few
    # thousand nodes at a time are worked on
    weight = [np.ones((len(o), 255), np.float32) for o in order]
    pool = [np.zeros((len(o), 255), np.float32) for o in order]
    below, taken, inner = None, None, None
    for d in range(depth, -1, -1):
        size = len(order[d - 1]) if d else 0
        above, held = np.zeros((size, 255)), np.zeros((size, 256))
        for s in chunks(len(order[d]), _NODES):
            total = log_kt(*bit_counts(counts[d][s]))
            if below is not None and inner[s].any():
                at = np.flatnonzero(inner[s]) + s.start
                rest = bit_counts(np.maximum(counts[d][at] - taken[at], 0))
                pool[d][at] = kt(*rest)
                own = total[at - s.start]
                mixed = np.logaddexp(own, below[at] + log_kt(*rest)) - np.log(2)
                weight[d][at] = np.exp(np.minimum(own - np.log(2) - mixed, 0))
                total[at - s.start] = mixed
            if d:
                np.add.at(above, parents[d][s], total)
                np.add.at(held, parents[d][s], counts[d][s])
        inner = np.bincount(parents[d], minlength=size) > 0 if d else None
        below, taken = above, held
    below = taken = above = held = None
    nodes = sum(len(o) for o in order)
    logs, at, first, rest = np.zeros((nodes, 256), np.float32), 0, None, None
    for d in range(depth + 1):
        now, left = np.zeros_like(weight[d]), np.zeros_like(weight[d])
        for s in chunks(len(order[d]), _NODES):
            before = first[parents[d][s]] if d else 0.0
            over = rest[parents[d][s]] if d else 1.0
            now[s] = before + over * weight[d][s] * kt(*bit_counts(counts[d][s]))
            left[s] = over * (1.0 - weight[d][s])
            logs[at:at + s.stop - s.start] = symbol_logs(np.clip((now[s] + left[s] * pool[d][s]).astype(np.float64), 1e-12, 1 - 1e-12))
            at += s.stop - s.start
        first, rest = now, left
    base = np.cumsum([0] + [len(o) for o in order])
    used = np.unique(np.concatenate([(o >> np.uint64(8 * (d - 1))).astype(np.int64) for d, o in enumerate(order) if d] or [np.zeros(0, np.int64)]))
    column = np.zeros(256, np.int32)
    column[used] = np.arange(1, len(used) + 1)
    dead = int(base[-1])
    child = np.full((dead + 1, len(used) + 1), dead, np.int32)
    for d in range(1, depth + 1):
        byte = (order[d] >> np.uint64(8 * (d - 1))).astype(np.int64)
        child[base[d - 1] + parents[d], column[byte]] = base[d] + np.arange(len(order[d]))
    return {"child": child, "column": column, "logs": logs, "depth": depth}


_HALF, _ONE = (log_gamma(np.arange(_SMALL) + x) for x in (0.5, 1.0))


def count_logs(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """:func:`log_kt` of whole numbers, small ones from a table."""
    last = _SMALL - 1
    out = _HALF[np.minimum(n0, last)] + _HALF[np.minimum(n1, last)] - _ONE[np.minimum(n0 + n1, last)] - np.log(np.pi)
    big = np.flatnonzero(n0 + n1 > last)
    out[big] = log_kt(n0[big].astype(np.float64), n1[big].astype(np.float64))
    return out


def _shorter(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (context, decision) one byte shorter, sorted, and where each key's is."""
    return np.unique(key >> 16 << 8 | key & 255, return_inverse=True)


def _sums(to: np.ndarray, size: int, *values: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(to, v, size).astype(v.dtype) for v in values]


def _mixed(n0: np.ndarray, n1: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of inner pairs, and the posterior weight of their own estimate."""
    own = count_logs(n0, n1)
    mixed = np.logaddexp(own, below) - np.log(2)
    return mixed, np.exp(np.minimum(own - np.log(2) - mixed, 0.0))


def _up(gram: np.ndarray, n: np.ndarray, level: int, depth: int, cut: int) -> tuple[np.ndarray, np.ndarray, list]:
    """One of the eight decisions of sorted grams that hold whole contexts of ``cut`` bytes:
    the pairs at ``cut``, their weighted log probabilities, and for each depth from the
    deepest (where each item below has its pair, zeros, ones, weight)."""
    symbol = gram & 255
    key = gram >> 8 << 8 | (256 | symbol) >> (8 - level)
    at = _runs(key)
    to = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(key))))
    n1 = np.add.reduceat(np.where(symbol >> (7 - level) & 1, n, 0), at)
    n0 = np.add.reduceat(n, at) - n1
    key, logs = key[at], count_logs(n0, n1)
    steps = [(to, n0, n1, np.ones(len(key)))]
    for _ in range(depth - cut):
        key, to = _shorter(key)
        n0, n1, below = _sums(to, len(key), n0, n1, logs)
        logs, weight = _mixed(n0, n1, below)
        steps.append((to, n0, n1, weight))
    return key, logs, steps


def _down(before, over, steps: list) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one given by the pairs down to the last step, and what is left of the weight."""
    for to, n0, n1, weight in reversed(steps):
        now, left = before + over * weight * kt(n0, n1), over * (1.0 - weight)
        before, over = now[to], left[to]
    return before, over


def _top(node: np.ndarray, below: np.ndarray, n0: np.ndarray, n1: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of ``depth`` bytes, sorted, with :func:`_down`'s values of all pairs above and of themselves."""
    order = np.argsort(node)
    key, below, n0, n1 = node[order], below[order], n0[order], n1[order]
    to, steps, pairs = np.arange(len(key)), [], key
    for d in range(depth, -1, -1):
        logs, weight = _mixed(n0, n1, below)
        steps.append((to, n0, n1, weight))
        if d:
            pairs, to = _shorter(pairs)
            n0, n1, below = _sums(to, len(pairs), n0, n1, logs)
    return key, *_down(0.0, 1.0, steps)


def _whole(parts: Iterator[pa.RecordBatch], shift: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted ``gram, n`` in pieces that hold whole contexts (the bits above ``shift``)."""
    grams, counts, held, limit = [], [], 0, size
    for part in parts:
        grams.append(part.column("gram").to_numpy())
        counts.append(part.column("n").to_numpy())
        held += part.num_rows
        if held >= limit:
            gram, n = np.concatenate(grams), np.concatenate(counts)
            end = int(np.searchsorted(gram, gram[-1] >> shift << shift))
            if end:
                yield gram[:end], n[:end]
            grams, counts, held = [gram[end:]], [n[end:]], len(gram) - end
            limit = max(size, 2 * held)
    if held:
        yield np.concatenate(grams), np.concatenate(counts)


def _sent_up(depth: int, cut: int, size: int):
    """Grams to the sums that the contexts of ``cut - 1`` bytes get from those below."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _whole(parts, 8 * (depth + 1 - cut), size):
            for level in range(8):
                key, logs, steps = _up(gram, n, level, depth, cut)
                node, to = _shorter(key)
                n0, n1, below = _sums(to, len(node), steps[-1][1], steps[-1][2], logs)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(below), pa.array(n0), pa.array(n1)], ["node", "below", "n0", "n1"])
    return run


def _logs(depth: int, cut: int, size: int, top):
    """Grams to their log10 probabilities."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, before, over = top.value
        for gram, n in _whole(parts, 8 * (depth + 1 - cut), size):
            logs = np.zeros(len(gram))
            for level in range(8):
                key, _, steps = _up(gram, n, level, depth, cut)
                at = np.searchsorted(node, key >> 16 << 8 | key & 255)
                one, _ = _down(before[at], over[at], steps)
                logs += np.log10(np.where(gram >> (7 - level) & 1, one, 1.0 - one))
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n), pa.array(logs)], ["gram", "n", "log"])
    return run


def _gathered(df: DataFrame) -> list[np.ndarray]:
    """The columns (longs and doubles) of a bounded frame, packed in the tasks."""
    names, kinds = df.columns, [np.float64 if t == "double" else np.int64 for _, t in df.dtypes]

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cells = [part.column(c).to_numpy(zero_copy_only=False).tobytes() for c in names]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names)

    rows = df.mapInArrow(pack, ", ".join(f"{c} binary" for c in names)).collect()
    return [np.concatenate([np.zeros(0, k), *(np.frombuffer(r[c], k) for r in rows)]) for c, k in zip(names, kinds)]


def gram_logs(grams: DataFrame, depth: int) -> DataFrame:
    """``gram, n, log`` (log10 probability of the symbol behind its context) of all ``grams(gram, n)``."""
    cut = min(CUT, depth)
    dealt = grams.repartition(F.shiftright("gram", 8 * (depth + 1 - cut))).sortWithinPartitions("gram")
    sent = dealt.mapInArrow(_sent_up(depth, cut, _GRAMS), "node long, below double, n0 long, n1 long")
    sums = sent.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("below", "n0", "n1")))
    top = grams.sparkSession.sparkContext.broadcast(_top(*_gathered(sums), cut - 1))
    return dealt.mapInArrow(_logs(depth, cut, _GRAMS, top), "gram long, n long, log double")


def _hot_count(grams: DataFrame) -> int:
    """The least count of the grams that are broadcast: ``HOT_GRAMS`` at most."""
    step = F.floor(8 * F.log2("n"))
    steps = grams.where("n > 0").groupBy(step.alias("step")).agg(F.count("*").alias("grams"), F.min("n").alias("least")).collect()
    least, held = (1 << 63) - 1, 0
    for r in sorted(steps, key=lambda r: -r.step):
        held += r.grams
        if held > HOT_GRAMS:
            break
        least = r.least
    return least


def _common(words: DataFrame) -> dict[bytes, int]:
    """The commonest words and their counts, packed in the task."""
    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:  # words hold no white space
            n = part.column("n").to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([_END.join(part.column("word").to_pylist())], pa.binary()), pa.array([n], pa.binary())], ["word", "n"])

    top = words.orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word", "n")
    out: dict[bytes, int] = {}
    for r in top.mapInArrow(pack, "word binary, n binary").collect():
        out.update(zip(bytes(r.word).split(_END), np.frombuffer(r.n, np.int64).tolist()))
    return out if out and next(iter(out)) else {}


# -- scoring -----------------------------------------------------------------

_SCORED = ("doc_id long, held_out boolean, n_tokens long, hot_known long, hot_sum double, hot_score double, "
           "rare array<struct<word:binary,n:long>>, far array<struct<gram:long,n:long>>")


def _text_logs(texts: list[bytes], depth: int, grams: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Of each normalised text, its end included: the sum over its hot grams, and the others with their numbers."""
    codes = Windows(texts, depth).codes()
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    order = np.argsort(codes)
    ordered = codes[order]
    at = _runs(ordered)
    own = ordered[at]
    to = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(ordered))))
    place = np.minimum(np.searchsorted(grams, own), max(len(grams) - 1, 0))
    hot = grams[place] == own if len(grams) else np.zeros(len(own), bool)
    value = np.zeros(len(own))
    value[hot] = logs[place[hot]]
    each = np.empty(len(codes))
    each[order] = value[to]
    rest = np.flatnonzero(~hot[to])
    gram, text = ordered[rest], np.searchsorted(starts, order[rest], "right") - 1
    by = np.lexsort((gram, text))
    gram, text = gram[by], text[by]
    first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])])) if len(gram) else np.zeros(0, np.int64)
    far = pa.StructArray.from_arrays([pa.array(gram[first]), pa.array(np.diff(np.append(first, len(gram))))], ["gram", "n"])
    offsets = np.searchsorted(text[first], np.arange(len(texts) + 1))
    return np.add.reduceat(each, starts[:-1]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), far)


def _scored(depth, model, hot):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (grams, gram_values), logs = model.value, hot.value
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for rows, texts, words in _texts(parts):
            known, sums, rare = [], [], []
            for found in words:
                near = [x for x in map(logs.get, found) if x is not None]
                known.append(len(near))
                sums.append(float(sum(near)))
                far = Counter(w for w in found if w not in logs) if len(near) < len(found) else {}
                rare.append([{"word": w, "n": n} for w, n in far.items()])
            hot_score, others = _text_logs(texts, depth, grams, gram_values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
                 pa.array([len(f) + 1 for f in words], pa.int64()), pa.array(known, pa.int64()),
                 pa.array(sums, pa.float64()), pa.array(hot_score), pa.array(rare, kind), others],
                ["doc_id", "held_out", "n_tokens", "hot_known", "hot_sum", "hot_score", "rare", "far"])
    return run


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every
    row of ``docs(doc_id, text)``; rows that are not held out train."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text"))
    raw = rows.select("held_out", "text").mapInArrow(_counted(depth), "gram long, word binary, n long")
    counted = stash(raw.groupBy("gram", "word").agg(F.sum("n").alias("n")))
    grams = counted.where("gram is not null").select("gram", "n")
    words = counted.where("word is not null").select("word", "n")
    ends = int(counted.where("gram is null and word is null").agg(F.sum("n")).first()[0] or 0)
    held, distinct = words.agg(F.sum("n"), F.count("*")).first()
    n_train, vocabulary = int(held or 0) + ends, int(distinct) + (1 if ends else 0)
    tree = stash(gram_logs(grams, depth))
    least = _hot_count(tree)
    common, values = _gathered(tree.where(F.col("n") >= least).select("gram", "log"))
    order = np.argsort(common)
    model = sc.broadcast((common[order], values[order]))
    hot = sc.broadcast({w: math.log10(n + 1.0) for w, n in _common(words).items()})
    told = stash(rows.mapInArrow(_scored(depth, model, hot), _SCORED).withColumn("row", F.monotonically_increasing_id()))
    rare = told.select("row", F.explode("rare").alias("e")).select("row", "e.word", F.col("e.n").alias("times"))
    rare = (rare.join(words, "word").groupBy("row")
            .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_sum")))
    far = told.select("row", F.explode("far").alias("e")).select("row", "e.gram", F.col("e.n").alias("times"))
    far = far.join(tree.where(F.col("n") < least).select("gram", "log"), "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("far_score"))
    known = F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(1 if ends else 0)
    sums = F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.log10(F.lit(float(ends)) + 1.0)
    return told.join(rare, "row", "left").join(far, "row", "left").select(
        "doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (sums - F.col("n_tokens") * F.log10(F.lit(float(n_train + vocabulary + 1)))).alias("base_score"),
        (F.col("hot_score") + F.coalesce("far_score", F.lit(0.0))).alias("score"))
