"""N-gram Jaccard join with signature trees.

Texts are sets of distinct k-word shingles; two link when
``100 * |A & B| >= percent * |A | B|``. The join is complete:

1. **Profiles** (one pass over the texts): set size, a 128-bit fingerprint of
   the set, a token bitmap about as wide as the set, and the *prefix*:
   the ``n - ceil(percent * n / 100) + 1`` rarest shingles under one global
   order. Linked sets share a prefix shingle whatever the order is; rare ones
   first keeps the groups of a shared shingle small. The order takes the
   commonest shingles, counted over all texts, as last; only the first
   ``hot_limit`` of them are told apart, which bounds what is broadcast and
   touches speed only.
2. **Signature trees**: equal sets are one node (:mod:`berth.llm.similar`). Nodes meet
   under the shingles of their prefixes; shingles with the same nodes make one
   group. The nodes of a group bring their bitmaps. A few representatives are held
   against all others first; what they leave becomes trees whose nodes hold the OR of
   their bitmaps and ranges of set size and bit count. A dual traversal drops node
   pairs whose largest possible overlap is too small, or that are connected already,
   and feeds each batch of leaves to a union-find at once. Large groups are dealt into
   parts; only spanning edges leave a task.
3. **Verification**: the candidate components bring whole texts together, large ones in
   blocks. Exact set intersections decide; again only spanning edges leave.
4. Components of the verified edges, then the rows of each node.

Defined cases: a null text is empty; a text without words has size 0 and links
with nothing; fewer than k words make one shingle of the whole sequence;
documents with equal sets of size > 0 link; a null doc_id links with nothing and
has a null component; rows that repeat a doc_id are one document with several sets,
each of which links for itself, and count as connected (``one_per_component`` judges
each row by its own set); an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm import similar, wordhash
from berth.llm.common import Forest, chunks, stash
from berth.llm.similar import bitmap, width

#: Commonest shingles told apart in the global order (16 bytes each when broadcast).
HOT_LIMIT = 200_000
#: Shingles counted at least so often are worth ordering.
HOT_COUNT = 32
#: Members that are held against all others before trees are built.
REPRESENTATIVES = 3
_FAN = 8


def _counted(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, size = [], 0

        def fold(token, count):
            t = np.sort(np.concatenate(held))
            at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            c = np.diff(np.append(at, len(t)))
            t, c = t[at[c > 1]], c[c > 1]
            token, count = np.concatenate([token, t]), np.concatenate([count, c])
            if not len(token):
                return token, count
            order = np.argsort(token, kind="stable")
            token, count = token[order], count[order]
            at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            return token[at], np.add.reduceat(count, at)

        for part in parts:
            for _, raw, offsets in wordhash.batches(part.column("text")):
                held.append(wordhash.shingles(raw, offsets, k)[0])
                size += len(held[-1])
                if size > 1_000_000:
                    token, count = fold(token, count)
                    held, size = [], 0
        if size:
            token, count = fold(token, count)
        keep = count >= 4
        yield pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(count[keep])], ["token", "n"])
    return run


def hot_shingles(docs: DataFrame, k: int, limit: int = HOT_LIMIT) -> np.ndarray:
    """The commonest shingles, rarest of them first."""
    found = (docs.select("text").mapInArrow(_counted(k), "token long, n long")
             .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_COUNT)
             .orderBy(F.desc("n"), "token").limit(limit).collect())
    return np.array([r.token for r in reversed(found)], np.int64).view(np.uint64)


_PROFILE = "uid long, doc_id long, mark long, n long, f1 long, f2 long, bits binary, prefix binary"


def _profiled(k: int, percent: int, hot):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = hot.value
        order = np.argsort(late, kind="stable")
        ranked = late[order]
        maybe = np.zeros(1 << 22, bool)
        maybe[(late & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        for part in parts:
            for at, raw, offsets in wordhash.batches(part.column("text")):
                token, bounds = wordhash.shingles(raw, offsets, k)
                size, f1, f2, bits, prefix = [], [], [], [], []
                for i in range(len(bounds) - 1):
                    s = np.unique(token[bounds[i]:bounds[i + 1]])
                    n = len(s)
                    one, two = similar.fingerprint(s)
                    size.append(n)
                    f1.append(one)
                    f2.append(two)
                    bits.append(bitmap(s, width(n)).tobytes() if n else b"")
                    need = n - (percent * n + 99) // 100 + 1 if n else 0
                    common = np.flatnonzero(maybe[(s & np.uint64((1 << 22) - 1)).astype(np.int64)])
                    if len(common):
                        j = np.minimum(np.searchsorted(ranked, s[common]), len(ranked) - 1)
                        common, j = common[hit := ranked[j] == s[common]], j[hit]
                    if len(common):
                        rest = np.delete(s, common)
                        if len(rest) < need:
                            rest = np.concatenate([rest, s[common][np.argsort(order[j], kind="stable")]])
                        s = rest
                    prefix.append(s[:need].tobytes())
                rows = [*(part.column(c).slice(at, len(size)) for c in ("uid", "doc_id", "mark")), pa.array(size, pa.int64()),
                        pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(bits, pa.binary()), pa.array(prefix, pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, ["uid", "doc_id", "mark", "n", "f1", "f2", "bits", "prefix"])
    return run


def profiles(docs: DataFrame, k: int, percent: int) -> DataFrame:
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(docs.select(F.col("text").cast("binary").alias("text")), k))
    return similar.numbered(docs).mapInArrow(_profiled(k, percent, hot), _PROFILE)


# -- signature trees ---------------------------------------------------------

def _levels(bits: np.ndarray, size: np.ndarray) -> list[tuple]:
    """From single sets up: (OR of bitmaps, least size, most size, least bit count)."""
    pop = np.bitwise_count(bits).sum(1, dtype=np.int64)
    out = [(bits, size, size, pop)]
    while len(out[-1][0]) > 1:
        b, low, high, pop = out[-1]
        at = np.arange(0, len(b), _FAN)
        out.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at), np.minimum.reduceat(pop, at)))
    return out


def _possible(one, two, i, j, percent) -> np.ndarray:
    """Which node pairs may hold a link, by sizes and by the largest possible overlap."""
    (b1, l1, h1, p1), (b2, l2, h2, p2) = one, two
    ok = (percent * l1[i] <= 100 * h2[j]) & (percent * l2[j] <= 100 * h1[i])
    i, j, at = i[ok], j[ok], np.flatnonzero(ok)
    shared = np.empty(len(i), np.int64)
    for s in chunks(len(i), max(1, 4_000_000 // b1.shape[1])):
        shared[s] = np.bitwise_count(b1[i[s]] & b2[j[s]]).sum(1, dtype=np.int64)
    most = np.minimum(h1[i] - np.maximum(0, p1[i] - shared), h2[j] - np.maximum(0, p2[j] - shared))
    ok[at[most * (100 + percent) < percent * (l1[i] + l2[j])]] = False
    return ok


def _uniform(label: np.ndarray) -> list[np.ndarray]:
    """For each tree level: the label that all sets below a node have, or -1."""
    out = [label]
    while len(out[-1]) > 1:
        at = np.arange(0, len(out[-1]), _FAN)
        low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
        out.append(np.where(low == high, low, -1))
    return out


def dual_traversal(one: list, two: list | None, percent: int, labels: tuple | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of pairs of sets of two trees (of one tree, if ``two`` is None) that may link.
    ``labels`` (of both trees, by level) drops node pairs that are connected already."""
    same, two = two is None, two or one
    top = max(len(one), len(two)) - 1
    todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, i, j = todo.pop()
        a, b = min(level, len(one) - 1), min(level, len(two) - 1)
        if labels is not None:
            left, right = labels[0][a][i], labels[1][b][j]
            apart = (left != right) | (left < 0)
            i, j = i[apart], j[apart]
        ok = _possible(one[a], two[b], i, j, percent)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        down_a, down_b = min(level - 1, len(one) - 1), min(level - 1, len(two) - 1)
        step_a, step_b = (_FAN if down_a < a else 1), (_FAN if down_b < b else 1)
        for s in chunks(len(i), 4096):
            x = (i[s, None] * step_a + np.arange(step_a)).repeat(step_b, 1).ravel()
            y = np.tile(j[s, None] * step_b + np.arange(step_b), (1, step_a)).ravel()
            keep = (x < len(one[down_a][0])) & (y < len(two[down_b][0]))
            if same:
                keep &= (x <= y) if level > 1 else (x < y)
            todo.append((level - 1, x[keep], y[keep]))


class Bitmaps:
    """Bitmaps of many sets, one matrix for each width."""

    def __init__(self, bits: list):
        self.width = np.array([len(b) for b in bits], np.int64)
        self.row = np.zeros(len(bits), np.int64)
        self.rows = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.row[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join(bits[i] for i in at.tolist()), np.uint8).reshape(len(at), w)

    def at(self, members: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of members of ``width`` or twice that, folded to ``width``."""
        own = self.width[members]
        out = np.empty((len(members), width), np.uint8)
        out[own == width] = self.rows.get(width, out[:0])[self.row[members[own == width]]]
        if (own == 2 * width).any():
            wide = self.rows[2 * width][self.row[members[own == 2 * width]]]
            out[own == 2 * width] = wide[:, :width] | wide[:, width:]
        return out


def pairs_possible(x: np.ndarray, y: np.ndarray, size: np.ndarray, maps: Bitmaps, percent: int) -> np.ndarray:
    """Which pairs of sets may link, by sizes and bitmaps."""
    ok = (percent * size[x] <= 100 * size[y]) & (percent * size[y] <= 100 * size[x])
    least = np.minimum(maps.width[x], maps.width[y])
    for w in np.unique(least[ok]).tolist():
        for s in chunks(len(at := np.flatnonzero(ok & (least == w))), max(1, 16_000_000 // w)):
            i, j = x[at[s]], y[at[s]]
            b1, b2 = maps.at(i, w), maps.at(j, w)
            level = lambda b, n: (b, n, n, np.bitwise_count(b).sum(1, dtype=np.int64))
            each = np.arange(len(i))
            ok[at[s]] = _possible(level(b1, size[i]), level(b2, size[j]), each, each, percent)
    return ok


class Trees(similar.Comparer):
    """Which nodes may link, by their bitmaps."""

    def __init__(self, rows: pd.DataFrame, percent: int):
        self.percent = percent
        self.size = rows["n"].to_numpy(np.int64)
        self.maps = Bitmaps([bytes(b) for b in rows["bits"]])

    def test(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return pairs_possible(x, y, self.size, self.maps, self.percent)

    def inside(self, members: np.ndarray, forest: Forest) -> None:
        self.across(members, members, forest)

    def across(self, one: np.ndarray, two: np.ndarray, forest: Forest) -> None:
        """Representatives first, then trees for each bitmap width: those of one width, and of
        neighbouring widths after folding the wider one. Linked sets differ less than twofold
        in size, so their widths are equal or neighbours."""
        same = one is two
        for x in np.unique(two[np.linspace(0, len(two) - 1, REPRESENTATIVES).astype(int)]).tolist() if len(two) else []:
            far = one[[forest.find(i) != forest.find(x) for i in one.tolist()]]
            near = far[self.test(far, np.full(len(far), x))]
            forest.join_all(near, np.full(len(near), x))
        for w in np.unique(self.maps.width[one]).tolist():
            here = self._tree(one, w, w, forest)
            if same:
                self._meet(here, None, forest)
            else:
                self._meet(here, self._tree(two, w, w, forest), forest)
                self._meet(here, self._tree(two, w // 2, w // 2, forest), forest, fold=True)
            self._meet(here, self._tree(two, 2 * w, w, forest), forest)

    def _tree(self, members: np.ndarray, own: int, shown: int, forest: Forest):
        at = members[self.maps.width[members] == own]
        if not len(at):
            return None
        at = at[np.argsort(self.size[at], kind="stable")]
        label = np.array([forest.find(i) for i in at.tolist()], np.int64)
        return at, _levels(self.maps.at(at, shown), self.size[at]), _uniform(label)

    def _meet(self, one, two, forest: Forest, fold: bool = False) -> None:
        if one is None or (two is None and len(one[0]) < 2):
            return
        if fold:
            if two is None:
                return
            at = one[0]
            one = (at, _levels(self.maps.at(at, two[1][0][0].shape[1]), self.size[at]), one[2])
        (a, tree, label), (b, other, others) = one, two or one
        for i, j in dual_traversal(tree, None if two is None else other, self.percent, (label, others)):
            forest.join_all(a[i], b[j])
            label[0][:] = [forest.find(x) for x in a.tolist()]  # seen by the next batch of leaves
            others[0][:] = [forest.find(x) for x in b.tolist()]


def candidates(nodes: similar.Nodes, percent: int) -> DataFrame:
    """Spanning edges between nodes that their signature trees can't tell apart."""
    groups = similar.sharing_groups(nodes.heads, "prefix", percent)
    return similar.linked(groups, nodes.heads.select("uid", "n", "bits"), lambda rows: Trees(rows, percent), similar.PACK_ROWS)


def _links(docs: DataFrame, k: int, percent: int) -> tuple[similar.Nodes, DataFrame]:
    nodes = similar.Nodes(stash(profiles(docs, k, percent)), ("bits", "prefix"))
    return nodes, similar.exact_links(docs, nodes, candidates(nodes, percent), k, percent)


def one_per_component(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of linked sets does; texts without
    words and rows without doc_id stay."""
    nodes, links = _links(docs, k, percent)
    return similar.first_of_each(docs, nodes, links)


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``."""
    nodes, links = _links(docs, k, percent)
    return similar.document_components(nodes, links)
