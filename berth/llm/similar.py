"""Sets of shingles that may be similar: sharing groups, bounded comparison tasks and
exact links, shared by the joins that look for near duplicates.

A *node* is one distinct set, named by the row number ``uid`` that its first row got when
the profiles were written; documents meet their node by the set's size and 128-bit
fingerprint, and doc_ids come in last. Groups of nodes that share something
(:func:`sharing_groups`) are compared by :func:`linked`, which holds no more than
``limit`` of a group in one task:

* small groups are packed together;
* a larger group is dealt into parts by the hash of its nodes. Every part is compared
  inside itself and with a few representatives of the whole group; what is then connected
  to the group's largest component is done with, and only the rest meets all parts, block
  by block. Tasks return spanning edges of what they connect, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm import wordhash
from berth.llm.common import Forest, chunks, components, stash, unused

#: Entries of shared tokens gathered by one grouping task, on average.
BUCKET_ENTRIES = 1_500_000
#: A token with more entries than this is a group of its own and never gathered.
HEAVY_ENTRIES = 200_000
#: Heavy tokens told apart, the commonest first (8 bytes each when broadcast); further
#: ones are gathered in their bucket like all others.
HEAVY_LIMIT = 100_000
#: Rows of sharing groups that one task compares.
PACK_ROWS = 100_000
#: Bytes of text that one verification task holds.
BLOCK_BYTES = 12_000_000
#: Groups up to this size are compared pair by pair, many groups at once.
SMALL_GROUP = 48
#: Representatives of a large group.
PIVOTS = 4

Pairs = Callable[[np.ndarray, np.ndarray], np.ndarray]


# -- documents and nodes -----------------------------------------------------

def numbered(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, mark, text``: rows numbered once (write the result of a first pass before
    using ``uid`` again); ``mark`` is a hash of the text that finds a node's row again."""
    text = F.col("text").cast("binary")
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of distinct tokens."""
    if not len(tokens):
        return 0, 0
    other = wordhash.mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    return int(tokens.sum(dtype=np.uint64).view(np.int64)), int(other.sum(dtype=np.uint64).view(np.int64))


class Nodes:
    """Nodes of written profiles ``told(uid, doc_id, mark, n, f1, f2, ...)``."""

    KEY = ("n", "f1", "f2")

    def __init__(self, told: DataFrame, extra: tuple[str, ...]):
        self.told = told
        self.real = told.where("n > 0 and doc_id is not null")
        self.equal = stash(self.real.groupBy(*self.KEY).agg(F.min("uid").alias("head"), F.min("doc_id").alias("least")))
        self.heads = stash(self.real.join(self.equal.select(F.col("head").alias("uid")), "uid")
                           .select("uid", "doc_id", "mark", "n", *extra))
        repeated = self.real.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
        self.repeated = stash(repeated)
        self.has_repeats = self.repeated.head(1) != []

    def same_document(self) -> DataFrame:
        """Edges between the nodes of rows that repeat a doc_id."""
        own = self.real.join(self.repeated, "doc_id").join(self.equal, list(self.KEY)).select("doc_id", "head").distinct()
        own = stash(own)
        least = own.groupBy("doc_id").agg(F.min("head").alias("b"))
        return own.join(least, "doc_id").where("head <> b").select(F.col("head").alias("a"), "b")

    def texts(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """The text of each node in ``wanted(uid, gid)``, with its weight."""
        keys = wanted.join(self.heads.select("uid", "doc_id", "mark"), "uid")
        found = numbered(docs).drop("uid").join(keys, ["doc_id", "mark"])
        if self.has_repeats:
            found = found.dropDuplicates(["uid"])
        return stash(found.select("gid", "uid", "text", F.octet_length("text").cast("long").alias("w")))

    def labelled(self, edges: DataFrame) -> DataFrame:
        """``(n, f1, f2, top, component_id)``: for each node its component, and the smallest doc_id of that."""
        tied = self.equal.join(components(edges), F.col("head") == F.col("id"), "left").select(
            *self.KEY, "least", F.coalesce("component", "head").alias("top"))
        tied = stash(tied)
        least = stash(tied.groupBy("top").agg(F.min("least").alias("component_id")))
        return tied.join(least, "top").select(*self.KEY, "top", "component_id")


def exact_links(docs: DataFrame, nodes: Nodes, candidates: DataFrame, k: int, percent: int) -> DataFrame:
    """Spanning edges of the exact links inside the components of ``candidates(a, b)``."""
    near = components(candidates)
    tops = near.select(F.col("component").alias("id"), "component").distinct()
    member = stash(near.unionByName(tops)).select(F.col("id").alias("uid"), F.col("component").alias("gid"))
    return stash(linked(nodes.texts(docs, member), ("text",), exact(k, percent), BLOCK_BYTES))


def document_components(nodes: Nodes, links: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of the profiles."""
    if nodes.has_repeats:
        links = links.unionByName(nodes.same_document())
    top = nodes.labelled(links).select(*Nodes.KEY, "component_id")
    return (nodes.told.join(top, list(Nodes.KEY), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def first_of_each(docs: DataFrame, nodes: Nodes, links: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each group of linked sets does: the one
    of the smallest doc_id (then the smallest mark). Rows without words or doc_id stay."""
    top = nodes.labelled(links).select(*Nodes.KEY, F.col("top").alias("c"))
    tied = stash(nodes.real.select("doc_id", "mark", *Nodes.KEY).distinct()
                 .join(top, list(Nodes.KEY)).select("doc_id", "mark", "c"))
    best = stash(tied.groupBy("c").agg(F.min(F.struct("doc_id", "mark")).alias("best")))
    losers = tied.join(best, "c").where(F.struct("doc_id", "mark") != F.col("best")).select("doc_id", "mark").distinct()
    doc_id, mark = unused(docs, "doc_id_"), unused(docs, "mark_")
    marked = docs.withColumn(mark, F.xxhash64(docs["text"].cast("binary")))
    losers = losers.select(F.col("doc_id").alias(doc_id), F.col("mark").alias("other"))
    kept = marked.join(losers, (marked["doc_id"] == losers[doc_id]) & (marked[mark] == losers["other"]), "left_anti")
    if nodes.has_repeats:
        bare = nodes.real.join(nodes.repeated, "doc_id").select(F.col("doc_id").alias(doc_id), F.col("mark").alias("other")).distinct()
        twice = (kept["doc_id"] == bare[doc_id]) & (kept[mark] == bare["other"])
        again = kept.join(bare, twice, "left_semi").dropDuplicates(["doc_id", mark])
        kept = kept.join(bare, twice, "left_anti").unionByName(again)
    return kept.drop(mark)


# -- groups that share a token ----------------------------------------------

def _local_counts(column: str, least: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= least
            return pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(count[keep].astype(np.int64))], ["token", "rows"])

        for part in parts:
            for tokens in part.column(column):
                held.append(np.frombuffer(tokens.as_py(), np.uint64))
                size += len(held[-1])
            if size > 4_000_000:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()
    return run


def heavy_tokens(heads: DataFrame, column: str) -> np.ndarray:
    """Tokens that at least about ``HEAVY_ENTRIES`` sets hold, in order."""
    found = (heads.select(column).mapInArrow(_local_counts(column, 4 if HEAVY_ENTRIES >= 100 else 1), "token long, rows long")
             .groupBy("token").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= HEAVY_ENTRIES)
             .orderBy(F.desc("rows"), "token").limit(HEAVY_LIMIT).collect())
    return np.sort(np.array([r.token for r in found], np.int64).view(np.uint64))


_ENTRIES = "bucket int, token binary, node binary, n binary"


def _entries(column: str, buckets: int, heavy):
    """Token lists to (bucket of tokens, packed token, node, set size); heavy tokens go to
    bucket -1, which is dealt anew."""
    def flush(rows: list):
        if not rows:
            return
        tokens = [np.frombuffer(r[2], np.uint64) for r in rows]
        times = [len(p) for p in tokens]
        token = np.concatenate(tokens)
        node, size = np.repeat(np.array([r[0] for r in rows], np.int64), times), np.repeat(np.array([r[1] for r in rows], np.int32), times)
        bucket = (wordhash.mix(token) % np.uint64(buckets)).astype(np.int64)
        if len(heavy.value):
            at = np.minimum(np.searchsorted(heavy.value, token), len(heavy.value) - 1)
            bucket[heavy.value[at] == token] = -1
        order = np.argsort(bucket, kind="stable")
        token, node, size, bucket = token[order], node[order], size[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-2))
        ends = [*cuts[1:].tolist(), len(bucket)]
        for s in chunks(len(cuts), 256):
            spans = list(zip(cuts[s].tolist(), ends[s]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[s]], pa.int32()), *(pa.array([x[a:e].tobytes() for a, e in spans], pa.binary()) for x in (token, node, size))],
                ["bucket", "token", "node", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        held = 0
        for part in parts:
            found = list(zip(*(part.column(c).to_pylist() for c in ("uid", "n", column))))
            rows += found
            held += sum(len(r[2]) for r in found)
            if held > 16_000_000:
                yield from flush(rows)
                rows, held = [], 0
        yield from flush(rows)
    return run


def _sharing(percent: int):
    """One bucket's groups of nodes that share a token: (gid, uid). Tokens with the same
    nodes make one group; its id depends on them alone."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        token = np.frombuffer(b"".join(group["token"]), np.uint64)
        node, size = np.frombuffer(b"".join(group["node"]), np.int64), np.frombuffer(b"".join(group["n"]), np.int32).astype(np.int64)
        order = np.lexsort((node, token))
        token, node, size = token[order], node[order], size[order]
        at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(at, len(token)))
        gid = np.add.reduceat(wordhash.mix(node.astype(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)), at)
        many = count > 1
        many[many] = percent * np.maximum.reduceat(size, at)[many] <= 100 * np.minimum.reduceat(size, at)[many] * np.where(count[many] > 2, 10**6, 1)
        _, first = np.unique(gid[many], return_index=True)
        at, count, gid = at[many][first], count[many][first], gid[many][first]
        take = np.repeat(at - np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64), count) + np.arange(int(count.sum()))
        return pd.DataFrame({"gid": np.repeat(gid, count).view(np.int64), "uid": node[take]})
    return run


def _unpacked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for token, node in zip(part.column("token"), part.column("node")):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(token.as_py(), np.int64)), pa.array(np.frombuffer(node.as_py(), np.int64))], ["gid", "uid"])


def sharing_groups(heads: DataFrame, column: str, percent: int) -> DataFrame:
    """``(gid, uid, w)``: groups of nodes of ``heads(uid, n, <column>: packed distinct tokens)``
    that share a token; pairs whose sizes rule a link out may be left away."""
    entries = heads.agg(F.sum(F.octet_length(column)) / 8).first()[0] or 0
    buckets = max(1, -(-int(entries) // BUCKET_ENTRIES))
    heavy = heads.sparkSession.sparkContext.broadcast(heavy_tokens(heads, column))
    packed = heads.select("uid", "n", column).mapInArrow(_entries(column, buckets, heavy), _ENTRIES)
    groups = packed.where("bucket >= 0").groupBy("bucket").applyInPandas(_sharing(percent), "gid long, uid long")
    if len(heavy.value):
        groups = groups.unionByName(packed.where("bucket < 0").select("token", "node").mapInArrow(_unpacked, "gid long, uid long"))
    return stash(groups.withColumn("w", F.lit(1).cast("long")))


# -- comparison in tasks -----------------------------------------------------

class Comparer:
    """What a task compares: its distinct nodes, by index. ``test(x, y)`` tells which pairs
    link; ``inside`` and ``across`` connect members of one group, or of two sides."""

    def __init__(self, rows: pd.DataFrame):
        pass

    def test(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def inside(self, members: np.ndarray, forest: Forest) -> None:
        """One member after another against the later ones that are not connected to it yet."""
        self._sweep(members, members, forest, later=True)

    def across(self, one: np.ndarray, two: np.ndarray, forest: Forest) -> None:
        self._sweep(one, two, forest, later=False)

    def _sweep(self, one: np.ndarray, two: np.ndarray, forest: Forest, later: bool) -> None:
        label = np.array([forest.find(i) for i in two.tolist()], np.int64)
        for t, x in enumerate(one.tolist()):
            own = forest.find(x)
            start = t + 1 if later else 0
            y = start + np.flatnonzero(label[start:] != own)
            olds: set[int] = set()
            for s in chunks(len(y), 20_000):
                olds.update(label[y[s][self.test(np.full(len(y[s]), x), two[y[s]])]].tolist())
            if olds:
                for old in olds:
                    forest.join(own, old)
                label[np.isin(label, [own, *olds])] = forest.find(own)


def _compared(make: Callable[[pd.DataFrame], Comparer]):
    """Spanning edges of what one task's groups connect."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node, first, owner = np.unique(rows["uid"].to_numpy(np.int64), return_index=True, return_inverse=True)
        compare, forest = make(rows.iloc[first]), Forest(len(node))
        gid, side = rows["gid"].to_numpy(np.int64), rows["side"].to_numpy(np.int64)
        order = np.lexsort((side, owner, gid))
        gid, owner, side = gid[order], owner[order], side[order]
        once = np.ones(len(gid), bool)
        once[1:] = (gid[1:] != gid[:-1]) | (owner[1:] != owner[:-1]) | (side[1:] != side[:-1])
        gid, owner, side = gid[once], owner[once], side[once]
        if "label" in rows.columns:  # connected before
            _, same = np.unique(rows["label"].to_numpy(np.int64)[first], return_inverse=True)
            head = np.full(same.max() + 1, -1, np.int64)
            for i, g in enumerate(same.tolist()):
                head[g] = i if head[g] < 0 else head[g]
                forest.join(int(head[g]), i)
        at = np.flatnonzero(np.concatenate([[True], gid[1:] != gid[:-1]]))
        count = np.diff(np.append(at, len(gid)))
        both = np.logical_and.reduceat(side == 2, at)
        pairs = []
        for m in np.unique(count[both & (count <= SMALL_GROUP)]).tolist():
            i, j = np.triu_indices(m, 1)
            for s in chunks(len(some := at[both & (count == m)]), max(1, 4_000_000 // max(1, len(i)))):
                pairs.append(np.unique(owner[some[s, None] + i].ravel() * len(node) + owner[some[s, None] + j].ravel()))
        if pairs:
            x, y = np.divmod(np.unique(np.concatenate(pairs)), len(node))
            for s in chunks(len(x), 1_000_000):
                hit = compare.test(x[s], y[s])
                forest.join_all(x[s][hit], y[s][hit])
        for a, m, inner in zip(at.tolist(), count.tolist(), both.tolist()):
            if inner and m > SMALL_GROUP:
                compare.inside(owner[a:a + m], forest)
            elif not inner:
                here, there = owner[a:a + m], side[a:a + m]
                compare.across(here[there == 0], here[there != 0], forest)
        root = np.array([forest.find(i) for i in range(len(node))], np.int64)
        moved = np.flatnonzero(root != np.arange(len(node)))
        return pd.DataFrame({"a": node[moved], "b": node[root[moved]]})
    return run


def linked(groups: DataFrame, payload: tuple[str, ...] | DataFrame, make: Callable, limit: int) -> DataFrame:
    """Spanning edges ``(a, b)`` of the links inside ``groups(gid, uid, w)``, as the comparer that
    ``make`` builds from a task's rows finds them. The rows carry the columns ``payload``
    themselves, or get them from the table ``payload(uid, ...)``."""
    run, edges = _compared(make), "a long, b long"
    if isinstance(payload, DataFrame):
        told = payload
        with_payload = lambda df: df.join(told, "uid")
    else:
        told = groups.select("uid", *payload)
        with_payload = lambda df: df if set(payload) <= set(df.columns) else df.join(told, "uid")
    large = stash(groups.groupBy("gid").agg(F.sum("w").alias("all")).where(F.col("all") > limit)
                  .select("gid", F.ceil(F.col("all") / limit).cast("int").alias("parts")))
    has_large = large.head(1) != []
    packs = max(1, -(-int(groups.agg(F.sum("w")).first()[0] or 0) // limit))
    small = groups.join(large, "gid", "left_anti") if has_large else groups
    near = (with_payload(small).withColumn("side", F.lit(2))
            .groupBy(F.pmod(F.xxhash64("gid"), F.lit(packs)).alias("pack")).applyInPandas(run, edges))
    if not has_large:
        return near
    rows = stash(groups.select("gid", "uid", "w").join(large, "gid")
                 .withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")))
    chosen = rows.groupBy("gid", "parts", F.pmod(F.xxhash64("uid", F.lit(7)), F.lit(PIVOTS)).alias("slot")).agg(F.min("uid").alias("uid"))
    chosen = chosen.select("gid", "uid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    first = stash(with_payload(rows.select("gid", "uid", "part").unionByName(chosen)).withColumn("side", F.lit(2))
                  .groupBy("gid", "part").applyInPandas(run, edges))
    tied = stash(rows.join(components(first), F.col("uid") == F.col("id"), "left")
                 .select("gid", "uid", "w", "parts", "part", F.coalesce("component", "uid").alias("label")))
    sizes = tied.groupBy("gid", "label").agg(F.count("*").alias("rows"))
    main = stash(sizes.groupBy("gid").agg(F.max(F.struct("rows", "label")).alias("top")).select("gid", F.col("top.label").alias("main")))
    rest = stash(tied.join(main, "gid").where("label <> main").drop("main"))
    blocks = stash(rest.groupBy("gid").agg(F.ceil(F.sum("w") / limit).cast("int").alias("blocks")))
    if blocks.head(1) == []:
        return near.unionByName(first)
    one = (rest.join(blocks, "gid").withColumn("block", F.pmod(F.xxhash64("uid", F.lit(3)), F.col("blocks")).cast("int"))
           .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("side", F.lit(0)))
    two = (tied.join(blocks, "gid").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("side", F.lit(1)))
    columns = ["gid", "uid", "label", "part", "block", "side"]
    second = (with_payload(one.select(*columns).unionByName(two.select(*columns)))
              .groupBy("gid", "part", "block").applyInPandas(run, edges))
    # a task that starts from connected nodes returns those connections as edges, too
    return near.unionByName(first).unionByName(second)


def width(n: int, room: int = 1) -> int:
    """Bits of a set's bitmap: a power of two, at least ``room`` a member."""
    return max(64, 1 << (room * n - 1).bit_length())


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    on = np.zeros(bits, np.uint8)
    on[(tokens & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(on, bitorder="little")


class Exact(Comparer):
    """Exact links between texts, by their shingle sets; sizes and small bitmaps rule most others out."""

    BITS = 1024

    def __init__(self, rows: pd.DataFrame, k: int, percent: int):
        self.percent = percent
        self.sets: list[np.ndarray] = []
        for _, raw, offsets in wordhash.batches(pa.array(rows["text"], pa.binary())):
            token, bounds = wordhash.shingles(raw, offsets, k)
            self.sets += [np.unique(token[bounds[i]:bounds[i + 1]]) for i in range(len(bounds) - 1)]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.bits = np.stack([bitmap(s, self.BITS) for s in self.sets])
        self.on = np.bitwise_count(self.bits).sum(1, dtype=np.int64)

    def test(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        p, a, b = self.percent, self.size[x], self.size[y]
        ok = (p * a <= 100 * b) & (p * b <= 100 * a)
        at = np.flatnonzero(ok)
        for s in chunks(len(at), 50_000):
            i, j = x[at[s]], y[at[s]]
            shared = np.bitwise_count(self.bits[i] & self.bits[j]).sum(1, dtype=np.int64)
            most = np.minimum(self.size[i] - (self.on[i] - shared), self.size[j] - (self.on[j] - shared))
            ok[at[s]] = most * (100 + p) >= p * (self.size[i] + self.size[j])
        for t in np.flatnonzero(ok).tolist():
            small, large = sorted((self.sets[x[t]], self.sets[y[t]]), key=len)
            if not len(small):
                ok[t] = False
                continue
            place = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[place] == small).sum())
            ok[t] = 100 * both >= p * (len(small) + len(large) - both)
        return ok

    def inside(self, members: np.ndarray, forest: Forest) -> None:
        # neighbours in size first: most links are there, and connected pairs are not tested
        super().inside(members[np.argsort(self.size[members], kind="stable")], forest)


def exact(k: int, percent: int):
    return lambda rows: Exact(rows, k, percent)
