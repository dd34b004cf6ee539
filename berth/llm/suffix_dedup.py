"""Removal of byte strings that occur again, in the manner of blockwise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same or another text; strings never cross texts. Only the order of
suffixes up to that depth matters, so a suffix's rank at depth L is named by the
fingerprint of its first L bytes: equal prefixes, equal names.

A difference cover modulo v makes the work small: for any two places there is a
shift below v that brings both onto the cover. If two strings of ``length`` bytes
are equal, then some cover sample of depth ``length - v + 1`` inside one of them
equals a cover sample of the other.

1. Equal texts of a map task fold into one; texts are dealt by hash into blocks of
   about ``BLOCK_BYTES`` bytes, where equal texts meet and fold.
2. **Cover samples**: each block names its samples (about 6.5 % of the places)
   and sends each name once to the bucket of its range. Buckets of about
   ``BUCKET_NAMES`` names are sorted one at a time; a name is answered with one
   bit: does it occur again.
3. **Long ties**: only a suffix with a cover sample that occurs again can be a
   repeat, and then the sample occurs again together with half of the string's
   other bytes, before or behind it. Samples that occur again are asked for at
   that depth first; the suffixes that are left alone are named at full depth
   and sorted, again one bucket at a time, each name once a block, again
   answered by bits.
4. Blocks mark, cut and fingerprint their texts.

No task holds more than a block or a bucket; a name held by a third of all texts
reaches its bucket once a block. Names of samples have 48 bits (they only
filter), names at full depth 64.

Defined cases: null text is empty; texts shorter than ``length`` never lose a
byte; of several equal texts of at least ``length`` bytes every byte goes; kept
bytes may end inside a character; rows that repeat or have a null doc_id are
texts of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm import wordhash
from berth.llm.common import runs

LENGTH = 400
BLOCK_BYTES = 2_000_000
BUCKET_NAMES = 4_000_000
#: Samples are at least this deep, so that few of them repeat by chance.
MIN_DEPTH = 48
_PLAIN = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(v, places): a cover modulo v of size 6r + 4, v = 24r^2 + 36r + 13, for the largest r
    that leaves samples of ``MIN_DEPTH`` bytes; (1, (0,)) if none does."""
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length - MIN_DEPTH + 1:
        r += 1
    if r < 0:
        return 1, (0,)
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, tuple(np.cumsum([0, *steps]).tolist())


class Block:
    """Distinct texts of a block in byte order, with the fingerprints of their substrings."""

    def __init__(self, group: pd.DataFrame, length: int):
        texts: dict[bytes, list] = {}
        for text, ids in zip(group["text"], group["ids"]):
            texts.setdefault(bytes(text), []).extend(None if x is None or x != x else int(x) for x in ids)
        self.length = length
        self.texts = sorted(texts)
        self.ids = [texts[t] for t in self.texts]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])]).astype(np.int64)
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        self.sums = wordhash.prefix_sums(_PLAIN[self.raw])
        self.long = np.flatnonzero(np.diff(self.offsets) >= length)
        self.copied = np.array([len(i) > 1 for i in self.ids], bool)

    def fingerprints(self, at: np.ndarray, depth: int) -> np.ndarray:
        return wordhash.spans(self.sums, at, at + depth)

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, name, text has a copy in the block) of the cover samples of the long texts."""
        v, cover = difference_cover(self.length)
        depth = self.length - v + 1
        places = [np.zeros(0, np.int64)]
        longest = int(np.diff(self.offsets).max(initial=0))
        pattern = (np.arange(0, longest + 1, v)[:, None] + np.array(cover)).ravel()
        for t in self.long.tolist():
            n = int(self.offsets[t + 1] - self.offsets[t])
            places.append(pattern[:np.searchsorted(pattern, n - depth, "right")] + self.offsets[t])
        at = np.concatenate(places)
        owner = np.searchsorted(self.offsets, at, "right") - 1
        return at, self.fingerprints(at, depth) >> np.uint64(16), self.copied[owner]

    def extended(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sample place, name, copied, is on the left) of samples with half of a string's
        other bytes on one side; those that would cross a text's end are left out."""
        v, _ = difference_cover(self.length)
        half, depth = (v - 1) // 2, self.length - v + 1
        owner = np.searchsorted(self.offsets, at, "right") - 1
        right = at + depth + half <= self.offsets[owner + 1]
        left = at - half >= self.offsets[owner]
        place = np.concatenate([at[right], at[left]])
        side = np.arange(len(place)) >= right.sum()
        name = self.fingerprints(np.where(side, place - half, place), depth + half) ^ (side * np.uint64(1 << 63))
        return place, name >> np.uint64(16), self.copied[np.concatenate([owner[right], owner[left]])], side

    def suffixes(self, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, name, copied) of the suffixes whose first ``length`` bytes hold one of the
        extended samples at ``at``, ``left`` or right."""
        v, _ = difference_cover(self.length)
        half = (v - 1) // 2
        near = np.zeros(len(self.raw) + 2, np.int32)
        np.add.at(near, np.maximum(at - np.where(left, v - 1, v - 1 - half), 0), 1)
        np.add.at(near, at - np.where(left, half, 0) + 1, -1)
        near = np.cumsum(near, dtype=np.int32) > 0
        starts = [np.zeros(0, np.int64)]
        for t in self.long.tolist():
            a, b = int(self.offsets[t]), int(self.offsets[t + 1])
            starts.append(np.flatnonzero(near[a:b - self.length + 1]) + a)
        i = np.concatenate(starts)
        owner = np.searchsorted(self.offsets, i, "right") - 1
        return i, self.fingerprints(i, self.length), self.copied[owner]


def _names(name: np.ndarray, copied: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct names, index of each given name, does it occur again in the block)."""
    distinct, back, count = np.unique(name, return_inverse=True, return_counts=True)
    again = count > 1
    again[back[copied]] = True
    return distinct, back, again


_ASK = "kind int, bucket long, block long, names binary, again binary"
_ANSWER = "kind int, bucket long, block long, again binary"


def _asked(kind: int, block: int, distinct: np.ndarray, again: np.ndarray, buckets: int, bits: int) -> pd.DataFrame:
    """A row for each bucket: names in order (6 or 8 bytes each) and what the block knows."""
    bucket = ((distinct >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    rows = []
    for a, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(distinct)]):
        wide = distinct[a:e].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :bits // 8]
        rows.append((kind, int(bucket[a]), block, wide.tobytes(), np.packbits(again[a:e]).tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _ASK.split(", ")])


def _answered(bits: int):
    """One bucket: which names occur in several blocks, or twice in one."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        width = bits // 8
        sizes = [len(x) // width for x in group["names"]]
        packed = np.frombuffer(b"".join(group["names"]), np.uint8).reshape(-1, width)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :width] = packed
        name = wide.view("<u8").ravel()
        again = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(group["again"], sizes)])
        order = np.argsort(name, kind="stable")
        ranked = name[order]
        same = ranked[1:] == ranked[:-1]
        tied = np.zeros(len(name), bool)
        tied[:-1] |= same
        tied[1:] |= same
        again[order[tied]] = True
        ends = np.cumsum(sizes)
        out = [np.packbits(again[e - n:e]).tobytes() for e, n in zip(ends.tolist(), sizes)]
        return pd.DataFrame({"kind": group["kind"], "bucket": group["bucket"], "block": group["block"], "again": out})
    return run


def _bits(answers: pd.DataFrame, kind: int, total: int, buckets_of: np.ndarray) -> np.ndarray:
    """The answers of one kind in the order of the block's distinct names."""
    out = np.zeros(total, bool)
    mine = answers[answers["kind"] == kind]
    start = np.flatnonzero(np.diff(buckets_of, prepend=-1))
    size = np.diff(np.append(start, total))
    place = {int(buckets_of[s]): (int(s), int(n)) for s, n in zip(start, size)}
    for bucket, bits in zip(mine["bucket"], mine["again"]):
        s, n = place[int(bucket)]
        out[s:s + n] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    return out


def _repeated(answers: pd.DataFrame, kind: int, name: np.ndarray, copied: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    distinct, back, _ = _names(name, copied)
    bucket = (((distinct >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    return _bits(answers, kind, len(distinct), bucket)[back]


def _ask_samples(length: int, buckets: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        block = Block(group, length)
        _, name, copied = block.samples()
        distinct, _, again = _names(name, copied)
        return _asked(0, int(group["block"].iloc[0]), distinct, again, buckets, 48)
    return run


def _extended(block: Block, answers: pd.DataFrame, buckets: int):
    at, name, copied = block.samples()
    return block.extended(at[_repeated(answers, 0, name, copied, buckets, 48)])


def _suffixes(block: Block, answers: pd.DataFrame, buckets: int):
    at, name, copied, left = _extended(block, answers, buckets)
    again = _repeated(answers, 1, name, copied, buckets, 48)
    return block.suffixes(at[again], left[again])


def _ask_more(length: int, kind: int, sample_buckets: int, buckets: int):
    """Names of extended samples (kind 1) or of suffixes (kind 2), given the answers so far."""
    def run(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        bits = 48 if kind == 1 else 64
        if group.empty:
            return _asked(kind, 0, np.zeros(0, np.uint64), np.zeros(0, bool), buckets, bits)
        block = Block(group, length)
        _, name, copied, *_ = (_extended if kind == 1 else _suffixes)(block, answers, sample_buckets)
        distinct, _, again = _names(name, copied)
        return _asked(kind, int(group["block"].iloc[0]), distinct, again, buckets, bits)
    return run


_RESULT = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"


def _cut(length: int, sample_buckets: int, buckets: int):
    def run(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if not group.empty:
            block = Block(group, length)
            start, name, copied = _suffixes(block, answers, sample_buckets)
            start = start[_repeated(answers, 2, name, copied, buckets, 64)]
            edge = np.zeros(len(block.raw) + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for t, ids in enumerate(block.ids):
                a, b = int(block.offsets[t]), int(block.offsets[t + 1])
                s, e = runs(gone[a:b])
                spans = [{"start": int(x), "end": int(y)} for x, y in zip(s, e)]
                kept = block.raw[a:b][~gone[a:b]].tobytes() if spans else block.texts[t]
                rows += [(i, b - a, spans, kept) for i in ids]
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "removed", "kept"])
        return out.astype({"doc_id": "Int64", "n_bytes": "int64"})
    return run


def _folded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch become one row, with all their ids."""
    for part in parts:
        texts: dict[bytes, list] = {}
        for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            texts.setdefault(t or b"", []).append(i)
        yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array(list(texts.values()), pa.list_(pa.int64()))], ["text", "ids"])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, removed spans, kept)`` per row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks = max(1, -(-total // BLOCK_BYTES))
    v, cover = difference_cover(length)
    sample_buckets = max(1, -(-total * len(cover) // v // BUCKET_NAMES))
    buckets = max(1, -(-total // BUCKET_NAMES))  # enough even if every suffix repeats
    placed = (rows.mapInArrow(_folded, "text binary, ids array<long>")
              .withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks))))
    asked = placed.groupBy("block").applyInPandas(_ask_samples(length, sample_buckets), _ASK)
    answers = asked.groupBy("bucket").applyInPandas(_answered(48), _ANSWER)

    def ask(kind: int, buckets: int) -> DataFrame:
        more = _ask_more(length, kind, sample_buckets, buckets)
        asked = placed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(more, _ASK)
        return asked.groupBy("bucket").applyInPandas(_answered(48 if kind == 1 else 64), _ANSWER)

    answers = answers.unionByName(ask(1, sample_buckets))
    answers = answers.unionByName(ask(2, buckets))
    return (placed.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(_cut(length, sample_buckets, buckets), _RESULT))


def digests(cut: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of ``remove_repeats``' rows."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
