"""MinHash near-duplicates with SuperMinHash signatures.

A text is its set of distinct k-word shingles. Every shingle walks through its own random
permutation of the signature's places (Fisher-Yates, one step a round): in round ``j`` it
offers ``j`` plus a uniform number at its ``j``-th place, and a place keeps the least offer.
The offers of one shingle are thus ranks of one permutation, which makes the estimate less
variable than independent minima, and no later round can change a place that has an offer:
a set stops as soon as all places have one, after about ``m ln(m) / n`` rounds.

1. **Signatures**: one pass over the texts; shingles of many texts advance together in
   arrays, a set leaves when it is full.
2. **Banding**: bands of ``ROWS`` places; nodes (distinct sets) that share a band meet in
   groups, where signatures decide about a candidate: sets at the threshold agree in
   ``m * J`` places on average, and ``DEVIATIONS`` standard deviations below that pass.
   A pair at the threshold of 85 % shares none of the 26 bands of 5 places with a
   probability of 2.4e-7; above the threshold less.
3. **Verification** of the candidates on full shingle sets, then union-find over the exact
   links (:mod:`berth.llm.similar`): groups of any size are compared in bounded tasks, and
   only spanning edges are exchanged.

Defined cases: as in the n-gram join: a null text is empty; a text without words has size 0
and links with nothing; fewer than k words make one shingle of the whole sequence; a null
doc_id links with nothing, has a null component and stays; rows that repeat a doc_id are one
document with several sets; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm import similar, wordhash
from berth.llm.common import chunks, stash

#: Bands, and places in each.
BANDS, ROWS = 26, 5
PLACES = BANDS * ROWS
#: Candidates may agree in so many standard deviations fewer places than the threshold asks for.
DEVIATIONS = 7.0
#: Shingles whose permutations are held at once (``PLACES`` bytes each).
CHUNK = 150_000


def offers(token: np.ndarray, step: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """(uniform 48-bit number, place in step..places-1) of each token in a round."""
    draw = wordhash.mix(token + np.uint64((step * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))
    return draw >> np.uint64(16), step + (((draw & np.uint64(0xFFFF)) * np.uint64(places - step)) >> np.uint64(16)).astype(np.int64)


def _advance(token: np.ndarray, owner: np.ndarray, sig: np.ndarray) -> None:
    """Rounds of the shingles ``token`` of the sets ``owner``, into their rows of ``sig``."""
    places = sig.shape[1]
    order = np.tile(np.arange(places, dtype=np.uint8), (len(token), 1))
    flat = sig.reshape(-1)
    for step in range(places):
        high, at = offers(token, step, places)
        every = np.arange(len(token))
        place = order[every, at]
        order[every, at] = order[:, step]
        np.minimum.at(flat, owner * places + place, high | np.uint64(step << 48))
        full = (sig < np.uint64((step + 1) << 48)).all(1)
        left = ~full[owner]
        if not left.any():
            return
        if left.mean() < 0.7:
            token, owner, order = token[left], owner[left], order[left]


def signatures(token: np.ndarray, bounds: np.ndarray, places: int = PLACES) -> np.ndarray:
    """A row of ``places`` values for each set ``token[bounds[i]:bounds[i + 1]]``."""
    sig = np.full((len(bounds) - 1, places), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for s in chunks(len(token), CHUNK):  # the least offer of all chunks, whatever the cut
        part = np.full_like(sig[owner[s][0]:owner[s][-1] + 1], np.iinfo(np.uint64).max)
        _advance(token[s], owner[s] - owner[s][0], part)
        rows = sig[owner[s][0]:owner[s][-1] + 1]
        np.minimum(rows, part, out=rows)
    return sig


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit token for each band of each signature."""
    n, places = sig.shape
    count = places // rows
    weights = wordhash.powers(0x9E3779B97F4A7C15, rows + 1)[1:]
    mixed = (wordhash.mix(sig[:, :count * rows]).reshape(n, count, rows) * weights).sum(2, dtype=np.uint64)
    return wordhash.mix(mixed + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


_PROFILE = "uid long, doc_id long, mark long, n long, f1 long, f2 long, bands binary, sig binary"


def _profiled(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, raw, offsets in wordhash.batches(part.column("text")):
                token, bounds = wordhash.shingles(raw, offsets, k)
                sets = [np.unique(token[bounds[i]:bounds[i + 1]]) for i in range(len(bounds) - 1)]
                size = np.array([len(s) for s in sets], np.int64)
                prints = [similar.fingerprint(s) for s in sets]
                sig = signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)]))
                keys, short = bands(sig), (sig & np.uint64(0xFFFF)).astype(np.uint16)
                rows = [*(part.column(c).slice(at, len(size)) for c in ("uid", "doc_id", "mark")), pa.array(size),
                        pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                        pa.array([keys[i].tobytes() if n else b"" for i, n in enumerate(size.tolist())], pa.binary()),
                        pa.array([short[i].tobytes() if n else b"" for i, n in enumerate(size.tolist())], pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, ["uid", "doc_id", "mark", "n", "f1", "f2", "bands", "sig"])
    return run


class Agreement(similar.Comparer):
    """Nodes whose signatures agree in enough places, and whose sizes allow a link."""

    def __init__(self, rows: pd.DataFrame, percent: int):
        self.percent = percent
        self.size = rows["n"].to_numpy(np.int64)
        self.sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(len(rows), -1)
        places, share = self.sig.shape[1], percent / 100
        self.least = int(places * share - DEVIATIONS * (places * share * (1 - share)) ** 0.5)

    def test(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok = (self.percent * self.size[x] <= 100 * self.size[y]) & (self.percent * self.size[y] <= 100 * self.size[x])
        at = np.flatnonzero(ok)
        for s in chunks(len(at), 50_000):
            ok[at[s]] = (self.sig[x[at[s]]] == self.sig[y[at[s]]]).sum(1) >= self.least
        return ok


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``."""
    told = stash(similar.numbered(docs).mapInArrow(_profiled(k), _PROFILE))
    nodes = similar.Nodes(told, ("bands", "sig"))
    groups = similar.sharing_groups(nodes.heads, "bands", percent)
    near = similar.linked(groups, nodes.heads.select("uid", "n", "sig"), lambda rows: Agreement(rows, percent), similar.PACK_ROWS)
    links = similar.exact_links(docs, nodes, near, k, percent)
    found = similar.document_components(nodes, links)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
