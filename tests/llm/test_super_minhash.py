"""SuperMinHash: the signature against its definition, groups against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from berth.llm import similar, super_minhash
from tests.llm.test_text_operators import ROWS, SCHEMA, brute_components


def slow_signature(tokens: list[int], places: int) -> list[int]:
    """The least offer of every place over whole permutations, without any early stop."""
    best = [2**64 - 1] * places
    for t in tokens:
        order = list(range(places))
        for step in range(places):
            high, at = super_minhash.offers(np.array([t], np.uint64), step, places)
            at = int(at[0])
            order[step], order[at] = order[at], order[step]
            best[order[step]] = min(best[order[step]], (step << 48) | int(high[0]))
    return best


def test_signatures_equal_the_definition(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 0, 5, 40, 300, 1)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    want = [slow_signature(s.tolist(), 30) for s in sets]
    for chunk in (10_000, 7):  # also when a set is cut
        monkeypatch.setattr(super_minhash, "CHUNK", chunk)
        assert super_minhash.signatures(np.concatenate(sets), bounds, 30).tolist() == want


def test_estimates_vary_less_than_independent_minima():
    rng = np.random.default_rng(2)
    places, errors = 64, []
    for _ in range(300):
        common, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (40, 20, 20))
        token = np.concatenate([common, one, common, two])
        sig = super_minhash.signatures(token, np.array([0, 60, 120]), places)
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.9 * 0.25 / places  # 0.25 / places is the variance of independent minima


def test_groups_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(r[0], r[1]) for r in ROWS]
    for family in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 150]))]
        for i in range(15):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(base))] = f"n{rng.randrange(10**6)}"
            rows.append((1000 * (family + 1) + i, " ".join(own)))
    want = brute_components(rows, 5, 85)
    docs = spark.createDataFrame([(i, t, None, "x", 1, "t", 0, "s") for i, t in rows], SCHEMA).repartition(3)
    got = super_minhash.near_duplicates(docs, 5, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert len({c for _, _, c in want}) > 40


def test_large_groups_and_empty(spark, monkeypatch):
    for name, value in (("SMALL_GROUP", 3), ("BLOCK_BYTES", 4000), ("PACK_ROWS", 20), ("HEAVY_ENTRIES", 20), ("PIVOTS", 2)):
        monkeypatch.setattr(similar, name, value)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(80):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            own[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r)[:3] for r in super_minhash.near_duplicates(docs, 5, 85).collect()]
    assert sorted(got, key=str) == brute_components(rows, 5, 85)
    assert super_minhash.near_duplicates(spark.createDataFrame([], SCHEMA), 5, 85).count() == 0


def test_tokens_of_bands_differ():
    sig = super_minhash.signatures(np.arange(1, 9, dtype=np.uint64), np.array([0, 4, 8]))
    keys = super_minhash.bands(sig)
    assert keys.shape == (2, super_minhash.BANDS) and len(set(keys[0].tolist())) == super_minhash.BANDS
