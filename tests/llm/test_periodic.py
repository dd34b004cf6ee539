"""Periodic runs against their definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from berth.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, collapsed int, best string"


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """Every maximal stretch for every period, kept if no smaller period holds in it."""
    n, out = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(24, 3 * p):
                part = words[i:i + length]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed: int) -> list:
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdé") for _ in range(k))
    out = [None, "", " \n\t\x0b ", "a " * 23, "a " * 24, "a " * 400, "ab ba " * 40 + "ab", "one two three", "é \x85 é " * 12]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("xyz") if rng.random() < 0.5 else word(2) for _ in range(rng.randint(1, 14))]
            full = unit * rng.randint(1, 12)
            parts += full[:rng.randint(1, len(full))] + [word(3)] * rng.randint(0, 2)
        out.append("\n ".join(parts))
    out.append(" ".join(rng.choice("ab") for _ in range(3000)))  # many short periods
    long = [word(4) for _ in range(700)]
    return out + [" ".join(long * 9 + ["end"] + long[:300] * 4)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_equal_the_definition(seed):
    for text in texts(seed):
        words = WORD.findall(text or "")
        assert periodic.runs_of(words) == brute_runs(words)


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(i, t, "r", i, "b") for i, t in enumerate(texts(7))]
    rows += [(3, "again " * 30, "r", 1, "b"), (None, "null id " * 20, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(queries.op11_maximal_pair_runs(spark, str(tmp_path)).collect(), key=str)
    want, turned = [], 0
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            turned += 1
        runs = brute_runs(words)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        gone = {i for s, m, p in runs for i in range(s + p, s + m)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        told = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        want.append((doc_id, len(runs), *top, top[1] * 1000 // top[2] if runs else None,
                     hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()))
    assert turned > 2
    assert [tuple(r) for r in got] == [tuple(w) for w in sorted(want, key=lambda w: str(spark_row(w)))]


def spark_row(values: tuple):
    from pyspark.sql import Row

    return Row("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")(*values)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_maximal_pair_runs(spark, str(tmp_path)).count() == 0
