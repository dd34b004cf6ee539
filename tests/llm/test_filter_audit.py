"""The filter audit against a loop over all orders, and its SQL."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest

from berth.llm import filter_audit, queries

DOCS = "doc_id long, text string, source string, uid int, part string, prefix int"
LABELS = "doc_id long, quality int, toxic int, good string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    good, toxic = defaultdict(int), defaultdict(int)
    for d, q, t, _ in labels:
        if d is not None:
            good[d] |= q == 1
            toxic[d] |= t == 1
    docs = []
    for d, text, source, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        smaller = any(e is not None and d is not None and e < d and (u or "") == text for e, u, *_ in rows)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": smaller}
        docs.append((source or "", {k for k, v in fails.items() if v}, good[d] if d is not None else 0, toxic[d] if d is not None else 0))
    out, shapley = [], defaultdict(int)
    for part in {p for p, *_ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in permutations("ABCDE"):
            live = own
            for step, f in enumerate(order, 1):
                gone = [x for x in live if f in x[1]]
                rest = [x for x in live if f not in x[1]]
                dead = [x for x in own if x not in live and f in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                assert redundant >= len(dead) or not dead
                out.append((part, "".join(order), step, len(rest), len(gone), redundant, sum(x[1] == {f} for x in own),
                            sum(x[2] for x in gone), sum(x[3] for x in gone)))
                shapley[part, f] += len(gone)
                live = rest
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [None, "", " \n ", "A B C", "x # y", "Long " * 250, "é" * 300]
    for _ in range(40):
        words = [word() for _ in range(rng.choice([20, 199, 200, 201, 260]))]
        if rng.random() < 0.3:
            words = words[:40] * 6
        if rng.random() < 0.3:
            words = [w.upper() if rng.random() < 0.2 else w for w in words]
        if rng.random() < 0.3:
            words.append("|&*")
        texts.append("\t".join(words))
    out = [(i, t, rng.choice([None, "", "a", "b"]), i, "p", 1) for i, t in enumerate(texts + [rng.choice(texts) for _ in range(30)])]
    return out + [(3, "A B C", "a", 0, None, None), (3, "other", "b", 0, None, None), (None, "A B C", "a", 1, "x", 2), (None, None, None, None, None, None)]


LABELLED = [(i, i % 2, (i // 2) % 2, "g") for i in range(60)] + [(5, 1, None, None), (6, None, 1, None), (None, 1, 1, None)]
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force_and_sql(spark, rows, tmp_path):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(LABELLED, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op13_filter_interaction_audit(spark, str(tmp_path))
    assert got.columns == COLUMNS
    want = brute(rows, LABELLED)
    assert sorted(map(tuple, got.collect())) == want
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(con.execute(filter_audit.ORACLE_SQL).fetchall()) == want


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.op13_filter_interaction_audit(spark, str(tmp_path)).count() == 0
