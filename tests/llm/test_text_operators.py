"""Text operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from berth.llm import bpe, chat, ctw, gam, line_dedup, mixing, ngram_join, quality_rules, queries, similar, suffix_dedup, wordhash

SCHEMA = "doc_id long, text string, source string, n_words string, key int, token string, size int, score string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def make_rows() -> list[tuple]:
    """Nulls, empties, blanks, a very long text, copies, near copies, ties, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    passage = prose(90)
    near = base.split()
    near[60] = "changed"
    licence = "This licence line is shared by many of the documents here."
    fuzzy = "This licence line is shared by many of the documents there."
    texts = [
        None, "", "   \n\t ", "one", "One", "one two", "ONE\ttwo", base, base, " ".join(near), base.upper(),
        prose(40) + " " + passage + " " + prose(30), prose(25) + "\n" + passage, passage,
        licence + "\n" + prose(30), prose(20) + "\n" + licence, fuzzy + "\n" + prose(25), licence.upper() + "\n" + prose(22),
        "word " * 200, "a!! b!! c!! " * 30, "x### y$$$ z%%% " * 20, "<|endoftext|> it's<|startoftext|>  fine", "é    é İ ǅ Σς",
        "\U0001F600 emoji 12345 's 't", prose(4000), "line one is here again now\n" * 5, "no\x0bbreak\x0cspace \x85 nel",
        prose(30) + ".", "\n\n\n", prose(19), prose(20),
    ]
    texts += [prose(rng.randint(1, 80)) for _ in range(20)]
    rows = [(i, t, [None, "a", "b", "", "c"][i % 5], "x", i, "t", 0, "s") for i, t in enumerate(texts)]
    return rows + [(7, base, "a", "x", 1, "t", 0, "s"), (3, "one", "b", "x", 1, "t", 0, "s"), (None, "null id text here", "c", None, None, None, None, None)]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_fingerprints_follow_words():
    import pyarrow as pa

    texts = [t for _, t, *_ in ROWS]
    seen = {}
    for _, raw, offsets in wordhash.batches(pa.array(texts), limit=500):
        print_, at = wordhash.words(raw, offsets)
        for i in range(len(offsets) - 1):
            own = [w.lower() for w in WORD.findall(raw[offsets[i]:offsets[i + 1]].tobytes())]
            assert len(own) == at[i + 1] - at[i]
            for w, h in zip(own, print_[at[i]:at[i + 1]].tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# -- op1 ---------------------------------------------------------------------

def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    want = []
    for i, t, *_ in ROWS:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(own.decode(ids, skip_special_tokens=False).encode())))
    encoded = bpe.encode(docs, path)
    got = [tuple(r) for r in bpe.digests(docs, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r.doc_id: r.decoded for r in bpe.decode(encoded, path).collect()}[21] == own.decode(
        own.encode(ROWS[21][1], add_special_tokens=False).ids, skip_special_tokens=False)
    assert bpe.digests(empty, path).count() == 0


ALPHABETS = ("abcXYZ", "İIiıŞğé", "J\u030cH\u0331T\u0308w\u030aʾ", "ΑΒΣσςάΐ", "ЖжЙй\u0306", "漢字かなガｶﾞ", "אבגש\u05c1", "अआक\u094d", "ǅǈﬁﬀſK", "0127½²",
             ".,;:!?", "'’\"<>|", " \t\n\u00a0\u2003\x85", "\u0301\u0307\u0323", "\U0001F600\U0001F468\u200d")


def random_text(rng) -> str:
    own = rng.sample(ALPHABETS, rng.randint(1, 4)) + [".,!", "ab "]
    return "".join(rng.choice(rng.choice(own)) for _ in range(rng.randint(1, 12)))


def test_words_encode_as_the_library_does(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 400_000)
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        memo = bpe.Memo(f.read())
    rng = random.Random(12)
    texts = ["bİ!", "J\u030c!", "H\u0331.", "'S!", "it's,", "<|endoftext|>!", "A<|startoftext|>b."] + [random_text(rng) for _ in range(20_000)]
    for text in texts:
        want = memo.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.wide(memo.encode(text.encode())), np.uint32).tolist() == want, text
    for i in range(0, len(texts), 50):  # many new words in one call
        text = " ".join(texts[i:i + 50]) + " " + " ".join(random_text(rng) for _ in range(50))
        assert np.frombuffer(memo.wide(memo.encode(text.encode())), np.uint32).tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids


def test_learnt_words_are_looked_up_once():
    """All forms of a document's new words are known after one call of the library."""
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        memo = bpe.Memo(f.read())
    words = b"Lorem ipsum lorem, IPSUM! dolor; Dolor. sit".split()
    memo.learn(words)
    assert all(w in memo for w in words)


def test_decoding_of_awkward_columns(monkeypatch):
    """Nulls, empty rows, slices, and runs of rows cut at every place."""
    class Text:
        pass

    import pyarrow as pa
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        Text.value = f.read()
    own = bpe.load(Text.value)
    rng, top = random.Random(2), own.get_vocab_size()
    lists = [None, [], [], [5], [rng.randrange(top) for _ in range(40)], None, [top - 1, 0], [], [rng.randrange(top) for _ in range(9)], []]
    cells = pa.array([None if x is None else np.array(x, np.uint32).tobytes() for x in lists], pa.binary())
    part = pa.RecordBatch.from_arrays([pa.array(range(len(lists)), pa.int64()), cells], ["doc_id", "ids"])
    strings = bpe.token_strings(Text.value)
    for at, limit in ((0, 10**6), (1, 1), (1, 12), (5, 3)):
        monkeypatch.setattr(bpe, "DECODED", limit)
        for size in (0, 1, 4, len(lists) - at):
            want = [" ".join(strings[i] for i in x or []) for x in lists[at:at + size]]
            numbers = [" ".join(map(str, x or [])) for x in lists[at:at + size]]
            (got,) = bpe._decoded(Text, True)(iter([part.slice(at, size)]))
            assert got.column("n_tokens").to_pylist() == [len(x or []) for x in lists[at:at + size]]
            assert got.column("ids_sha256").to_pylist() == [sha(x.encode()) for x in numbers]
            assert got.column("decoded_sha256").to_pylist() == [sha(x.encode()) for x in want]
            (got,) = bpe._decoded(Text, False)(iter([part.slice(at, size)]))
            assert got.column("decoded").to_pylist() == want


def test_joints_grow_until_both_sides_agree(monkeypatch):
    """A tokenizer that joins words over white space: its joints swallow the pieces around them."""
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        memo = bpe.Memo(f.read())
    plain = memo.encoded
    joining = lambda t: plain(b" ".join(t.split()).replace(b"new york", b"newyork"))
    monkeypatch.setattr(memo, "encoded", joining, raising=False)
    monkeypatch.setattr(bpe, "pieces", lambda text, cuts: iter([(True, b"in old new "), (False, b"york"), (True, b" city halls")]))
    assert bpe.repaired(memo, b"", [], {}) == joining(b"in old new york city halls")


def test_chunks_are_shared_and_joints_repaired():
    rng = random.Random(1)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000)).encode()
    texts = [b"lead " + passage, b"another, longer beginning " + passage + b" end", b"x" * 5000 + passage[:4000]]
    cores = []
    for t in texts:
        parts = list(bpe.pieces(t, bpe.cut_points(np.frombuffer(t, np.uint8)).tolist()))
        assert b"".join(p for _, p in parts) == t
        cores.append({p for core, p in parts if core})
    assert len(cores[0] & cores[1]) > 0.8 * len(cores[0])


# -- op2 ---------------------------------------------------------------------

def test_additive_model_on_held_out_labels(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op2_additive_quality_model(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in labels)
    assert sum(got[r.doc_id].predicted == r.quality for r in held) >= 0.97 * len(held)
    none = spark.createDataFrame([], "doc_id long, label int")
    untrained = gam.train(docs, none)
    scored = gam.score(docs, untrained, F.lit(False)).collect()
    assert len(scored) == len(ROWS) and {r.score for r in scored} == {0.5}
    assert gam.score(empty, untrained, F.lit(False)).count() == 0


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert ((gam.predict(model, x) > 0.5) == (y > 0.5)).mean() > 0.9


# -- op3 ---------------------------------------------------------------------

def shingle_set(text, k):
    w = [x.lower() for x in WORD.findall((text or "").encode())]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                up[q] = p
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def test_jaccard_components_equal_brute_force(spark, docs, empty):
    rows = [(r[0], r[1]) for r in ROWS]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(docs, 3, 90).collect()), key=str)
    assert got == brute_components(rows, 3, 90)
    assert ngram_join.jaccard_components(empty, 3, 90).count() == 0


def test_dense_groups_blocks_and_trees(spark, monkeypatch):
    """Near copies at all similarities, with trees, buckets and blocks made tiny."""
    monkeypatch.setattr(similar, "SMALL_GROUP", 3)
    monkeypatch.setattr(similar, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(similar, "PACK_ROWS", 500)
    monkeypatch.setattr(similar, "BUCKET_ENTRIES", 400)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            own[rng.randrange(90)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(own[:rng.choice([90, 90, 88, 80])])))
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()), key=str)
    assert got == brute_components(rows, 3, 90)
    assert len({c for _, _, c in got}) > 3


@pytest.mark.parametrize("heavy", [1, 30])
def test_large_groups_are_dealt_into_parts(spark, monkeypatch, heavy):
    """Groups beyond one task's rows and bytes: parts, representatives, and the rest against all."""
    for name, value in (("SMALL_GROUP", 3), ("BLOCK_BYTES", 4000), ("PACK_ROWS", 12), ("HEAVY_ENTRIES", heavy), ("PIVOTS", 2)):
        monkeypatch.setattr(similar, name, value)
    rng = random.Random(heavy)
    rows = []
    for family in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        for i in range(40):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                own[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
            rows.append((100 * family + i, " ".join(own)))
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()), key=str)
    assert got == brute_components(rows, 3, 90)


def test_tables_without_a_repeated_shingle(spark):
    rows = [(1, "a b c d"), (2, "e f g h")] + [(i, " ".join(f"{i}x{j}" for j in range(i))) for i in range(3, 40)]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()), key=str)
    assert got == brute_components(rows, 3, 90)


def test_repeated_ids_with_different_texts(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    rows, clean = [], 0
    for i in range(30):
        one, two = [word() for _ in range(40)], [word() for _ in range(40 + i % 2)]
        near = list(two)
        near[-1] = word()
        rows += [(i, " ".join(one)), (i, " ".join(two)), (i + 100, " ".join(near))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(docs, 3, 90).collect()), key=str)
    assert got == brute_components(rows, 3, 90)
    kept = Counter(tuple(r) for r in ngram_join.one_per_component(docs, 3, 90).collect())
    assert kept == Counter(r for r in rows if r[0] < 100)  # both texts of an id, and no near copy of one


def test_one_per_component_keeps_columns(docs):
    kept = ngram_join.one_per_component(docs, 3, 90)
    assert kept.columns == docs.columns
    want = brute_components([(r[0], r[1]) for r in ROWS], 3, 90)
    assert Counter(r.doc_id for r in kept.collect()) == Counter({i for i, _, c in want if i == c})


def test_columns_may_have_any_name(spark, docs):
    """Filtering and mixing stages keep columns whose names they might use themselves."""
    extra = ("__whole", "__cut", "__copies", "__copy", "__source", "__quality_n_words", "__n_lines", "mark_", "doc_id_", "other")
    clash = docs.select("doc_id", "text", "source", *(F.col("doc_id").cast("string").alias(c) for c in extra))
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    for stage in (mixing.mix, lambda d: quality_rules.keep_good(d, labels), lambda d: line_dedup.dedup_lines(d), ngram_join.one_per_component):
        kept = stage(clash)
        assert kept.columns[:len(clash.columns)] == clash.columns
        assert all(r["__whole"] == (None if r["doc_id"] is None else str(r["doc_id"])) for r in kept.collect())


# -- op4 ---------------------------------------------------------------------

def test_mix_meets_targets(docs, empty):
    got = [r.asDict() for r in mixing.plan(docs).collect()]
    sizes = {}
    for r in got:
        assert r["size"] == len(WORD.findall((dict((x[0], x[1]) for x in ROWS)[r["doc_id"]] or "").encode()))
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:  # the excess of full sources goes to the others
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 2 * sizes[s]
            left -= want[s]
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["copies"] * r["size"] for r in own) - want[s]) <= 2 * max(r["size"] for r in own)
    again = [r.asDict() for r in mixing.plan(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter({r: sum(x["copies"] for x in got if x["doc_id"] == r) for r in {x["doc_id"] for x in got}})
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


# -- op5 ---------------------------------------------------------------------

def brute_repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        yield len(t), int(gone.sum()), int((edge == 1).sum()), sha(np.frombuffer(t, np.uint8)[~gone].tobytes())


@pytest.mark.parametrize("length", [20, 100, 400])
def test_suffix_repeats_equal_brute_force(docs, empty, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 9000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_NAMES", 3000)
    want = [(r[0], *x) for r, x in zip(ROWS, brute_repeats([(r[1] or "").encode() for r in ROWS], length))]
    got = [tuple(r) for r in suffix_dedup.digests(suffix_dedup.remove_repeats(docs, length)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(empty, length).count() == 0


@pytest.mark.parametrize("length", [30, 70, 200, 400, 1000])
def test_difference_cover_covers(length):
    v, cover = suffix_dedup.difference_cover(length)
    assert {(a - b) % v for a in cover for b in cover} == set(range(v)) and max(cover) < v <= length


# -- op6 ---------------------------------------------------------------------

def test_chat_round_trip(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "system", "be <|| good <|"), (1, 1, "user", "hi"), (1, 2, "user", odd), (1, 3, "assistant", "a<|im_sep|>b"),
            (1, 4, "assistant", None), (1, 5, "assistant", "c <"), (2, 1, "assistant", "second"), (2, 0, None, "|first<"),
            (3, 0, "user\nx<|", ""), (3, 0, "user\nx<|", ""), (3, None, "assistant", "\U0001F600\n"), (None, 0, "user", "n"), (4, 7, "assistant", "")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(turns)
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    for c, own in by.items():
        own = [(r, t) for _, _, r, t in sorted(own)]
        loss = "".join(t for r, t in own if r == "assistant")
        want = (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own).encode()), len(loss), sha(loss.encode()))
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want
    shown = {r.conv_id: r.formatted for r in made.collect()}
    assert shown[1].count(chat.START) == 3 and shown[1].count(chat.SEP) == 3
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


# -- op7 ---------------------------------------------------------------------

def line_words(line: str) -> list[str]:
    return [w for w in line.lower().split(" ") if w]


def sim_hash(words: list[str]) -> int:
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in set(words)]
    return sum(1 << b for b in range(63) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def distance(a: str, b: str) -> int:
    x, at = np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    row = at.copy()
    for i, c in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (x != ord(c)))])
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def brute_lines(rows):
    """doc_id, text -> text without repeated lines; rows are (doc_id, text), distinct."""
    found = []
    for i, t in rows:
        for p, line in enumerate(t.split("\n") if t is not None else []):
            w = line_words(line)
            if len(w) >= 5:
                found.append(((i is not None, i or 0), p, w, i, t))
    forms = sorted({" ".join(f[2]) for f in found})
    sims = {f: sim_hash(f.split()) for f in forms}
    up = {f: f for f in forms}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, a in enumerate(forms):
        for b in forms[:n]:
            if bin(sims[a] ^ sims[b]).count("1") <= 2 and 100 * distance(a, b) <= 20 * max(len(a), len(b)):
                up[find(a)] = find(b)
    first = {}
    for f in found:
        key = find(" ".join(f[2]))
        first[key] = min(first.get(key, (f[0], f[1])), (f[0], f[1]))
    gone = {(f[3], f[4], f[1]) for f in found if first[find(" ".join(f[2]))] != (f[0], f[1])}
    return {(i, t): t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, t, p) not in gone) for i, t in rows}


def test_line_dedup_equals_brute_force(docs, empty):
    rows = list(dict.fromkeys((r[0], r[1]) for r in ROWS))
    plain = [r for r in rows if r[1] is None or r[1].isascii() or "\n" in r[1] or r[1].count(" ") > 10]
    own = docs.where(F.coalesce(F.col("doc_id"), F.lit(-1)).isin([-1 if r[0] is None else r[0] for r in plain]))
    want = brute_lines(plain)
    kept = line_dedup.dedup_lines(own)
    assert kept.columns == [*docs.columns, "__n_lines", "__n_removed"]
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter((r.doc_id, want[(r.doc_id, r.text)]) for r in own.collect())
    changed = [k for k in want if want[k] != k[1]]
    assert {14, 15, 16, 17, 25} & {k[0] for k in changed}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_joins_fuzzy_lines_beyond_the_pivot(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = "".join(rng.choice("abcdefghij") for _ in range(6))
        rows.append((i, " ".join(own) + "\nshort line"))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k[0]: v for k, v in brute_lines(rows).items()}


def changed_lines(rng, n_lines=60):
    """Lines and versions of them with one or two words changed, added or left out: (line, version)."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    out = []
    while len(out) < n_lines:
        own = [word() for _ in range(rng.choice([5, 6, 7, 8, 9, 10, 11, 14, 20, 40]))]
        new = list(own)
        for _ in range(rng.randint(1, 2)):
            at, how = rng.randrange(len(new)), rng.randrange(3)
            new[at:at + (how != 1)] = [] if how == 2 else [word()]
        a, b = " ".join(own), " ".join(new)
        if min(len(own), len(new)) >= 5 and a != b and 100 * distance(a, b) <= 20 * max(len(a), len(b)):
            out.append((a, b))
    return out


def test_whole_line_dedup_finds_all_lines_of_one_or_two_changed_words(spark):
    pairs = changed_lines(random.Random(11))
    rows = [(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = sum(bin(sim_hash(a.split()) ^ sim_hash(b.split())).count("1") <= 2 for a, b in pairs)
    assert near < 0.3 * len(pairs)  # what SimHashes alone find
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, whole=True).collect()}
    assert got == {i: t if i % 2 == 0 else "" for i, t in rows}


def test_whole_line_dedup_makes_words_once_and_moves_only_the_lines_of_its_pairs(spark, monkeypatch):
    """The words of all lines are made in one pass (and again for those that meet others), and lines are joined
    only to pairs that they are in. Before: two passes over all lines, and all lines that meet others in each join."""
    pairs = changed_lines(random.Random(5), 12)
    rows = [(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in range(2)]
    passes, joined = [], []
    words, with_lines = line_dedup.line_words, line_dedup._with_lines

    def counted(line):
        passes.append(1)
        return words(line)

    def seen(pairs, lines):
        joined.append((pairs.select(F.explode(F.array("a", "b"))).distinct().count(), lines.count()))
        return with_lines(pairs, lines)
    monkeypatch.setattr(line_dedup, "line_words", counted)
    monkeypatch.setattr(line_dedup, "_with_lines", seen)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()}
    assert got == {i: t if i % 2 == 0 else "" for i, t in rows}
    assert len(passes) == 2 and any(n for n, _ in joined) and all(n == m for n, m in joined)


def test_words_added_up_at_once_give_the_sim_hash(spark):
    rng = random.Random(6)
    lines = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)) for n in (5, 14, 15, 16, 30, 31, 47, 400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)] + [(3, lines[3])], "doc_id long, text string")  # one row twice
    for whole in (False, True):
        got = {r.doc_id: r.sim for r in line_dedup.signatures(docs, 5, whole).collect()}
        assert got == {i: sim_hash(t.split()) for i, t in enumerate(lines)}


def test_whole_line_dedup_folds_equal_lines_of_any_length(spark):
    rows = [(1, "Les.\n\none two\n \t\nsame\tfive words by tabs"), (2, "les.\nONE  two\r\nonly here\n"), (3, "same five\x0bwords by tabs\n les.\none\ttwo three"), (None, "LES.")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()}
    assert got == {None: "LES.", 1: "\none two\n \t\nsame\tfive words by tabs", 2: "only here\n", 3: "one\ttwo three"}


# -- op8 ---------------------------------------------------------------------

def test_statistics_equal_brute_force(docs, empty):
    told = quality_rules.with_statistics(docs, prefix="__s_")
    assert told.columns == [*docs.columns, *("__s_" + s for s in quality_rules.STATS)]
    texts = defaultdict(list)
    for r in ROWS:
        texts[r[0]].append(r[1])
    for r in told.collect():
        t = next(x for x in texts[r.doc_id] if x == r.text) or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        at = defaultdict(list)
        for j in range(len(w) - 7):
            at[tuple(w[j:j + 8])].append(j)
        covered = {j + d for p in at.values() if len(p) > 1 for j in p for d in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert tuple(r["__s_" + s] for s in quality_rules.STATS[:5]) == want, t[:80]
    assert quality_rules.with_statistics(empty).count() == 0


def test_rules_separate_held_labels(spark, docs, empty):
    sf = "/root/testdata/sf0.1"
    d, l = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality_rules.judge(d, l).where("not base_failed").join(l, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in kept}
    assert n[(0, False)] >= 0.95 * sum(v for (q, _), v in n.items() if q == 0)
    assert n.get((1, False), 0) <= 0.01 * sum(v for (q, _), v in n.items() if q == 1)
    none = l.limit(0)
    judged = quality_rules.judge(docs, none)
    assert judged.count() == len(ROWS) and not judged.where("kept = base_failed").count()
    good = quality_rules.keep_good(docs, none)
    assert good.columns == docs.columns and good.count() == judged.where("kept").count()
    assert quality_rules.judge(empty, none).count() == 0


# -- op10 --------------------------------------------------------------------

def brute_ctw(train: list[bytes], depth: int):
    """Straight from the definition: every seen context is a node; the pool is the unseen rest."""
    counts = defaultdict(lambda: np.zeros(256))
    for t in train:
        s = b"\n" * depth + t + b"\n"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                counts[s[i - d:i][::-1]][s[i]] += 1
    children = defaultdict(set)
    for c in counts:
        if c:
            children[c[:-1]].add(c)
    from math import lgamma, log, pi

    kt_log = lambda a, b: lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi)

    def split(c, lo, hi):
        mid = (lo + hi) // 2
        return c[lo:mid].sum(), c[mid:hi].sum()

    def weighted(ctx, lo, hi):
        a, b = split(counts[ctx], lo, hi)
        if len(ctx) == depth or not children[ctx]:
            return kt_log(a, b)
        rest = counts[ctx] - sum(counts[c] for c in children[ctx])
        below = sum(weighted(c, lo, hi) for c in children[ctx]) + kt_log(*split(rest, lo, hi))
        return np.logaddexp(kt_log(a, b), below) - log(2)

    def p_one(path, lo, hi):
        ctx = path[0]
        a, b = split(counts[ctx], lo, hi)
        own = (b + 0.5) / (a + b + 1)
        if len(ctx) == depth or not children[ctx]:
            return own
        w = np.exp(kt_log(a, b) - log(2) - weighted(ctx, lo, hi))
        if len(path) > 1 and path[1] in children[ctx]:
            return w * own + (1 - w) * p_one(path[1:], lo, hi)
        ra, rb = split(counts[ctx] - sum(counts[c] for c in children[ctx]), lo, hi)
        return w * own + (1 - w) * (rb + 0.5) / (ra + rb + 1)

    def score(t: bytes) -> float:
        s, total = b"\n" * depth + t + b"\n", 0.0
        for i in range(depth, len(s)):
            path, lo, hi = [s[i - d:i][::-1] for d in range(depth + 1)], 0, 256
            while hi - lo > 1:
                p, mid = p_one(path, lo, hi), (lo + hi) // 2
                total += np.log10(p if s[i] >= mid else 1 - p)
                lo, hi = (mid, hi) if s[i] >= mid else (lo, mid)
        return total

    return score


def test_context_tree_equals_definition(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["abra cadabra", "Abra  abra", None, "", "é cab", "abra cadabra", "zebra abra", "cab bac", "unseen Q", "bra " * 12, "ab", "ca"])] + [(None, "abra")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    norm = lambda t: b" ".join((t or "").encode().lower().split())
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = [norm(t) for i, t in rows if not held(i)]
    assert any(held(i) for i, _ in rows)
    score = brute_ctw(train, 2)
    monkeypatch.setattr(ctw, "HOT_WORDS", 2)
    got = ctw.score(docs, queries.fold(F.col("doc_id"), 7) == 2, depth=2).collect()
    count = Counter(w for t in train for w in t.split())
    n, v, ends = sum(count.values()) + len(train), len(count) + 1, len(train)
    want = {}
    for i, t in rows:
        c = [count[w] for w in norm(t).split()] + [ends]
        want[i] = (held(i), len(c), sum(x > 0 for x in c), n, sum(np.log10((x + 1) / (n + v + 1)) for x in c), score(norm(t)))
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], abs=1e-9) and r.score == pytest.approx(w[5], rel=1e-4, abs=1e-4)
    assert ctw.score(docs.limit(0), F.lit(False), depth=2).count() == 0


def test_similarity_at_the_edge_of_every_band(spark):
    """Edits just within and just beyond what a length allows, at lengths around the bands."""
    rng, pairs = random.Random(4), []
    for size in (1, 4, 5, 79, 80, 84, 85, 320, 325, 1280, 1290):
        for edits in {0, size // 5 - 1, size // 5, size // 5 + 1, size // 5 + 2}:
            if 0 <= edits <= size:
                x = "".join(rng.choices("abcd", k=size))
                places = set(rng.sample(range(size), edits))
                # letters that the other has not: the distance is the number of places
                pairs.append((x, "".join("z" if i in places else c for i, c in enumerate(x)), 5 * edits <= size))
                pairs.append((x, x + "y" * edits, 5 * edits <= size + edits))
    got = spark.createDataFrame(pairs, "x string, y string, want boolean").select("want", line_dedup._similar("x", "y").alias("is")).collect()
    assert len(got) == len(pairs) and all(r.want == r["is"] for r in got)


def test_scripts_of_edits_are_never_shorter_than_the_distance(spark):
    rng, pairs = random.Random(8), []
    for i in range(300):
        own = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 30))]
        new = list(own)
        for _ in range(rng.randint(0, 4)):
            at, how = rng.randrange(len(new) + 1), rng.randrange(3)
            new[at:at + (how != 1)] = [] if how == 2 else ["".join(rng.choices("abcdé", k=rng.randint(1, 6)))]
        pairs.append((" ".join(own), " ".join(new or own)))
    told = spark.createDataFrame(pairs, "x string, y string")
    edits = lambda limit: line_dedup._edits(F.split("x", " "), F.split("y", " "), F.lit(limit))
    got = told.select(F.levenshtein("x", "y").alias("least"), edits(10_000).alias("n"), edits(5).alias("few")).collect()
    assert all(r.least <= r.n for r in got) and all((r.few == r.n) if r.n <= 5 else r.few > 5 for r in got)
    assert sum(r.n <= r.least + 4 for r in got) > 0.8 * len(got)


def test_lines_that_share_a_passage_meet_only_if_they_can_be_linked(spark, monkeypatch):
    """Families of lines around one passage: pairs get their lines only where their words allow a link,
    and only a few distances of whole lines are looked for; the lines kept are those of brute force."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
    passage = [word() + "passage" for _ in range(10)]
    lines = [[word() for _ in range(9)] + passage + [word() for _ in range(9)] for _ in range(30)]
    for base in range(3):  # the same words, in another order each time
        own = [word() for _ in range(18)]
        for _ in range(2):
            rng.shuffle(own)
            for _ in range(6):
                lines.append(own + passage)
                lines[-1][rng.randrange(18)] = word()
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    met, whole = [], []
    apart, bounded = line_dedup._told_apart, line_dedup._bounded

    def told_apart(pairs, lines):
        met.append(pairs.select("a", "b").distinct().count())
        return apart(pairs, lines)

    def seen(open_, lines):
        out = bounded(open_, lines)
        whole.append((out.count(), out.where("least > 0").count()))
        return out
    monkeypatch.setattr(line_dedup, "_told_apart", told_apart)
    monkeypatch.setattr(line_dedup, "_bounded", seen)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()}
    first = {i: min([i, *(j for j, y in rows[:i] if 5 * distance(x, y) <= max(len(x), len(y)))]) for i, x in rows}
    assert len(set(first.values())) == 36 and got == {i: x if first[i] == i else "" for i, x in rows}
    assert sum(met) < len(rows) * (len(rows) - 1) // 2 // 4  # before: all pairs
    assert any(n and n == known for n, known in whole)


def test_context_tree_keeps_rare_contexts(spark, monkeypatch):
    """Contexts seen once among more than 32,768 symbols count as they are, whether their grams are broadcast or joined."""
    from functools import lru_cache
    from math import lgamma, log, pi

    depth, rng = 5, random.Random(11)
    words = ["".join(rng.choices("abcdefghiklmnopé", k=rng.randint(3, 8))) for _ in range(2500)]
    texts = [" ".join(rng.choices(words, k=370)) for _ in range(16)]
    rows = list(enumerate(texts)) + [(16, "zzz unseen a"), (17, "")]
    held = lambda i: i in (1, 16)
    symbols = lambda t: b"\n" * depth + b" ".join(t.encode().lower().split()) + b"\n"
    counts, children = defaultdict(Counter), defaultdict(set)
    for i, t in rows:
        s = symbols(t)
        for at in range(depth, len(s) if not held(i) else 0):
            for d in range(depth + 1):
                ctx = s[at - d:at][::-1]
                children[ctx[:-1]].add(ctx) if d else None
                for level in range(8):
                    counts[ctx][(256 | s[at]) >> (8 - level), s[at] >> (7 - level) & 1] += 1
    assert sum(counts[b""][1, b] for b in (0, 1)) > 32_768

    def own(ctx, j):
        a, b = counts[ctx][j, 0], counts[ctx][j, 1]
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi), (b + 0.5) / (a + b + 1)

    @lru_cache(None)
    def weighted(ctx, j):
        if not counts[ctx][j, 0] + counts[ctx][j, 1]:
            return 0.0
        if len(ctx) == depth:
            return own(ctx, j)[0]
        return np.logaddexp(own(ctx, j)[0], sum(weighted(c, j) for c in children[ctx])) - log(2)

    def p_one(full, j):
        now, left = 0.0, 1.0
        for d in range(depth + 1):
            ctx = full[:d]
            if ctx not in counts:
                return now + left * 0.5
            w = 1.0 if d == depth else np.exp(own(ctx, j)[0] - log(2) - weighted(ctx, j))
            now, left = now + left * w * own(ctx, j)[1], left * (1 - w)
        return now

    def want(t):
        s, total = symbols(t), 0.0
        for at in range(depth, len(s)):
            for level in range(8):
                p = p_one(s[at - depth:at][::-1], (256 | s[at]) >> (8 - level))
                total += np.log10(p if s[at] >> (7 - level) & 1 else 1 - p)
        return total

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = {i: want(rows[i][1]) for i in (0, 1, 16, 17)}
    for hot, size in ((300, 700), (10**6, 10**6)):
        monkeypatch.setattr(ctw, "HOT_GRAMS", hot, raising=False)
        monkeypatch.setattr(ctw, "_GRAMS", size, raising=False)
        got = {r.doc_id: r.score for r in ctw.score(docs, F.col("doc_id").isin(1, 16)).collect()}
        assert len(got) == len(rows)
        for i, w in wanted.items():
            assert got[i] == pytest.approx(w, rel=1e-6)


def test_context_tree_is_a_distribution_and_beats_words(spark):
    got = queries.op10_context_tree_score(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]  # log probabilities: the greater is the better
    rng = np.random.default_rng(0)
    levels = [(np.zeros(1, np.uint64), np.zeros(4, np.uint64), np.array([97, 98, 99, 10]), rng.integers(1, 50, 4))]
    levels += [(np.array([97], np.uint64), np.array([97, 97], np.uint64), np.array([98, 99]), np.array([1, 1]))]
    model = ctw.solve(levels, 1)
    assert np.allclose((10.0 ** model["logs"].astype(float)).sum(1), 1, atol=1e-5)
