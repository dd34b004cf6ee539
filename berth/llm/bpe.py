"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts each text into chunks wherever the hash of
the last 32 bytes ends in ``CHUNK_BITS`` zeros, so copies of a passage are cut
alike wherever they stand. The *core* of a chunk lies between its first and last
white space. Cores that occur in several documents are found by their 128-bit
fingerprint (16 bytes each are shuffled, counted map-side), encoded once, in the
document that owns them, and their ids travel to the documents that share them;
all other cores are encoded where they stand, each distinct word once a task.

Joints are repaired by re-encoding until exact agreement: from the last white space
before a cut to the first white space behind it (across several cuts if a chunk has
none) the text is encoded anew. Where the repaired joint meets a core, the word on
either side is encoded once more, together with the other; if that does not give the
ids of the two, the joint grows over the core and on to the next place, until both
sides agree. (Tokenizers whose encodings white space does not separate at all are
refused when they are loaded.)

Defined cases: null text is empty and has no ids; special tokens' strings in a
text become the special ids, as the tokenizer does; a null doc_id encodes on its
own; rows that repeat a doc_id are encoded row by row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm import wordhash
from berth.llm.common import stash

#: Chunks average 2^CHUNK_BITS bytes; shorter cores than MIN_SHARED are not shared.
CHUNK_BITS, MIN_SHARED = 10, 128
#: Bytes of words and ids that a task remembers: two generations of half of it, so that
#: words in use outlive those seen once.
MEMO_BYTES = 112_000_000
#: Documents that leave a task together.
ROWS = 512
#: Ids that are decoded at a time, and one document more.
DECODED = 250_000
_WINDOW_STEPS = 5  # 2^5 = 32 bytes
_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PROBES = ("one two", "a  b", "it's  1 2", "x\ny", "q \t r")


def load(json_text: str):
    """The tokenizer, with truncation and padding off; refused if white space does not
    separate its encodings."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    if any(ids(p) != [i for w in p.split() for i in ids(w)] for p in _PROBES):
        raise ValueError("white space does not separate this tokenizer's encodings")
    return tokenizer


class Memo(dict):
    """Word (bytes without white space) to its ids as little-endian bytes, two an id where
    the vocabulary allows."""

    def __init__(self, json_text: str):
        super().__init__()
        self.tokenizer = load(json_text)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.folds = all(self.encoded(w) == self.encoded(w.lower()) and self.encoded(w + m) == self.encoded(w) + self.encoded(m)
                         for w in (b"Word", b"ab's", b"x1y") for m in (b".", b",", b"!?", b":;", b"..."))
        self.older: dict[bytes, bytes] = {}
        self.size = 0

    def encoded(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, self.kind).tobytes()

    def _bare(self, word: bytes) -> tuple[bytes, bytes]:
        """(form, bare): the case of ASCII words, and marks behind an ASCII letter, don't matter
        where the tokenizer folds and splits them anyway, so one entry serves many forms of a
        word; other letters may be normalised together with what follows them."""
        if not self.folds or b"<" in word:
            return word, word
        form = word.lower() if word.isascii() else word
        bare = form.rstrip(b".,;:!?")
        return form, bare if bare[-1:].isalpha() else form

    def __missing__(self, word: bytes) -> bytes:
        out = self.older.get(word)
        if out is None:
            form, bare = self._bare(word)
            if bare != form:
                out = self[bare] + self[form[len(bare):]]
            elif form != word:
                out = self[form]
            else:
                out = self.encoded(word)
        self._keep(word, out)
        return out

    def _keep(self, word: bytes, ids: bytes) -> None:
        if self.size > MEMO_BYTES // 2:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self.size += len(word) + len(ids) + 150
        self[word] = ids

    def learn(self, words: list[bytes]) -> None:
        """Encode the words that are new in one call of the library; the ids of each are those
        that start inside it. Words that begin with more than ASCII are left to single calls."""
        new, forms, older = set(), [], self.older
        for word in set(filterfalse(self.__contains__, words)):
            if (ids := older.get(word)) is not None:
                self._keep(word, ids)
                continue
            form, bare = self._bare(word)
            if bare[0] < 0x80 and bare not in self and bare not in older:
                new.add(bare)
            if bare != word:
                forms.append((word, form, bare))
        if len(new) > 1:
            order = list(new)
            texts = [w.decode("utf-8") for w in order]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(found.ids, self.kind).tobytes()
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            first = np.fromiter((o[0] for o in found.offsets), np.int64, len(found))
            cuts = (np.searchsorted(first, starts) * np.dtype(self.kind).itemsize).tolist()
            for word, at, end in zip(order, cuts, cuts[1:]):
                self._keep(word, ids[at:end])
        for word, form, bare in forms:
            self._keep(word, self[form] if bare == form else self[bare] + self[form[len(bare):]])

    def encode(self, text: bytes) -> bytes:
        words = text.split()
        if len(words) > 1:
            self.learn(words)
        return b"".join(map(self.__getitem__, words))

    def wide(self, ids: bytes) -> bytes:
        """The ids as little-endian uint32."""
        return np.frombuffer(ids, self.kind).astype(np.uint32).tobytes()


def cut_points(raw: np.ndarray) -> np.ndarray:
    """Places (exclusive ends) where the rolling hash cuts, moved to character starts."""
    h = _GEAR[raw]
    for s in range(_WINDOW_STEPS):
        step = 1 << s
        if len(h) > step:
            h[step:] += h[:-step] << np.uint32(step)  # right side is read before it is written
    cuts = np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    cuts = cuts[cuts < len(raw)]
    while len(move := np.flatnonzero((raw[cuts] & 0xC0) == 0x80)):
        cuts[move] += 1
        cuts = cuts[cuts < len(raw)]
    return np.unique(cuts)


def pieces(text: bytes, cuts: list[int]) -> Iterator[tuple[bool, bytes]]:
    """(is a core, bytes) in order: cores of chunks, and the joints between them."""
    loose, at = b"", 0
    for end in [*cuts, len(text)]:
        chunk, at = text[at:end], end
        first = _SPACE.search(chunk)
        if first is None:
            loose += chunk
            continue
        i = first.start()
        j = max(chunk.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) + 1
        if loose or i:
            yield False, loose + chunk[:i]
        yield True, chunk[i:j]
        loose = chunk[j:]
    if loose:
        yield False, loose


def _documents(column: pa.Array) -> Iterator[tuple[int, bytes, list[int]]]:
    """(row, text, cuts) of a binary column; the hash runs over batches, and cuts that
    depend on bytes of the text before are left out."""
    for at, raw, offsets in wordhash.batches(column):
        ends = offsets.tolist()
        data = raw.tobytes()
        for i in range(len(ends) - 1):
            text = data[ends[i]:ends[i + 1]]
            yield at + i, text, cut_points(raw[ends[i]:ends[i + 1]]).tolist() if len(text) > MIN_SHARED else []


def _cores(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        ids = part.column("doc_id").to_pylist()
        docs, prints = [], []
        for row, text, cuts in _documents(part.column("text")):
            own = {xxhash.xxh3_128_digest(p) for core, p in pieces(text, cuts) if core and len(p) >= MIN_SHARED}
            docs += [ids[row]] * len(own)
            prints += own
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(prints, pa.binary())], ["doc_id", "core"])


def _owned(json_text):
    """Owners' texts and the cores to encode there -> (core, ids)."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = None
        for part in parts:
            memo = memo or Memo(json_text.value)
            wanted, found, seen = part.column("cores"), [], set()
            for row, text, cuts in _documents(part.column("text")):
                want = set(wanted[row].as_py())
                for core, p in pieces(text, cuts):
                    if core and len(p) >= MIN_SHARED and (key := xxhash.xxh3_128_digest(p)) in want and key not in seen:
                        seen.add(key)
                        found.append((key, memo.encode(p)))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], ["core", "ids"])
    return run


def _agree(memo: Memo, *pieces: bytes) -> bool:
    """Whether the encodings of neighbouring pieces meet exactly: the last word of the first,
    whatever is between, and the first word of the last give the same ids together as alone."""
    left, right = pieces[0].rsplit(None, 1)[-1:], pieces[-1].split(None, 1)[:1]
    if not left or not right:
        return True
    words = [*left, *pieces[1:-1], *right]
    return memo.encoded(b" ".join(words)) == b"".join(map(memo.encode, words))


def repaired(memo: Memo, text: bytes, cuts: list[int], known: dict[bytes, bytes]) -> bytes:
    """The ids of a text: ``known`` ids for shared cores, everything else encoded here, joints
    grown until they agree with what they meet."""
    parts = list(pieces(text, cuts))
    fine = [False] * (len(parts) + 1)  # does the part agree with the one before it
    for i in range(1, len(parts) - 1):
        if not parts[i][0] and _agree(memo, parts[i - 1][1], parts[i][1], parts[i + 1][1]):
            fine[i] = fine[i + 1] = True
    out: list[tuple[bytes, bytes]] = []  # (piece, ids)
    for i, (core, piece) in enumerate(parts):
        ids = (known.get(xxhash.xxh3_128_digest(piece)) if core else None) or memo.encode(piece)
        while out and not (fine[i] or _agree(memo, out[-1][0], piece)):
            before, _ = out.pop()
            piece = before + piece
            ids = memo.encoded(piece)
            fine[i] = False
        out.append((piece, ids))
    return b"".join(ids for _, ids in out)


def _assembled(json_text):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = None
        for part in parts:
            memo = memo or Memo(json_text.value)
            for s in range(0, part.num_rows, ROWS):
                some = part.slice(s, ROWS)
                shared, out = some.column("shared"), []
                for row, text, cuts in _documents(some.column("text")):
                    known = {e["core"]: e["ids"] for e in shared[row].as_py() or ()}
                    out.append(memo.wide(repaired(memo, text, cuts, known) if known else memo.encode(text)))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])
    return run


def _joined(docs: DataFrame, tokenizer_path: str):
    """(rows with the ids of their shared cores, the tokenizer's text broadcast)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        json_text = docs.sparkSession.sparkContext.broadcast(f.read())
    load(json_text.value)
    # a key that is never null, and the same columns: both joins read one and the same exchange
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("key"), F.col("text").cast("binary").alias("text"))
    refs = stash(rows.select("doc_id", "text").mapInArrow(_cores, "doc_id long, core binary").where("doc_id is not null"))
    owners = refs.groupBy("core").agg(F.count("*").alias("n"), F.min("doc_id").alias("owner")).where("n > 1")
    owned = owners.groupBy(F.col("owner").alias("key")).agg(F.collect_list("core").alias("cores"))
    once = (rows.join(owned, "key").select("doc_id", "text", "cores").mapInArrow(_owned(json_text), "core binary, ids binary")
            .groupBy("core").agg(F.first("ids").alias("ids")))
    once = stash(once)  # a join of two exchanges is one whose hot keys adaptive execution may split
    shared = refs.join(once, "core").groupBy(F.col("doc_id").alias("key")).agg(F.collect_list(F.struct("core", "ids")).alias("shared"))
    return rows.join(shared, "key", "left").select("doc_id", "text", "shared"), json_text


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, ids)`` per row of ``docs(doc_id, text)``; ids are little-endian uint32."""
    joined, json_text = _joined(docs, tokenizer_path)
    return joined.mapInArrow(_assembled(json_text), "doc_id long, ids binary")


def token_strings(json_text: str) -> list[str]:
    tokenizer = load(json_text)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def _spelled(ids: np.ndarray, ends: np.ndarray, strings: pa.Array) -> list[memoryview]:
    """The strings of each run of ids (``ends``: where they end, 0 first), joined by one space."""
    if not len(ids):
        return [memoryview(b"")] * (len(ends) - 1)
    joined = strings.take(pa.array(ids))
    places = np.frombuffer(joined.buffers()[1], np.int64, len(ids) + 1)[ends].tolist()
    data = memoryview(joined.buffers()[2] or b"")
    return [data[at:max(at, end - 1)] for at, end in zip(places, places[1:])]


def _decoded(json_text, digest: bool, keep_ids: bool = False):
    import hashlib

    def runs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of neighbouring rows, about ``DECODED`` at a time, and where each row's end."""
        if not len(column):
            return
        column = column.fill_null(b"")
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 4
        ids, at = np.frombuffer(column.buffers()[2] or b"", np.uint32), 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + DECODED, "right")) - 1)
            yield ids[ends[at]:ends[to]], ends[at:to + 1] - ends[at]
            at = to

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = numbers = None
        for part in parts:
            if shown is None:
                tokens = token_strings(json_text.value)
                shown = pa.array([t.encode() + b" " for t in tokens], pa.large_binary())
                numbers = pa.array([b"%d " % i for i in range(len(tokens))], pa.large_binary())
            ids = part.column("ids")
            n, first, second = [], [], []
            for own, ends in runs(ids):
                n += np.diff(ends).tolist()
                texts = _spelled(own, ends, shown)
                if digest:
                    first += [hashlib.sha256(x).hexdigest() for x in _spelled(own, ends, numbers)]
                second += [hashlib.sha256(t).hexdigest() if digest else str(t, "utf-8") for t in texts]
            columns = [part.column("doc_id"), pa.array(n, pa.int64())]
            if digest:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(first, pa.string()), pa.array(second, pa.string()), *[ids] * keep_ids],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])
            else:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(second, pa.string())], ["doc_id", "n_tokens", "decoded"])
    return run


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, decoded)`` of ``encode``'s rows; special tokens are shown."""
    with open(tokenizer_path, encoding="utf-8") as f:
        json_text = encoded.sparkSession.sparkContext.broadcast(f.read())
    return encoded.mapInArrow(_decoded(json_text, False), "doc_id long, n_tokens long, decoded string")


def digests(docs: DataFrame, tokenizer_path: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row of ``docs(doc_id, text)``: encoded
    and decoded in one pass; and the ``ids``, if asked for."""
    joined, json_text = _joined(docs, tokenizer_path)
    encoded, decoded = _assembled(json_text), _decoded(json_text, True, keep_ids)
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return joined.mapInArrow(lambda parts: decoded(encoded(parts)), kind)
