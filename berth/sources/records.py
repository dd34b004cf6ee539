"""CSV files as records, read by many tasks whatever the size of one file.

A file is read in ranges of ``RANGE_BYTES``. A record belongs to the range that holds its
first byte, and ends at a line feed outside quotes; whether a range starts inside quotes
follows from the number of quote characters before it. So files of several ranges are read
twice: once to count quotes per range (their parities are summed over the ranges of a
file), once to cut and parse. Smaller files are parsed as they are.

Quotes are doubled inside quoted fields, which may hold separators and line breaks. A file
of several ranges must not hold an unpaired quote inside an unquoted field; if a range does
not end with a record, the read stops. Encodings in which a byte of a character can look
like a quote or a line feed (UTF-16, UTF-32) are read in one range.

Ranges are dealt to tasks in order of their size, so that a task has ``TASK_BYTES`` and one
range more at most. Bytes are parsed as they are read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from berth.operators.ranking import rank_within
from berth.sources.listing import file_system

RANGE_BYTES = 64 << 20
#: What one task reads, and how many ranges (or files), on the average at most.
TASK_BYTES, TASK_RANGES = 16 << 20, 1_000
_PIECE = 1 << 20
_FIRST_PIECE = 1 << 12
_ROWS = 4096


class RecordError(ValueError):
    """A range of a file does not end with a record."""


def plain_encoding(encoding: str) -> str:
    """The codec's name; UTF-8 drops a byte order mark."""
    name = encoding.upper().replace("_", "-")
    return "utf-8-sig" if name in ("UTF-8", "UTF-8-SIG", "UTF8") else encoding


def splittable(encoding: str) -> bool:
    name = encoding.upper().replace("_", "-")
    return not name.startswith(("UTF-16", "UTF16", "UTF-32", "UTF32", "UTF-7"))


def first_record(stream, sep: str, encoding: str) -> list[str]:
    """The first CSV record of an open file; [] if it is empty."""
    import csv
    data, size = b"", 1 << 16
    while True:
        part = stream.read(size)
        data += part
        text = data.decode(plain_encoding(encoding), "replace")
        rows = list(zip(range(2), csv.reader(io.StringIO(text, newline=""), delimiter=sep)))
        if not part or len(rows) > 1:
            return rows[0][1] if rows else []
        size *= 2


def with_headers(files: DataFrame, sep: str, encoding: str) -> DataFrame:
    """``files`` with the ``header`` (array of texts, empty for an empty file) of each ``path``."""
    names = files.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = []
            for path in part.column("path").to_pylist():
                fs, at = file_system(path)
                with fs.open_input_stream(at) as stream:
                    found.append(first_record(stream, sep, encoding))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.string()))], [*names, "header"])
    return files.mapInArrow(run, files.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", header array<string>")


def _odd_quotes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        odd = []
        for path, start, end in zip(*(part.column(c).to_pylist() for c in ("path", "start", "end"))):
            fs, at = file_system(path)
            with fs.open_input_file(at) as f:
                f.seek(start)
                count, left = 0, end - start
                while left > 0 and (data := f.read(min(left, 8 * _PIECE))):
                    count += data.count(b'"')
                    left -= len(data)
            odd.append(count % 2)
        yield pa.RecordBatch.from_arrays([part.column("path"), part.column("start"), pa.array(odd, pa.int32())], ["path", "start", "odd"])


def ranges(files: DataFrame, encoding: str, size: int) -> DataFrame:
    """``files(path, length, ...)`` with a row for each range: ``start, end, inside`` (quotes at
    ``start``) and ``last``, dealt to as many partitions as its bytes need."""
    spark = files.sparkSession
    step = F.lit(size).cast("long") if splittable(encoding) else F.greatest("length", F.lit(1)).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), step)
    cut = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + step, F.col("length")).alias("end"), (s + step >= F.col("length")).alias("last")))
    n_bytes, n_ranges, n_cut = files.agg(F.sum("length"), F.sum(F.size(starts)), F.count_if(F.size(starts) > 1)).first()
    if not n_ranges:
        return files.select(*files.columns, F.inline(cut), F.lit(False).alias("inside"))
    cores = spark.sparkContext.defaultParallelism
    tasks = max(math.ceil(n_bytes / TASK_BYTES), math.ceil(n_ranges / TASK_RANGES), min(cores, math.ceil(n_bytes / _PIECE)), 1)
    placed = rank_within(files.select("path", F.inline(cut)), [], [F.desc(F.col("end") - F.col("start")), F.col("path"), F.col("start")], "place")
    dealt = placed.select("path", "start", "end", "last", ((F.col("place") - 1) % tasks).alias("task"))
    if n_cut:
        several = dealt.where(~F.col("last") | (F.col("start") > 0)).select("path", "start", "end", "task")
        odd = several.repartitionById(tasks, "task").mapInArrow(_odd_quotes, "path string, start long, odd int")
        before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        parity = odd.select("path", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
        dealt = dealt.join(parity, ["path", "start"], "left")
    else:
        dealt = dealt.withColumn("inside", F.lit(False))
    dealt = dealt.join(files, "path").repartitionById(tasks, "task")
    return dealt.select(*files.columns, "start", "end", "last", F.coalesce("inside", F.lit(False)).alias("inside"))


def _cut(f, at: int, inside: bool, file_end: int) -> int:
    """The end of the record that holds the byte before ``at``: behind the first line feed
    outside quotes at ``at - 1`` or later. ``inside``: quotes at ``at``."""
    if at <= 0:
        return 0
    f.seek(at - 1)
    first = f.read(1)
    if first == b"\n" and not inside:
        return at
    place, size = at, _FIRST_PIECE  # most records end soon
    while place < file_end:
        data = np.frombuffer(f.read(size), np.uint8)
        size = min(2 * size, _PIECE)
        if not len(data):
            break
        quoted = (np.cumsum(data == 0x22) + inside) % 2
        ends = np.flatnonzero((data == 0x0A) & (quoted == 0))
        if len(ends):
            return place + int(ends[0]) + 1
        inside = bool(quoted[-1])
        place += len(data)
    return file_end


class _Slice(io.RawIOBase):
    """The next ``left`` bytes of an open file."""

    def __init__(self, f, left: int):
        self.f, self.left = f, left

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.f.read(min(len(buffer), self.left))
        self.left -= len(data)
        buffer[:len(data)] = data
        return len(data)


def parse(data: io.RawIOBase, sep: str, encoding: str, whole: bool) -> Iterator[list[str]]:
    """The records of a slice; empty lines are none."""
    import csv
    text = io.TextIOWrapper(io.BufferedReader(data, _PIECE), encoding, "replace", newline="")
    csv.field_size_limit(2**31 - 1)
    try:
        yield from (r for r in csv.reader(text, delimiter=sep, strict=not whole) if r)
    except csv.Error as e:
        raise RecordError(f"a range does not end with a record, or a quote is unpaired: {e}") from e


def records(files: DataFrame, sep: str = ",", encoding: str = "UTF-8", size: int = RANGE_BYTES) -> DataFrame:
    """``path, table, layout, cells, wide`` for every record behind the header of
    ``files(path, length, table, layout, names, columns)``: ``names`` are those of the file's fields in
    order, and ``cells`` follow ``columns``, the table's; a column that the file lacks is null.
    ``wide`` marks records with more fields than names."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                fs, at = file_system(r["path"])
                with fs.open_input_file(at) as f:
                    begin = _cut(f, r["start"], r["inside"], r["length"])
                    end = r["length"] if r["last"] else _end_of(f, r, begin)
                    f.seek(begin)
                    whole = r["start"] == 0 and r["last"]
                    found = parse(_Slice(f, max(0, end - begin)), sep, plain_encoding(encoding) if begin == 0 else encoding, whole)
                    if begin == 0:
                        next(found, None)
                    place = {n: i for i, n in enumerate(r["names"])}
                    order, n_names = [place.get(c) for c in r["columns"]], len(r["names"])
                    rows, wide = [], []
                    for fields in found:
                        n = len(fields)
                        rows.append([fields[i] if i is not None and i < n else None for i in order])
                        wide.append(n > n_names)
                        if len(rows) == _ROWS:
                            yield _batch(r, rows, wide)
                            rows, wide = [], []
                    if rows:
                        yield _batch(r, rows, wide)

    cut = ranges(files.select("path", "length", "table", "layout", "names", "columns"), encoding, size)
    return cut.mapInArrow(run, "path string, table string, layout string, cells array<string>, wide boolean")


def _end_of(f, r: dict, begin: int) -> int:
    """Where the last record that starts in the range ends."""
    f.seek(r["start"])
    count, left = int(r["inside"]), r["end"] - r["start"]
    while left > 0 and (data := f.read(min(left, 8 * _PIECE))):
        count += data.count(b'"')
        left -= len(data)
    return max(begin, _cut(f, r["end"], count % 2 == 1, r["length"]))


def _batch(r: dict, rows: list, wide: list) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [*(pa.array([r[c]] * n, pa.string()) for c in ("path", "table", "layout")), pa.array(rows, pa.list_(pa.string())), pa.array(wide, pa.bool_())],
        ["path", "table", "layout", "cells", "wide"])
