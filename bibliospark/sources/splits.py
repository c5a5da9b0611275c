"""Files whose records hide their ends, cut in parallel byte ranges.

A JSON object of millions of entries, or a CSV table with line breaks inside
quotes, has record ends that only the text before them can tell.  Spark's text
reader splits any file at a separator (``lineSep``), so two scans suffice:

1. each byte range sums up what it does to the reader's state, for either
   state it may begin in: quotes toggle inside/outside, brackets outside
   quotes change the depth, record ends are counted by relative depth;
2. these summaries (one small row per byte range) compose in file order, which
   gives every range the state it begins in and the number of its first
   record; then each range cuts its records, and the few that reach over range
   ends are put together by their number.

Rows are read in file order within a range, whatever task or executor reads
it, so a lost range can be read again.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.session import ship_package

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_KIND = "file long, block long, number long, begins boolean, ends boolean, last boolean, text string"
_PIECE = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("number", pa.int64()), ("begins", pa.bool_()),
                    ("ends", pa.bool_()), ("last", pa.bool_()), ("text", pa.string())])


class MalformedFile(ValueError):
    """A file that ends inside a record."""


def _segments(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, block, size, value): the text between separators, in file order within (file, block)."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", sep).text(path).select(
        F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block"),
        meta["file_size"].alias("size"), F.col("value").cast("binary").alias("value"),
    )


class JsonEnds:
    """Ends of the entries of a JSON object: a brace outside quotes that closes to depth 1 or 0."""

    sep = b"}"

    def __init__(self) -> None:
        self.inside, self.depth = 0, 0

    def end(self, value: bytes) -> int | None:
        """Reads a segment and its separator; the depth after a brace that closed something, else None."""
        bare = _ESCAPED.sub(b"", value) if b"\\" in value else value
        parts = bare.split(b'"')
        out = b"".join(parts[self.inside :: 2])
        self.inside = (self.inside + len(parts) - 1) % 2
        self.depth += out.count(b"{") + out.count(b"[") - out.count(b"]")
        if self.inside:
            return None
        self.depth -= 1
        return self.depth

    @staticmethod
    def cuts(depth: int) -> bool:
        return depth in (0, 1)

    @staticmethod
    def check(inside: int, depth: int, missing: int) -> bool:
        return not inside and depth == -missing


class CsvEnds:
    """Ends of CSV records: a line break outside quotes (quotes in quoted fields are doubled)."""

    sep = b"\n"

    def __init__(self) -> None:
        self.inside, self.depth = 0, 0

    def end(self, value: bytes) -> int | None:
        self.inside = (self.inside + value.count(b'"')) % 2
        return None if self.inside else 0

    @staticmethod
    def cuts(depth: int) -> bool:
        return True

    @staticmethod
    def check(inside: int, depth: int, missing: int) -> bool:
        return not inside


def _runs(batches) -> Iterator[tuple[tuple[int, int], int, bytes]]:
    for batch in batches:
        yield from zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist(), batch.column(3).to_pylist())


def _summaries(segments: DataFrame, ends: type) -> list:
    """One row per byte range: its bytes, and for either starting state what it does (bounded by the number of ranges)."""

    def run(batches):
        made, at, both, counts, size, held = [], None, None, None, 0, 0

        def add():
            if at is not None:
                effect = json.dumps([[e.inside, e.depth, list(c.items())] for e, c in zip(both, counts)])
                made.append((*at, size, held, effect))

        for key, file_size, value in _runs(batches):
            if key != at:
                add()
                at, size, held = key, file_size, 0
                both, counts = (ends(), ends()), (Counter(), Counter())
                both[1].inside = 1
            held += len(value) + 1
            for e, c in zip(both, counts):
                if (depth := e.end(value)) is not None:
                    c[depth] += 1
        add()
        names = ["file", "block", "size", "held", "effect"]
        kinds = [pa.int64()] * 4 + [pa.string()]
        columns = list(zip(*made)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return segments.mapInArrow(run, "file long, block long, size long, held long, effect string").collect()


def _starts(rows: list, ends: type, path: str) -> dict:
    """(file, block) -> state at its start: inside quotes, depth, number of the first record that goes on or begins there."""
    out, last = {}, {}
    for r in sorted(rows, key=lambda r: (r.file, r.block)):
        inside, depth, number, held = last.get(r.file, (0, 0, 0, 0))
        out[r.file, r.block] = (inside, depth, number)
        after, change, counts = json.loads(r.effect)[inside]
        number += sum(n for d, n in counts if ends.cuts(depth + d))
        last[r.file] = (after, depth + change, number, held + r.held)
    for file, (inside, depth, _, held) in last.items():
        missing = held - next(r.size for r in rows if r.file == file)  # 1 if the file does not end with the separator
        if not ends.check(inside, depth, missing):
            raise MalformedFile(f"a file of {path} ends inside a record ({'in quotes' if inside else f'depth {depth + missing}'})")
    return out


def records(spark: SparkSession, path: str, ends: type) -> DataFrame:
    """(file, number, last, text): the records of all files of ``path``, numbered within their file from 0.

    ``text`` keeps the separators; what follows the last end of a file is a
    record, too, unless it is blank.
    """
    ship_package(spark)
    segments = _segments(spark, path, ends.sep.decode())
    starts = spark.sparkContext.broadcast(_starts(_summaries(segments, ends), ends, path))

    def run(batches):
        rows, parts, at, reader, number, begins, size = [], [], None, None, 0, True, 0

        def piece(done, last):
            nonlocal size
            text = b"".join(parts)
            parts.clear()
            size += len(text)
            rows.append((*at, number, begins, done, last, text.decode("utf-8", "replace")))

        def batch():
            nonlocal size
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)
            rows.clear()
            size = 0
            return made

        for key, _, value in _runs(batches):
            if key != at:
                if parts:
                    piece(False, False)
                at, reader = key, ends()
                reader.inside, reader.depth, number = starts.value[key]
                begins = not (key[1] or number)  # else the record may have begun in an earlier range
            parts += (value, ends.sep)
            depth = reader.end(value)
            if depth is not None and depth < 0:  # beyond the end of the object: no separator was there
                parts.pop()
                if not value.strip():
                    parts.clear()
            if depth is not None and ends.cuts(depth):
                piece(True, depth == 0)
                number, begins = number + 1, True
                if size > 1 << 20:
                    yield batch()
        if parts:
            piece(False, False)
        if rows:
            yield batch()

    pieces = segments.mapInArrow(run, _KIND)
    whole = pieces.filter("begins and ends").select("file", "number", "last", "text")
    over = pieces.filter("not (begins and ends)").groupBy("file", "number").agg(
        F.max("last").alias("last"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    return whole.unionByName(over.select("file", "number", "last", F.array_join(F.col("parts.text"), "").alias("text")))
