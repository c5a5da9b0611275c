"""Exact line deduplication against levelled sorted runs of line hashes (operator 9).

The store keeps, for every line key seen so far, its hash and the smallest
document holding it.  It is a log-structured merge tree of Parquet runs, each
sorted by hash.  A new batch of documents is merge-anti-joined with the runs,
its own new keys become a level-0 run, and when a level holds ``fanout`` runs
they are compacted into one run of the next level.

Hashes have 96 bits, so distinct lines do not meet in practice even among
10^11 of them.  A line that a third of all documents hold costs one row per
task (partial aggregation), and drop decisions are joined on (hash, document),
which no single hot line can skew.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, as_binary, saved, scratch, unused

BLANK = b" \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
KEY = ["k1", "k2"]


def _digest(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the line's key, or None if the key is shorter than ``min_chars`` code points."""
    key = line.strip(BLANK).lower()  # bytes.lower() changes A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, k1, k2): the distinct line keys of each document; documents without an id hold none."""

    def run(batches):
        for batch in batches:
            ids, raw = [], []
            for d, t in zip(batch.column(0).to_pylist(), as_binary(batch, "text")):
                found = {_digest(x, min_chars) for x in (t or b"").split(b"\n")}
                found.discard(None)
                raw += found
                ids.append((d, len(found)))
            if not raw:
                continue
            both = np.frombuffer(b"".join(raw), dtype=[("k1", "<i8"), ("k2", "<i4"), ("rest", "<i4")])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([d for d, _ in ids], [n for _, n in ids]).astype(np.int64)),
                    pa.array(np.ascontiguousarray(both["k1"])),
                    pa.array(np.ascontiguousarray(both["k2"])),
                ],
                names=["doc_id", *KEY],
            )

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(named.filter("doc_id is not null"), run, "doc_id long, k1 long, k2 int")


class LineRuns:
    """Levels of sorted runs (k1, k2, owner); the newest level comes first."""

    def __init__(self, fanout: int = 3) -> None:
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = [[]]

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch (doc_id, k1, k2); return its lines to drop, as (doc_id, k1, k2).

        The batch's documents must come after those of earlier batches: a key
        belongs to the first batch that has it, and there to its smallest
        document.
        """
        owners = lines.groupBy(*KEY).agg(F.min("doc_id").alias("owner"))
        unseen = reduce(lambda left, run: left.join(run, KEY, "left_anti"), self.runs, owners)
        new = self._write(unseen)
        self.levels[0].append(new)
        self._compact()
        kept = new.withColumnRenamed("owner", "doc_id")
        return lines.join(kept, [*KEY, "doc_id"], "left_anti")

    def _write(self, rows: DataFrame) -> DataFrame:
        return saved(rows.repartition(*KEY).sortWithinPartitions(*KEY), "run")

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(reduce(DataFrame.unionByName, level)))
                self.levels[i] = []


def lines_to_drop(
    docs: DataFrame, batches: int = 4, fanout: int = 3, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, k1, k2) of every line that a smaller document holds as well.

    The documents come as ``batches`` ranges of ascending ids; a batch is a
    share of the input, not a fixed number of rows.
    """
    spark = docs.sparkSession
    shares = [i / batches for i in range(1, batches)]
    ids = docs.select(F.col(doc_id).cast("long").alias("d"))
    bounds = sorted(set(ids.approxQuantile("d", shares, 0.01))) if shares else []
    number = sum([(F.col("doc_id") > F.lit(int(b))).cast("int") for b in bounds], F.lit(0))
    path = scratch(spark, "lines")
    keyed = line_keys(docs, min_chars, doc_id, text).withColumn("batch", number)
    keyed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, k1 long, k2 int, batch int").parquet(path)
    store = LineRuns(fanout)
    drops = [store.add(lines.filter(F.col("batch") == i).drop("batch")) for i in range(len(bounds) + 1)]
    return reduce(DataFrame.unionByName, drops)


def _split(text: bytes | None, drop: set[int], min_chars: int) -> tuple[list[bytes], int]:
    """The lines that stay and the number of all lines; null and empty texts are one empty line."""
    lines = (text or b"").split(b"\n")
    if not drop:
        return lines, len(lines)
    kept = []
    for x in lines:
        d = _digest(x, min_chars)
        if d is None or int.from_bytes(d[:8], "little", signed=True) not in drop:
            kept.append(x)
    return kept, len(lines)


def _with_drops(docs: DataFrame, drops: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` with the hashes of each row's lines to drop as a last column."""
    owner, drop = unused(docs, "owner"), unused(docs, "drop")
    per_doc = drops.groupBy(F.col("doc_id").alias(owner)).agg(F.collect_list("k1").alias(drop))
    return docs.join(per_doc, F.col(doc_id).cast("long") == F.col(owner), "left").drop(owner)


def dedup_lines(
    docs: DataFrame, batches: int = 4, fanout: int = 3, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text",
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``; all rows and all other columns stay.

    With ``drop_emptied`` a document that loses lines and has nothing but
    blanks left goes: all it said is in smaller documents.

    A line is keyed by its content without outer ASCII blanks, A-Z lower-cased.
    Keys of at least ``min_chars`` code points stay only in the smallest
    document that holds them (there with all their repeats).  A null text
    stays null; a text whose lines all go becomes empty; rows without a doc_id
    are left as they are; repeated rows of one doc_id count as one document.
    """
    drops = lines_to_drop(docs, batches, fanout, min_chars, doc_id, text)
    joined = _with_drops(docs, drops, doc_id)

    def run(batches_):
        for batch in batches_:
            at = batch.schema.get_field_index(text)
            out, stays = [], []
            for t, drop in zip(as_binary(batch, text), batch.column(batch.num_columns - 1).to_pylist()):
                left = t if t is None else b"\n".join(_split(t, set(drop or ()), min_chars)[0])
                out.append(None if left is None else left.decode())
                stays.append(not (drop_emptied and drop and not left.strip(BLANK)))
            columns = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            made = pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]).set(at, pa.field(text, pa.string())))
            yield made.filter(pa.array(stays, pa.bool_())) if drop_emptied else made

    return arrow_map(joined, run, docs.schema)


def line_digest(
    docs: DataFrame, batches: int = 4, fanout: int = 3, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: n_lines, n_dropped, kept_sha256 of the text that ``dedup_lines`` leaves (null: empty)."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = _with_drops(named, lines_to_drop(named, batches, fanout, min_chars), "doc_id")

    def run(batches_):
        for batch in batches_:
            made = []
            for t, drop in zip(as_binary(batch, "text"), batch.column(2).to_pylist()):
                kept, n = _split(t, set(drop or ()), min_chars)
                made.append((n, n - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([m[0] for m in made], pa.int64()),
                    pa.array([m[1] for m in made], pa.int64()),
                    pa.array([m[2] for m in made], pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return arrow_map(joined, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
