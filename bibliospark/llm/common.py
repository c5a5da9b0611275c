"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bibliospark.session import ensure_checkpoint_dir, ship_package

# A-Z to a-z and nothing else, as the text contracts ask
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts lineage like ``checkpoint()`` (any executor can reread the files),
    keeps columns prunable, and gives the planner the true size, so that
    Spark itself decides which side of a later join is small enough to
    broadcast.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or something like it that no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


SALTS = 32


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with the few rows that ``table`` has of their ``keys``, however many share a key.

    Where ``table`` is a written one that Spark broadcasts, that is all.
    Otherwise rows are dealt by key and a salt (from column ``by``); ``table``
    is copied only to the salts that occur, by way of one row per key and salt.
    ``rows`` is then read twice and should be written or cheap.
    """
    plan = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(plan)) <= _broadcast_bytes(table.sparkSession):
        return rows.join(table, keys, how)
    salt = unused(rows, "salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)))
    return salted.join(salted.select(*keys, salt).distinct().join(table, keys), [*keys, salt], how).drop(salt)


def _broadcast_bytes(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def hash_share(hash_: Column, share: Column | float) -> Column:
    """Whether a row is in the ``share`` of smallest 64-bit hashes.

    Bounded samples ("the n rows of smallest hash") first keep a share that
    holds about twice as many, so that only those rows meet to be ranked."""
    return hash_.cast("double") / 2.0**64 + 0.5 < share


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` would change İ or É)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


# Texts can be long: batches handed to Python are bounded by bytes, unless the session says otherwise.
_BATCH_BYTES, _SPARK_DEFAULT, _OURS = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20), "4m"


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` over small batches; a task gives back its buffers when it ends."""
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(_BATCH_BYTES).rstrip("b") == _SPARK_DEFAULT:
        conf.set(_BATCH_BYTES, _OURS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def as_binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column's UTF-8 bytes, without decoding them."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


# Hashes of words seen by a Python worker; the memory starts afresh beyond it.
_WORDS: dict[bytes, int] = {}
_MEMORY = 200_000


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes (uint64) of the words, in order."""
    distinct = set(words)
    new = distinct.difference(_WORDS)
    if len(_WORDS) + len(new) > _MEMORY:
        _WORDS.clear()
        new = distinct
    for w in new:
        _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
