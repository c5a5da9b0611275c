"""Bloom filters of key sets, kept as tables, and the exact joins that use them.

A filter is a table of blocks of 512 bits: a key's first hash names its block,
its second sets one bit in each of the block's eight words.  Blocks are built
by ``bit_or`` (partial aggregation, so a hot key is one row per task), written
with the key table, loaded again, and extended by later keys.

``filtered_not_in`` and ``filtered_in`` first test every row against the
broadcast blocks.  A row that the filter rules out has no equal key, so only
possible members are shuffled and compared in full: results are exact
whatever the filter's rate of false positives.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.operators.dedupe import row_not_in

WORDS, WORD_BITS = 8, 64
MAX_BLOCKS = 1 << 18   # 72 bytes each: what is broadcast stays below 20 MB of data for any number of keys
_BLOCK = "_bs_block"
_W = [f"_bs_w{i}" for i in range(WORDS)]


def _hash_parts(cols: Sequence[str]) -> list[Column]:
    return [*map(F.col, cols), *[F.col(c).isNull() for c in cols]]   # the hash skips nulls: their places are hashed too


def _block(cols: Sequence[str], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(*_hash_parts(cols)), F.lit(n_blocks).cast("bigint"))


def _bits(cols: Sequence[str]) -> list[Column]:
    """The key's bit in each word, as the word with only that bit."""
    h = F.xxhash64(F.lit(1), *_hash_parts(cols))
    one, step = F.lit(1).cast("bigint"), WORD_BITS.bit_length() - 1
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, step * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int"))
            for i in range(WORDS)]


def _merged(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy(_BLOCK).agg(*[F.bit_or(w).alias(w) for w in _W])


@dataclass(frozen=True)
class KeyFilter:
    """``blocks`` (one row per block that has a key, and block 0) out of ``n_blocks``; ``types`` of the key columns."""

    blocks: DataFrame
    n_blocks: int
    types: tuple[str, ...]

    def extended(self, keys: DataFrame, cols: Sequence[str]) -> KeyFilter:
        """With the keys of a later load.  The number of blocks stays, so false positives grow with the keys."""
        self.check(keys, cols)
        return KeyFilter(_merged(self.blocks.unionByName(_key_blocks(keys, cols, self.n_blocks))), self.n_blocks, self.types)

    def save(self, path: str) -> None:
        self.blocks.withColumns({"n_blocks": F.lit(self.n_blocks), "types": F.array(*map(F.lit, self.types))}).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KeyFilter:
        table = spark.read.parquet(path)
        about = table.select("n_blocks", "types").first()
        return KeyFilter(table.select(_BLOCK, *_W), about.n_blocks, tuple(about.types))

    def check(self, df: DataFrame, cols: Sequence[str]) -> None:
        """Equal values of different types hash differently, so types must be those of the keys."""
        types = tuple(df.schema[c].dataType.simpleString() for c in cols)
        if types != self.types:
            raise ValueError(f"columns {list(cols)} are {types}, the filter's keys are {self.types}: cast them first")

    def probed(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` with ``_bs_maybe``: false where no key equals the row's tuple (nulls equal)."""
        self.check(df, cols)
        hit = None
        for word, bit in zip(_W, _bits(cols)):
            e = F.col(word).bitwiseAND(bit) != 0
            hit = e if hit is None else hit & e
        tested = df.withColumn(_BLOCK, _block(cols, self.n_blocks)).join(F.broadcast(self.blocks), _BLOCK, "left")
        return tested.withColumn("_bs_maybe", F.coalesce(hit, F.lit(False))).select(*df.columns, "_bs_maybe")


def _key_blocks(keys: DataFrame, cols: Sequence[str], n_blocks: int) -> DataFrame:
    """Block rows of the keys; block 0 is always there, so that a table of no keys still tells its size."""
    rows = keys.select(_block(cols, n_blocks).alias(_BLOCK), *[b.alias(w) for w, b in zip(_W, _bits(cols))])
    zero = F.lit(0).cast("bigint")
    return _merged(rows.unionByName(keys.sparkSession.range(1).select(zero.alias(_BLOCK), *[zero.alias(w) for w in _W])))


def key_filter(keys: DataFrame, cols: Sequence[str], bits_per_key: int = 16, max_blocks: int = MAX_BLOCKS) -> KeyFilter:
    """The filter of ``keys``' tuples ``cols``, sized by their approximate number.

    At 16 bits per key fewer than 1 in 100 other rows pass.  ``max_blocks``
    bounds what is broadcast; beyond it more rows pass (and are compared in
    full), none is lost."""
    n = keys.agg(F.approx_count_distinct(F.xxhash64(*_hash_parts(cols)))).first()[0]
    n_blocks = max(1, min(max_blocks, math.ceil(n * bits_per_key / (WORDS * WORD_BITS))))
    return KeyFilter(_key_blocks(keys, cols, n_blocks), n_blocks, tuple(keys.schema[c].dataType.simpleString() for c in cols))


def filtered_not_in(df: DataFrame, keys: DataFrame, cols: Sequence[str], kept: KeyFilter,
                    key_cols: Sequence[str] | None = None) -> DataFrame:
    """``row_not_in(df, keys, cols, key_cols)`` with ``kept``, a filter of (at least) ``keys``.

    Rows that the filter rules out pass without a shuffle; the others are
    anti joined.  ``df`` is read twice, so it has to be the same both times
    (a table, or something written)."""
    tested = kept.probed(df, cols)
    ruled_out = tested.filter(~F.col("_bs_maybe")).drop("_bs_maybe")
    possible = tested.filter("_bs_maybe").drop("_bs_maybe")
    return ruled_out.unionByName(row_not_in(possible, keys, cols, key_cols))


def filtered_in(df: DataFrame, keys: DataFrame, cols: Sequence[str], kept: KeyFilter,
                key_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose tuple occurs in ``keys`` (nulls equal): only possible members are shuffled, ``df`` is read once."""
    possible = kept.probed(df, cols).filter("_bs_maybe").drop("_bs_maybe")
    key_cols = list(key_cols or cols)
    named = keys.select(*[F.col(k).alias(f"_bs_s{i}") for i, k in enumerate(key_cols)])
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"_bs_s{i}"))
        cond = e if cond is None else cond & e
    return possible.join(named, cond, "left_semi")
