"""Deduplication: drop every member of a duplicate group, DISTINCT ON, NOT IN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from bibliospark.operators.ordering import OrderSpec, sort_col
from bibliospark.session import written_once


def _exact_singletons(df: DataFrame, keys: Sequence[str], rest: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows whose full ``keys`` tuple occurs once (nulls equal).  A hot
    duplicate group collapses map-side to one partial row per task; the
    excluded columns of a singleton are exact (its group has one row)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_bs_n"), *[F.first(c).alias(c) for c in rest])
        .filter(F.col("_bs_n") == 1)
        .select(*order)
    )


def _has_map(t) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def drop_all_duplicates(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Remove *all* rows of any group that repeats over the non-excluded
    columns (pandas ``duplicated(keep=False)``); nulls compare equal.

    Two scans: the first counts 128-bit hashes of the rows (two seeds of
    xxhash64, partial aggregation, so a hot group is one row per task) and
    keeps those seen more than once; the second drops the rows that have one
    of them.  Only hashes are aggregated; the rows themselves pass without a
    shuffle while Spark finds the repeated hashes small enough to broadcast,
    and are joined by hash otherwise.  Map columns, which Spark cannot hash,
    take the grouping on full values instead."""
    excluded = set(exclude)
    keys = [c for c in df.columns if c not in excluded]
    rest = [c for c in df.columns if c in excluded]
    if any(_has_map(df.schema[c].dataType) for c in keys):
        return _exact_singletons(df, keys, rest, df.columns)
    # nulls are skipped by the hash: their positions are hashed as well
    parts = [*keys, *[F.col(c).isNull() for c in keys]]
    hashed = df.withColumns({"_bs_h1": F.xxhash64(*parts), "_bs_h2": F.xxhash64(F.lit(1), *parts)})
    counts = hashed.groupBy("_bs_h1", "_bs_h2").agg(F.count(F.lit(1)).alias("n"))
    repeated = written_once(counts.filter("n > 1").drop("n"), "repeated-rows")
    return hashed.join(repeated, ["_bs_h1", "_bs_h2"], "left_anti").select(*df.columns)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``: the first row per key.

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task forwards at most one row per key."""
    w = Window.partitionBy(*keys).orderBy(*[sort_col(s) for s in order])
    return df.withColumn("_bs_rn", F.row_number().over(w)).filter("_bs_rn = 1").drop("_bs_rn")


def row_not_in(df: DataFrame, sub: DataFrame, cols: Sequence[str], sub_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose tuple ``cols`` does not occur in ``sub`` (set difference,
    ``left_anti``).  Tuples compare null-safely: the SQL three-valued
    ``NOT IN`` would keep nothing once the subquery holds a null; this keeps
    the rows that are absent as values (deviation documented in README)."""
    sub_cols = list(sub_cols or cols)
    s = sub.select(*[F.col(a).alias(f"_bs_s{i}") for i, a in enumerate(sub_cols)]).distinct()
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"_bs_s{i}"))
        cond = e if cond is None else cond & e
    return df.join(s, cond, "left_anti")
