"""Equi joins used by the pipelines: lookups, star joins, null-safe merges.

No side is hinted: the planner broadcasts what it knows to be small, and AQE
converts a join to broadcast from the actual shuffle size and splits skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """Deterministic dedupe of a lookup: per key, the least row (partial agg)."""
    rest = [c for c in lookup.columns if c != key]
    if not rest:
        return lookup.distinct()
    return lookup.groupBy(key).agg(F.min(F.struct(*rest)).alias("_bs_m")).select(key, "_bs_m.*")


def enrich_by_lookup(df: DataFrame, lookup: DataFrame, key: str, mapping: Mapping[str, str] | None = None,
                     lookup_key: str | None = None) -> DataFrame:
    """Left join metadata by ``key``; a missing key gives nulls.

    ``mapping`` renames lookup columns (source -> output); the lookup is
    reduced to one row per key first so the join cannot multiply rows."""
    lk = lookup_key or key
    lookup = one_row_per_key(lookup.dropna(subset=[lk]), lk)
    if mapping:
        lookup = lookup.select(lk, *[F.col(s).alias(t) for s, t in mapping.items()])
    if lk != key:
        lookup = lookup.withColumnRenamed(lk, key)
    return df.join(lookup, key, "left")


def lookup_exact(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equality lookup (e.g. first name -> gender), inner by default: a row
    without a lookup entry is skipped."""
    lk = lookup.withColumnRenamed(right_key, "_bs_rk") if right_key == left_key else lookup
    rk = "_bs_rk" if right_key == left_key else right_key
    out = df.join(lk, F.col(left_key) == F.col(rk), how)
    return out.drop(rk) if rk == "_bs_rk" else out


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where a null key matches a null key (``<=>``); still an
    equi join (hash / sort-merge), not a nested loop.  Keys appear once."""
    r = right.select(*[F.col(k).alias(f"_bs_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_bs_r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_bs_r_{k}" for k in keys])


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas-style left merge: a null key matches a null key."""
    return null_safe_join(left, right, keys, "left")


def join_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """Chain ``fact`` with each (dim, fact_key, dim_key); dim columns other than
    the key are appended."""
    out = fact
    for dim, fk, dk in dims:
        d = dim.withColumnRenamed(dk, "_bs_dk")
        out = out.join(d, F.col(fk) == F.col("_bs_dk"), how).drop("_bs_dk")
    return out
