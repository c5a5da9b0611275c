"""Integrity audits standing in for the warehouse's declared constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    pass


def audit_unique(df: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """Primary key check: key tuples occurring more than once (with their
    count) plus a row per null key tuple group.  ``strict`` raises."""
    any_null = None
    for k in keys:
        e = F.col(k).isNull()
        any_null = e if any_null is None else any_null | e
    bad = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reason", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate")))
        .filter(any_null | (F.col("n") > 1))
    )
    if strict and not bad.isEmpty():
        raise IntegrityError(f"primary key {list(keys)} violated")
    return bad


def audit_reference(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                    parent_keys: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Foreign key check (MATCH SIMPLE): child rows whose non-null key tuple has
    no parent.  ``strict=True`` mirrors a validated constraint (raises);
    ``strict=False`` mirrors ``NOT VALID`` (report only)."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(a).alias(f"_bs_p{i}") for i, a in enumerate(parent_keys)]).distinct()
    cond = None
    for i, c in enumerate(child_keys):
        e = F.col(c) == F.col(f"_bs_p{i}")
        cond = e if cond is None else cond & e
    orphans = child.dropna(subset=list(child_keys)).join(p, cond, "left_anti")
    if strict and not orphans.isEmpty():
        raise IntegrityError(f"foreign key {list(child_keys)} -> {parent_keys} violated")
    return orphans


def reference_summary(orphans: DataFrame, child_keys: Sequence[str]) -> DataFrame:
    """One row: orphan rows and distinct orphan key tuples."""
    return orphans.agg(
        F.count(F.lit(1)).alias("orphan_rows"),
        F.count_distinct(*[F.col(k) for k in child_keys]).alias("orphan_keys"),
    )


def audit_column(df: DataFrame, col: str, not_null: bool = True, max_len: int | None = None) -> DataFrame:
    """NOT NULL / VARCHAR(n) check: one row with the violation counts."""
    c = F.col(col)
    return df.agg(
        F.sum(F.when(c.isNull(), 1).otherwise(0) if not_null else F.lit(0)).cast("bigint").alias("null_rows"),
        F.sum(F.when(F.char_length(c) > max_len, 1).otherwise(0) if max_len is not None else F.lit(0))
        .cast("bigint").alias("too_long_rows"),
    )


def audit_key_space(primary: Mapping[str, tuple[DataFrame, str]], foreign: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """All key constraints over one key space, in one aggregate: (audit, violations).

    ``primary`` maps a name to a table and its key column; ``foreign`` a name
    to a table, its column and the name of the primary key it refers to.
    The keys of all tables meet once, tagged and counted (partial aggregation);
    there each key shows how often every table has it.  Counts are those of
    ``audit_unique`` (keys that occur twice, a null key) and of
    ``audit_reference`` (rows with a key that its parent lacks; nulls pass)."""
    tables = {**{n: (df, c) for n, (df, c) in primary.items()}, **{n: (df, c) for n, (df, c, _) in foreign.items()}}
    tagged = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("k"), F.lit(n).alias("t")) for n, (df, c) in tables.items()])
    held = {n: F.sum(F.when(F.col("t") == n, 1).otherwise(0)).alias(n) for n in tables}
    by_key = tagged.groupBy("k").agg(*held.values())
    null = F.col("k").isNull()
    bad = {n: F.when((F.col(n) > 1) | (null & (F.col(n) > 0)), 1) for n in primary}
    bad |= {n: F.when(~null & (F.col(parent) == 0), F.col(n)) for n, (_, _, parent) in foreign.items()}
    totals = by_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in bad.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("audit"), F.col(n).alias("violations")) for n in bad])
    return totals.select(F.explode(pairs).alias("p")).select("p.*")
