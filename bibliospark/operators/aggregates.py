"""Grouped aggregates of the warehouse questions and a column profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibliospark.operators.ordering import quantiles_by_group
from bibliospark.session import written_once


def count_by(df: DataFrame, keys: Sequence[str], col: str | None = None, name: str = "n") -> DataFrame:
    """``COUNT(col)`` (nulls ignored) or ``COUNT(*)`` per group."""
    c = F.count(F.col(col)) if col else F.count(F.lit(1))
    return df.groupBy(*keys).agg(c.alias(name))


def avg_by(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], count_name: str | None = None) -> DataFrame:
    """``AVG`` of several columns (source -> output name), plus ``COUNT(*)``."""
    aggs = [F.avg(s).alias(t) for s, t in cols.items()]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return df.groupBy(*keys).agg(*aggs)


def sum_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``."""
    return F.sum(F.when(cond, 1).otherwise(0))


def proportion_by(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column], distinct_col: str) -> DataFrame:
    """Per group: rows satisfying each condition / ``COUNT(DISTINCT distinct_col)``
    as double.  Numerator counts rows, denominator distinct values, so the
    ratio can exceed 1 when the join fans out (as in the reference query)."""
    denom = F.countDistinct(F.col(distinct_col)).cast("double")
    return df.groupBy(*keys).agg(*[(sum_if(c) / denom).alias(n) for n, c in conditions.items()])


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """The mergeable form of ``COUNT(DISTINCT id_col)``: (keys, bucket, bits,
    sums...), a bitmap per group and range of 32,768 ids.

    Ids should be dense (surrogate ids, ``stable_ids``): a bitmap has 4 KB.
    Bits are set by partial aggregation and the groups of one bucket meet once,
    whatever is rolled up from the table later (``distinct_rollup``).  Rows
    without an id count in the sums alone (bucket null)."""
    i = F.col(id_col)
    named = df.select(*keys, F.bitmap_bucket_number(i).alias("bucket"), F.bitmap_bit_position(i).alias("_bs_bit"),
                      *[c.alias(n) for n, c in (sums or {}).items()])
    return named.groupBy(*keys, "bucket").agg(
        F.bitmap_construct_agg("_bs_bit").alias("bits"), *[F.sum(n).cast("bigint").alias(n) for n in sums or {}])


def distinct_rollup(bitmaps: DataFrame, keys: Sequence[str], name: str, sums: Sequence[str] = ()) -> DataFrame:
    """Exact ``COUNT(DISTINCT)`` and sums by ``keys`` (any subset of the bitmaps' keys,
    also none), from ``distinct_bitmaps`` without reading the rows again."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), *[F.sum(n).alias(n) for n in sums])
    counted = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(F.lit(0))
    return merged.groupBy(*keys).agg(F.sum(counted).cast("bigint").alias(name), *[F.sum(n).cast("bigint").alias(n) for n in sums])


PROFILE_STATS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas ``describe().T``: one row per column with count, mean, sample
    std, min, exact quartiles (linear interpolation) and max.

    The rows are read once, into the number of occurrences of each column's
    distinct values (partial aggregation); everything else comes from that
    table.  Only ``len(cols)`` rows are built on the driver."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("g"), F.col(c).cast("double").alias("v")) for c in cols]))
    counts = df.select(cells.alias("c")).select("c.g", "c.v").dropna().groupBy("g", "v").agg(
        F.count(F.lit(1)).alias("n"))
    counts = written_once(counts, "profile-counts")
    moments = {r.g: r for r in counts.groupBy("g").agg(
        F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    mean = F.coalesce(*[F.when(F.col("g") == c, F.lit(m.mean)) for c, m in moments.items()], F.lit(0.0))
    off = F.col("v") - mean
    squares = {r.g: r.s for r in counts.groupBy("g").agg(F.sum(off * off * F.col("n")).alias("s")).collect()}
    quartiles = quantiles_by_group(counts, [0.25, 0.5, 0.75])
    rows = []
    for c in cols:
        m = moments.get(c)
        if m is None:
            rows.append((c, 0, *[None] * 7))
            continue
        std = (squares[c] / (m.n - 1)) ** 0.5 if m.n > 1 else None
        rows.append((c, m.n, m.mean, std, m.low, *quartiles[c], m.high))
    schema = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)
