"""Date dimension: one row per day with calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.functions.dates import date_attributes

# Fixed values of the commented-out warehouse dimension: 29,220 days from
# 1970-01-01 (generate_series 0..29219), i.e. through 2049-12-31.
DEFAULT_START = dt.date(1970, 1, 1)
DEFAULT_DAYS = 29220


def date_dimension(spark: SparkSession, start: dt.date = DEFAULT_START, n_days: int = DEFAULT_DAYS) -> DataFrame:
    """Days ``start .. start + n_days - 1``; ``spark.range`` spreads the rows
    over tasks (no single-row ``sequence`` explode)."""
    days = spark.range(0, n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return with_date_attributes(days, "d").drop("d")


def with_date_attributes(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns(date_attributes(F.col(date_col)))


def date_dimension_for(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar covering the date range of ``ts_col`` (min..max, one job for
    the bounds).  Its size is the number of days spanned, which the planner
    knows, so it decides whether to broadcast."""
    lo, hi = df.agg(F.min(F.to_date(ts_col)), F.max(F.to_date(ts_col))).first()
    if lo is None:
        return date_dimension(df.sparkSession, DEFAULT_START, 0)
    return date_dimension(df.sparkSession, lo, (hi - lo).days + 1)
