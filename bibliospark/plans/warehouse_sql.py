"""The user's own SQL over warehouse tables, with bound named arguments.

The stored questions are DataFrame functions (``warehouse_queries``).  A rank
over a whole table belongs to ``operators.global_rank``: as SQL text, ``RANK()
OVER (ORDER BY ...)`` without a partition runs in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(tables: Mapping[str, DataFrame]) -> None:
    """Expose every DataFrame as a temp view of its name."""
    for name, df in tables.items():
        if isinstance(df, DataFrame):
            df.createOrReplaceTempView(name)


def ask(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Run ``sql`` with its ``:name`` parameters bound to ``args`` (no string splicing)."""
    return spark.sql(sql, args=args)
