"""Row filters and column preparation (P1 / P2 cleaning steps)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bibliospark.operators.ordering import OrderSpec, sort_col


def drop_columns(df: DataFrame, cols: Sequence[str], all_or_none: bool = False) -> DataFrame:
    """Drop columns.  Default ignores absent ones; ``all_or_none=True`` keeps
    the reference behaviour of dropping nothing when any is missing."""
    if all_or_none and not set(cols) <= set(df.columns):
        return df
    return df.drop(*cols)


def min_length(df: DataFrame, col: str, n: int = 35) -> DataFrame:
    """Keep rows whose ``col`` has at least ``n`` characters (untrimmed); null goes."""
    return df.filter(F.char_length(F.col(col)) >= n)


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def nullify(df: DataFrame, token: str = "None", cols: Sequence[str] | None = None) -> DataFrame:
    """Replace the literal ``token`` by null in every string column (or ``cols``)."""
    targets = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(token)) for c in targets})


def head_n(df: DataFrame, n: int, order: Sequence[OrderSpec]) -> DataFrame:
    """First ``n`` rows in an explicit order (Spark rows have no stored order)."""
    return df.orderBy(*[sort_col(s) for s in order]).limit(n)
