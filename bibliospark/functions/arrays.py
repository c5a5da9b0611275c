"""Array helpers: positional ends of an array (not ordered by value)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibliospark.functions._util import as_col


def first_last(arr, field: str | None = None) -> tuple[Column, Column]:
    """(first, last) element by array position, or their ``field`` for struct
    elements.  Empty or null arrays give nulls (``try_element_at``)."""
    a = as_col(arr)
    first, last = F.try_element_at(a, F.lit(1)), F.try_element_at(a, F.lit(-1))
    if field is not None:
        first, last = first.getField(field), last.getField(field)
    return first, last


def first_or_null(arr) -> Column:
    """``x[0] if x else None``."""
    return F.try_element_at(as_col(arr), F.lit(1))
