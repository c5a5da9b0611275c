"""Flattening nested arrays and surrogate id assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibliospark.functions.dates import parse_rfc1123
from bibliospark.functions.text import join_tail
from bibliospark.operators.ordering import OrderSpec, global_prefix_sum, global_row_number


def flatten_authors(df: DataFrame, id_col: str = "id", arr: str = "authors_parsed",
                    surname: str = "Surname", names: str = "Names") -> DataFrame:
    """One row per parsed author: (id, pos, Surname, Names) with Surname the
    first element and Names the rest joined by a blank (``' '.join(a[1:])``)."""
    return (
        df.select(F.col(id_col), F.posexplode(F.col(arr)).alias("pos", "_bs_a"))
        .select(
            id_col,
            "pos",
            F.try_element_at(F.col("_bs_a"), F.lit(1)).alias(surname),
            join_tail("_bs_a").alias(names),
        )
    )


def assign_first_position_ids(flat: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec],
                              name: str = "author_id") -> DataFrame:
    """id of each distinct ``keys`` tuple = 0-based position of its first
    occurrence in the flattened list ordered by ``order`` (ids have gaps).

    Positions come from the distributed row number; the min per tuple is a
    partial aggregation (a hot name costs one partial row per task)."""
    pos = global_row_number(flat.select(*keys, *[o if isinstance(o, str) else o[0] for o in order]),
                            order, "_bs_pos", start=0)
    return pos.groupBy(*keys).agg(F.min("_bs_pos").alias(name)).select(name, *keys)


def author_ids(pubs: DataFrame, id_col: str = "id", arr: str = "authors_parsed", surname: str = "Surname",
               names: str = "Names", name: str = "author_id") -> DataFrame:
    """``assign_first_position_ids(flatten_authors(pubs), ...)`` computed
    from one row per *publication*, not per author occurrence.

    The flattened position of author k of publication p is (sum of array
    sizes of publications before p) + k.  Only publications are numbered
    (a prefix sum of their array sizes); each author's first occurrence
    (least (id, pos)) is a partial aggregation, joined to its offset."""
    sizes = pubs.select(id_col, F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(0)).alias("_bs_n"))
    offsets = global_prefix_sum(sizes, [id_col], "_bs_n", "_bs_start").select(id_col, "_bs_start")
    firsts = (
        flatten_authors(pubs, id_col, arr, surname, names)
        .groupBy(surname, names)
        .agg(F.min(F.struct(id_col, "pos")).alias("_bs_f"))
        .select(surname, names, F.col("_bs_f").getField(id_col).alias(id_col), F.col("_bs_f.pos").alias("pos"))
    )
    return firsts.join(offsets, id_col).select((F.col("_bs_start") + F.col("pos")).cast("bigint").alias(name),
                                               surname, names)


def flatten_versions(df: DataFrame, id_col: str = "id", arr: str = "versions", field: str = "created",
                     out: str = "version") -> DataFrame:
    """One row per version: (id, version timestamp parsed from RFC-1123 text)."""
    return df.select(F.col(id_col), F.explode(F.col(arr)).alias("_bs_v")).select(
        id_col, parse_rfc1123(F.col("_bs_v").getField(field)).alias(out)
    )


def dim_first_seen(df: DataFrame, col: str, order_col: str, id_name: str, name_name: str) -> DataFrame:
    """Ids 0..n-1 over distinct values in first-seen order; null is a value.
    Values first seen at the same order value are ordered by themselves."""
    first = df.groupBy(col).agg(F.min(order_col).alias("_bs_first"))
    return global_row_number(first, ["_bs_first", col], id_name, start=0).select(
        id_name, F.col(col).alias(name_name)
    )


def dim_per_row(df: DataFrame, col: str, order: Sequence[OrderSpec], id_name: str, name_name: str,
                sort_col: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY sort_col), col`` over *all* rows (the
    reference's dimension form: one row per input row).  ``sort_col``
    defaults to ``col``; the reference's discipline dimension sorts by
    another column.  ``order`` completes the order to a total one."""
    sort_col = sort_col or col
    spec = [(sort_col, "asc_nulls_last"), *order]
    cols = [col, sort_col] + [o if isinstance(o, str) else o[0] for o in order]
    return global_row_number(df.select(*dict.fromkeys(cols)), spec, id_name).select(
        id_name, F.col(col).alias(name_name)
    )


def dim_distinct(df: DataFrame, col: str, id_name: str, name_name: str, keep_null: bool = False) -> DataFrame:
    """One id (1..n, by name, nulls last) per distinct name."""
    names = df.select(F.col(col).alias(name_name)).distinct()
    if not keep_null:
        names = names.dropna()
    return global_row_number(names, [(name_name, "asc_nulls_last")], id_name).select(id_name, name_name)


def stable_ids(df: DataFrame, keys: Sequence[str], id_name: str, known: DataFrame | None = None) -> DataFrame:
    """Key map (id, keys) that only grows: tuples in ``known`` keep their ids,
    unseen ones of ``df`` are numbered after the greatest id in key order.

    Keep the result (``save_table``, ``TableStore``) and pass it to the next
    load: no fact that holds an id has to be rewritten.  Nulls are values.
    Without ``known`` the ids are 1..n in key order."""
    seen = df.select(*keys).distinct()
    if known is None:
        return global_row_number(seen, list(keys), id_name).select(id_name, *keys)
    old = known.select(id_name, *keys)
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    unseen = seen.alias("n").join(old.select(*keys).alias("o"), same, "left_anti")
    last = old.agg(F.max(id_name)).first()[0] or 0
    return old.unionByName(global_row_number(unseen, list(keys), id_name, start=last + 1).select(id_name, *keys))
