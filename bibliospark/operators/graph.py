"""Property-graph tables (nodes, edges) and the graph questions as joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibliospark.operators.joins import left_join_null_safe
from bibliospark.operators.ordering import top_k


def graph_nodes(specs: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Union of node tables: (label, node_id, props map<string,string>).

    Every property is a string, as after a CSV graph load."""
    parts = []
    for label, (df, id_col, props) in specs.items():
        kv = [x for p in props for x in (F.lit(p), F.col(p).cast("string"))]
        parts.append(df.select(F.lit(label).alias("label"), F.col(id_col).cast("string").alias("node_id"),
                               F.create_map(*kv).alias("props")))
    return reduce(DataFrame.unionByName, parts)


def graph_edges(specs: Sequence[tuple[DataFrame, str, str, str, str, str]], nodes: DataFrame) -> DataFrame:
    """Edges (src_label, src_id, rel, dst_label, dst_id) from relation tables
    ``(df, src_label, src_col, rel, dst_label, dst_col)``.

    An edge survives only if both endpoints exist (MATCH); relation rows are
    not deduplicated (CREATE keeps parallel edges).  Endpoint checks are
    semi joins, so duplicate nodes cannot multiply edges."""
    parts = []
    for df, sl, sc, rel, dl, dc in specs:
        e = df.select(F.col(sc).cast("string").alias("src_id"), F.col(dc).cast("string").alias("dst_id"))
        src = nodes.filter(F.col("label") == sl).select(F.col("node_id").alias("src_id"))
        dst = nodes.filter(F.col("label") == dl).select(F.col("node_id").alias("dst_id"))
        e = e.join(src, "src_id", "left_semi").join(dst, "dst_id", "left_semi")
        parts.append(e.select(F.lit(sl).alias("src_label"), "src_id", F.lit(rel).alias("rel"),
                              F.lit(dl).alias("dst_label"), "dst_id"))
    return reduce(DataFrame.unionByName, parts)


def relations(pubs: DataFrame, id_col: str, dims: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Replace each name column by its dimension id, null matching null:
    ``dims`` = (name_col, dim, dim_name_col, dim_id_col)."""
    out = pubs.select(id_col, *[d[0] for d in dims])
    for name_col, dim, dname, did in dims:
        out = left_join_null_safe(out, dim.select(F.col(dname).alias(name_col), did), [name_col])
    return out.select(id_col, *[d[3] for d in dims])


def co_neighbours(bridge: DataFrame, node_col: str, group_col: str, node_id) -> DataFrame:
    """Distinct nodes sharing a group with ``node_id`` (co-authors sharing a
    publication), excluding the node itself.  Semi join on the node's groups:
    no pairwise self-join."""
    groups = bridge.filter(F.col(node_col) == F.lit(node_id)).select(group_col).distinct()
    return (
        bridge.join(groups, group_col, "left_semi")
        .filter(F.col(node_col) != F.lit(node_id))
        .select(node_col)
        .distinct()
    )


def top_nodes(bridge: DataFrame, node_col: str, group_col: str, weights: DataFrame, weight_col: str,
              n: int, name: str = "total") -> DataFrame:
    """Top ``n`` nodes by the summed (numeric) weight of their groups;
    ties by node id."""
    w = weights.select(group_col, F.col(weight_col).cast("double").alias("_bs_w"))
    sums = bridge.join(w, group_col).groupBy(node_col).agg(F.sum("_bs_w").alias(name))
    return top_k(sums, [(name, "desc_nulls_last"), node_col], n)
