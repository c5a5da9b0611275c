"""Graph questions over ``pipelines.build_graph`` output (plain joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibliospark.operators import co_neighbours, top_nodes


def _edges(edges: DataFrame, rel: str, src: str, dst: str) -> DataFrame:
    return edges.filter(F.col("rel") == rel).select(F.col("src_id").alias(src), F.col("dst_id").alias(dst))


def _citations(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("label") == "publication").select(
        F.col("node_id").alias("publication"), F.col("props")["reference_count"].alias("reference_count"))


def co_authors(graph: dict[str, DataFrame], author_id) -> DataFrame:
    """Authors who share a publication with ``author_id``."""
    return co_neighbours(_edges(graph["edges"], "CREATE", "author", "publication"), "author", "publication",
                         str(author_id))


def top_authors_by_citations(graph: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """Authors by the summed reference count of their publications."""
    return top_nodes(_edges(graph["edges"], "CREATE", "author", "publication"), "author", "publication",
                     _citations(graph["nodes"]), "reference_count", n, "citations")


def top_journals_by_citations(graph: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """Journals by the summed reference count of what they publish."""
    return top_nodes(_edges(graph["edges"], "PUBLISH", "journal", "publication"), "journal", "publication",
                     _citations(graph["nodes"]), "reference_count", n, "citations")
