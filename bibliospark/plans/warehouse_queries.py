"""The warehouse questions, generic over table and column names.

SQ1/SQ2: groups with the most facts; SQ3: conditional proportions over a
five-table chain; SQ4: unpartitioned rank of summed metric, lowest ranks
first; NQ1-NQ3: left star joins with grouping by calendar attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibliospark.operators.aggregates import avg_by, count_by, proportion_by
from bibliospark.operators.joins import join_star
from bibliospark.operators.ordering import global_rank, top_k
from bibliospark.plans.lazy import LazyTables


def top_groups(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, name_col: str, count_col: str,
               n: int, out: str = "total_publications") -> DataFrame:
    """``SELECT name, COUNT(fact.col) FROM dim JOIN fact GROUP BY name
    ORDER BY count DESC LIMIT n`` (ties broken by name)."""
    j = _join(dim, fact, dim_key, fact_key)
    return top_k(count_by(j, [name_col], count_col, out), [(out, "desc"), name_col], n)


def _join(left: DataFrame, right: DataFrame, lk: str, rk: str, how: str = "inner") -> DataFrame:
    """Equi join; same-named keys are merged into one column."""
    if lk == rk:
        return left.join(right, lk, how)
    return left.join(right, F.col(lk) == F.col(rk), how)


def proportions(chain: DataFrame, group_col: str, conditions: Mapping[str, Column], distinct_col: str,
                digits: int | None = None) -> DataFrame:
    """SQ3 body over an already joined chain."""
    out = proportion_by(chain, [group_col], conditions, distinct_col)
    if digits is not None:
        out = out.select(group_col, *[F.round(c, digits).alias(c) for c in conditions])
    return out


def rank_by_sum(fact: DataFrame, bridge: DataFrame, fact_key: str, bridge_key: str, node_col: str,
                metric: str, name: str = "hindex") -> DataFrame:
    """SQ4 CTE: per node, ``RANK() OVER (ORDER BY SUM(metric) DESC)`` with
    PostgreSQL null order (a null sum ranks first).  Exact and distributed
    (see ``global_rank``) -- no single-partition window."""
    sums = _join(fact, bridge, fact_key, bridge_key).groupBy(node_col).agg(
        F.sum(metric).alias("_bs_sum")
    )
    return global_rank(sums, [("_bs_sum", "desc_nulls_first")], name).drop("_bs_sum")


def lowest_ranked(ranked: DataFrame, dim: DataFrame, node_col: str, dim_key: str, cols: Sequence[str], n: int,
                  name: str = "hindex") -> DataFrame:
    """SQ4 outer query: join the node dimension, ``ORDER BY rank DESC LIMIT n``
    (ties by node id) -- as written, the *lowest* sums."""
    j = _join(ranked, dim, node_col, dim_key).select(F.col(dim_key), *cols, name)
    return top_k(j, [(name, "desc"), dim_key], n)


def star_stats(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], group_col: str,
               metrics: Mapping[str, str], count_name: str, where: Column | None = None,
               digits: int | None = None) -> DataFrame:
    """NQ2/NQ3: fact LEFT JOIN dims [WHERE ...] GROUP BY group_col with
    averages and COUNT(*), ordered by the count descending."""
    j = join_star(fact, dims)
    if where is not None:
        j = j.filter(where)
    out = avg_by(j, [group_col], metrics, count_name)
    if digits is not None:
        out = out.select(group_col, *[F.round(c, digits).alias(c) for c in metrics.values()], count_name)
    return out.orderBy(F.col(count_name).desc(), group_col)


# ------------------------------------------------- over the built warehouse

def sample_queries(wh: Mapping[str, DataFrame]) -> LazyTables:
    """SQ1-SQ4 over ``pipelines.build_warehouse`` output, each built (with the
    warehouse tables that it reads) when it is asked for."""

    def hindex() -> DataFrame:
        ranked = rank_by_sum(wh["fact_publications"], wh["bridge_author_publications"], "publication_id", "publication_id",
                             "author_id", "reference_count")
        return lowest_ranked(ranked, wh["dim_author"], "author_id", "author_id", ["Names", "Surname"], 5)

    return LazyTables({
        "sq1_top_disciplines": lambda: top_groups(wh["dim_discipline"], wh["fact_publications"], "discipline_id", "discipline_id",
                                                  "discipline_name", "publication_id", 5),
        "sq2_top_journals": lambda: top_groups(wh["dim_journal"], wh["fact_publications"], "journal_id", "journal_id",
                                               "journal_name", "publication_id", 3),
        "sq3_gender_share": lambda: gender_share(wh["dim_discipline"], wh["fact_publications"], wh["bridge_author_publications"],
                                                 wh["dim_author"], wh["dim_gender"]),
        "sq4_hindex": hindex,
    })


def gender_share(dim_discipline: DataFrame, fact: DataFrame, bridge: DataFrame, dim_author: DataFrame,
                 dim_gender: DataFrame, shares: Mapping[str, str] | None = None) -> DataFrame:
    """SQ3: per discipline, rows of the chain discipline-fact-bridge-author-
    gender with a given gender over the distinct authors in it.

    ``dim_gender`` holds one row per matched publication, so the chain fans
    out to (bridge rows) x (gender rows) per author; the numerator counts
    those rows.  It equals the sum, over bridge rows, of the author's
    per-gender row count, so the gender table is pre-aggregated per author
    and the product is never built (a prolific author cannot square their
    share of the data).  Authors without a gender row drop out of both
    parts, as with the inner join."""
    shares = shares or {"proportion_male": "male", "proportion_female": "female"}
    per_author = dim_gender.groupBy("author_id").agg(
        *[F.sum(F.when(F.col("gender") == v, 1).otherwise(0)).alias(f"_bs_{n}") for n, v in shares.items()])
    chain = (dim_discipline.join(fact, "discipline_id").join(bridge, "publication_id")
             .join(dim_author.select("author_id"), "author_id").join(per_author, "author_id"))
    denom = F.countDistinct("author_id").cast("double")
    return chain.groupBy("discipline_name").agg(*[(F.sum(f"_bs_{n}") / denom).alias(n) for n in shares])
