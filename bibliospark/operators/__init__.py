"""DataFrame -> DataFrame operators, generic over column names."""

from bibliospark.operators.aggregates import (
    avg_by,
    count_by,
    distinct_bitmaps,
    distinct_rollup,
    profile,
    proportion_by,
    sum_if,
)
from bibliospark.operators.audit import (
    audit_column,
    audit_key_space,
    audit_reference,
    audit_unique,
    reference_summary,
)
from bibliospark.operators.bloom import KeyFilter, filtered_in, filtered_not_in, key_filter
from bibliospark.operators.clean import drop_columns, drop_nulls, head_n, min_length, nullify
from bibliospark.operators.datedim import date_dimension, date_dimension_for
from bibliospark.operators.dedupe import distinct_on, drop_all_duplicates, row_not_in
from bibliospark.operators.graph import co_neighbours, graph_edges, graph_nodes, relations, top_nodes
from bibliospark.operators.ids import (
    assign_first_position_ids,
    author_ids,
    dim_distinct,
    dim_first_seen,
    dim_per_row,
    flatten_authors,
    flatten_versions,
    stable_ids,
)
from bibliospark.operators.joins import (
    enrich_by_lookup,
    join_star,
    left_join_null_safe,
    lookup_exact,
    null_safe_join,
    one_row_per_key,
)
from bibliospark.operators.match import (
    PreparedBuild,
    contains_pairs,
    first_match_contains,
    min_contained,
    prepare_build,
    rejected_patterns,
)
from bibliospark.operators.ordering import (
    exact_quantiles,
    global_prefix_sum,
    global_rank,
    global_row_number,
    sample_n,
    top_k,
)

__all__ = [name for name in dir() if not name.startswith("_")]
