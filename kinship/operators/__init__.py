"""Reusable DataFrame -> DataFrame operators (no I/O, no collect)."""

from kinship.operators.aggregate import (
    count_by,
    dedup_then_count,
    distinct_count_by,
    global_scalar,
    pair_rollup,
    total_and_distinct,
)
from kinship.operators.joins import bounded_lookup, full_outer_with_defaults
from kinship.operators.keys import keyed, one_record_per_id
from kinship.operators.reciprocity import (
    anti_join_reversed,
    canonical_pairs,
    degree_counts,
    one_way_edges,
)
from kinship.operators.topk import top_k

__all__ = [
    "anti_join_reversed",
    "bounded_lookup",
    "canonical_pairs",
    "count_by",
    "dedup_then_count",
    "degree_counts",
    "distinct_count_by",
    "full_outer_with_defaults",
    "global_scalar",
    "keyed",
    "one_record_per_id",
    "one_way_edges",
    "pair_rollup",
    "top_k",
    "total_and_distinct",
]
