"""DataFrame operators: projections, unions, reshape, marts, checks, ordered scan."""

from postlake.operators.columns import (cast_columns, group_by_first_n, nullcheck, search,
                                        select_star, star)
from postlake.operators.relational import (anti_join, relations_by_pattern, two_way_except,
                                           union_by_pattern, union_by_prefix, union_relations)
from postlake.operators.reshape import (date_spine, deduplicate, generate_series, latest_postings,
                                        pivot, pivot_columns, unpivot)
from postlake.operators.sequence import ordered_scan

__all__ = [
    "cast_columns", "group_by_first_n", "nullcheck", "search", "select_star", "star", "anti_join",
    "relations_by_pattern", "two_way_except", "union_by_pattern", "union_by_prefix", "union_relations",
    "date_spine", "deduplicate", "generate_series", "latest_postings", "pivot", "pivot_columns",
    "unpivot", "ordered_scan",
]
