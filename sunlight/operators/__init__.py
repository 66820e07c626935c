from sunlight.operators.topk import top_k, top_k_per_group, ranked_top_k
from sunlight.operators.aggregates import (ranked_string_agg, group_max_lookup, first_by_order,
                                          dedup_sum)
from sunlight.operators.joins import materialise
from sunlight.operators.numbering import number_rows
from sunlight.operators.keyset import in_key_set, key_set
from sunlight.operators.quality import join_fanout
from sunlight.operators.profile import (schema_profile, search_columns, find_columns,
                                        first_rows_by_position)

__all__ = ["top_k", "top_k_per_group", "ranked_top_k", "ranked_string_agg", "group_max_lookup",
           "first_by_order", "dedup_sum", "materialise", "join_fanout", "schema_profile",
           "search_columns", "find_columns", "first_rows_by_position", "number_rows", "key_set", "in_key_set"]
