"""Column-expression helpers (all built-in Spark SQL functions, no UDF)."""

from sackcast.functions.dates import first_of_month, month_index, months_seq, prev_month_start, yyyymm
from sackcast.functions.numeric import half_even, clamp_round_long
from sackcast.functions.predicates import all_in, in_lists_mask
from sackcast.functions.keys import item_id, split_item_id
from sackcast.functions.caching import caches_released, keep
from sackcast.functions.grouped import with_group_values, with_last_month

__all__ = [
    "first_of_month", "month_index", "months_seq", "prev_month_start", "yyyymm",
    "half_even", "clamp_round_long", "all_in", "in_lists_mask", "with_group_values", "with_last_month", "item_id", "split_item_id",
    "caches_released", "keep",
]
