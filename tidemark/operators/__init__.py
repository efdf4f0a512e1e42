"""DataFrame operators that Spark does not ship as one call."""

from tidemark.operators.cleaning import (
    dedup_by_key,
    dedup_rows,
    dup_rows_semi,
    fill_defaults,
    new_rows_anti,
    ref_check_semi,
    rejected_rows_anti,
)
from tidemark.operators.merge import merge_update_only, merge_upsert
from tidemark.operators.ordered import lag_within
from tidemark.operators.quality import SplitRule, quality_gate, split_valid
from tidemark.operators.ranking import assign_pages, distributed_ntile, distributed_rank, ntile_of

__all__ = [
    "dedup_by_key", "dedup_rows", "dup_rows_semi", "fill_defaults", "new_rows_anti",
    "ref_check_semi", "rejected_rows_anti", "merge_update_only", "merge_upsert",
    "lag_within", "SplitRule", "quality_gate", "split_valid", "assign_pages",
    "distributed_ntile", "distributed_rank", "ntile_of",
]
