"""Plan-level building blocks: lineage cuts, skew handling, distributed ranking."""

from textspark.plans.lineage import discarded, durable, ensure_checkpoint_dir, settled, shared_dir, stored
from textspark.plans.ranking import row_index, top_k_per_group
from textspark.plans.skew import fits_broadcast, heavy_keys, lookup_join, split_join
from textspark.plans.union import union_rows

__all__ = [
    "discarded",
    "durable",
    "ensure_checkpoint_dir",
    "fits_broadcast",
    "heavy_keys",
    "lookup_join",
    "row_index",
    "settled",
    "shared_dir",
    "split_join",
    "stored",
    "top_k_per_group",
    "union_rows",
]
