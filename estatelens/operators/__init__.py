"""DataFrame operators the plans are composed of. None collects; ``chunk_levels`` asks for the range of a key."""

from estatelens.operators.documents import json_document, nested
from estatelens.operators.history import (
    chunk_levels,
    counter_delta,
    hourly_rate,
    rolling_window,
    snapshot_chunk,
    stat_pivot,
)
from estatelens.operators.inventory import band_counts, count_units, fan_in, sampled_inventory, unit_rollup
from estatelens.operators.keys import (
    attach_one,
    enabled_flag,
    enrich,
    exclude_keys,
    key_slot,
    restrict_to_keys,
    slot_table,
    sorted_rows,
    union_tagged,
)
from estatelens.operators.ranking import first_rows, latest_per_key, order_by_band, top_n
from estatelens.operators.rubric import rubric_join

__all__ = [
    "attach_one",
    "band_counts",
    "chunk_levels",
    "count_units",
    "counter_delta",
    "enabled_flag",
    "enrich",
    "exclude_keys",
    "fan_in",
    "first_rows",
    "hourly_rate",
    "json_document",
    "key_slot",
    "latest_per_key",
    "nested",
    "order_by_band",
    "restrict_to_keys",
    "rolling_window",
    "rubric_join",
    "sampled_inventory",
    "slot_table",
    "snapshot_chunk",
    "sorted_rows",
    "stat_pivot",
    "top_n",
    "union_tagged",
    "unit_rollup",
]
