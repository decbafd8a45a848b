"""Column expressions: everything here maps Columns to Columns and stays in the JVM."""

from estatelens.functions.numeric import non_negative_delta, rounded_mean, safe_ratio, weighted_score
from estatelens.functions.ordering import ascending, band_rank, descending
from estatelens.functions.text import concat_text, contains_text, lookup_type
from estatelens.functions.time import hour_bucket, hour_label, seconds_between, timestamp_literal

__all__ = [
    "ascending",
    "band_rank",
    "concat_text",
    "contains_text",
    "descending",
    "hour_bucket",
    "hour_label",
    "lookup_type",
    "non_negative_delta",
    "rounded_mean",
    "safe_ratio",
    "seconds_between",
    "timestamp_literal",
    "weighted_score",
]
