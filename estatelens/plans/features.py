"""Feature score: the latest usage sample of every used feature against a rubric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators import latest_per_key, order_by_band, rubric_join
from estatelens.plans.seeds import SCORE_ORDER, UNMATCHED, default_rubric


def feature_score(
    features: DataFrame, rubric: DataFrame | None = None, source_keys: Sequence[str] = ()
) -> DataFrame:
    """Score the features of ``dba_feature_usage_statistics`` that are or were used.

    The latest sample counts per database id, so a feature of two databases appears twice. A
    feature matching several patterns appears once for each.
    """
    used = features.where((F.col("detected_usages") > 0) | (F.col("currently_used") == "TRUE"))
    latest = latest_per_key(used, [*source_keys, "dbid", "name"], "last_sample_date", tiebreak=["aux_count"])
    named = latest.select(
        *source_keys,
        F.col("name").alias("feature_name"),
        "currently_used",
        "detected_usages",
        "first_usage_date",
        "last_usage_date",
        "aux_count",
    )
    rubric = default_rubric(features.sparkSession) if rubric is None else rubric
    # Names are listed from the scan; the latest samples are found once.
    scored = rubric_join(named, "feature_name", rubric, "feature_pattern", UNMATCHED, texts=used.select("name"))
    return order_by_band(scored, "target_score", SCORE_ORDER, then=["feature_name", "target_notes", "aux_count"], by=source_keys)
