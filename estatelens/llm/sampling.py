"""Bounded samples to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_sample(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``keys``.

    Rows are counted first and all but a little more than the sample is passed over where it lies, so
    what tasks hand on does not grow with their number.
    """
    draw, total = F.xxhash64(*keys), rows.count()
    if total > size:
        rows = rows.where(draw / F.lit(2.0**64) + 0.5 < F.lit(1.2 * size / total))
    return rows.orderBy(draw, *keys).limit(size)
