"""Sort keys: NULLs count as the largest value, as in the source database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]


def band_rank(column: Column, ranking: Sequence[str], otherwise: int | None = None) -> Column:
    """1 for the first value of ``ranking``, 2 for the second, and so on."""
    rank = F.when(column == ranking[0], 1)
    for position, value in enumerate(ranking[1:], start=2):
        rank = rank.when(column == value, position)
    return rank.otherwise(F.lit(otherwise).cast("int"))
