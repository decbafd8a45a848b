"""Keep the first rows of a table or of each group, and order results by band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.functions.ordering import ascending, band_rank

_RANK = "_rank"


def first_rows(df: DataFrame, n: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by ``order``, of the table or of each ``by`` group, without ties.

    With groups Spark plans a group limit below the shuffle, so a task forwards at most ``n``
    rows of a group however many it holds. Without groups it plans a top-k instead of a window,
    which would move every row to one task.
    """
    if not by:
        return df.orderBy(*order).limit(n)
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)


def top_n(df: DataFrame, n: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``first_rows`` with the result in order."""
    kept = first_rows(df, n, order, by)
    return kept.orderBy(*ascending(*by), *order) if by else kept


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest ``latest``, unknown values last, then the tie-break columns."""
    return first_rows(df, 1, [F.col(latest).desc_nulls_last(), *ascending(*tiebreak)], by=keys)


def order_by_band(
    df: DataFrame,
    band: str,
    ranking: Sequence[str],
    then: Sequence[str] = (),
    by: Sequence[str] = (),
    otherwise: int | None = None,
) -> DataFrame:
    """Sort by the rank of ``band``, then by the ``then`` columns; ``by`` columns come first."""
    rank = band_rank(F.col(band), ranking, otherwise).asc_nulls_last()
    return df.orderBy(*ascending(*by), rank, *ascending(*then))
