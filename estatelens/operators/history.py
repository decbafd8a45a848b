"""Snapshot history: windows of time, long-to-wide statistics, counter deltas, hourly rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.functions.numeric import non_negative_delta, safe_ratio
from estatelens.functions.ordering import ascending
from estatelens.functions.time import hour_bucket, timestamp_literal

_CHUNK, _COUNTERS, _PREVIOUS, _IS_LAST = "_chunk", "_counters", "_previous", "_is_last"

SNAPSHOTS_PER_CHUNK = 512


def rolling_window(df: DataFrame, ts: str, as_of: datetime | str, days: int = 90) -> DataFrame:
    """Rows whose ``ts`` is no earlier than ``days`` days before ``as_of``.

    The bound folds to a constant, so the filter reaches the file scan.
    """
    earliest = timestamp_literal(as_of) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(ts) >= earliest)


def stat_pivot(
    facts: DataFrame,
    keys: Sequence[str],
    stats: Mapping[str, str],
    name: str = "stat_name",
    value: str = "value",
    how: Mapping[str, str] | None = None,
) -> DataFrame:
    """Long ``(keys, name, value)`` facts to one row per key with a column per statistic.

    ``stats`` maps statistic names to output columns, ``how`` gives ``"max"`` for gauges
    (default ``"sum"``). A statistic absent at a key is NULL. The name list is also a filter,
    which Catalyst pushes to the scan but would not derive from the conditional aggregates.
    """
    reducers = {"sum": F.sum, "max": F.max}
    measures = [
        reducers[(how or {}).get(column, "sum")](F.when(F.col(name) == stat, F.col(value))).alias(column)
        for stat, column in stats.items()
    ]
    return facts.where(F.col(name).isin(*stats)).groupBy(*keys).agg(*measures)


def snapshot_chunk(snap_id: str = "snap_id", size: int = SNAPSHOTS_PER_CHUNK) -> Column:
    """Runs of ``size`` consecutive snapshot ids: the unit of work of ``counter_delta``."""
    return F.call_function("div", F.col(snap_id), F.lit(size))


def chunk_levels(df: DataFrame, key: str, size: int = SNAPSHOTS_PER_CHUNK) -> list[Column]:
    """Chunks for ``counter_delta`` by an integer ``key``, fine to coarse, as many as the key's range asks for.

    With one row per key and partition, no window of any level has more than ``size`` rows, however long the
    history: a chunk of the first level spans ``size`` keys, one of each next level half as many chunks of the
    level below, which hand on two rows each, and the last level has no more than that many chunks. The range is
    asked of ``df`` at once.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    levels, width = [], size
    while low is not None and width <= high - low:
        levels.append(F.call_function("div", F.col(key) - F.lit(low), F.lit(width)))
        width *= size // 2
    return levels


def _with_previous(
    df: DataFrame, name: str, partition_by: Sequence[str], order: Sequence[Column], chunks: Sequence[Column]
) -> DataFrame:
    """Add ``name``: the counters of the previous row of the partition."""
    if not chunks:
        partition = Window.partitionBy(*partition_by).orderBy(*order)
        return df.withColumn(name, F.lag(_COUNTERS).over(partition))
    chunk, *coarser = chunks
    in_chunk = Window.partitionBy(*partition_by, _CHUNK).orderBy(*order)
    linked = df.withColumn(_CHUNK, chunk).withColumns(
        {name: F.lag(_COUNTERS).over(in_chunk), _IS_LAST: F.lead(F.lit(True)).over(in_chunk).isNull()}
    )
    is_edge = F.col(name).isNull() | F.col(_IS_LAST)
    further = f"{name}_further"
    edges = _with_previous(linked.where(is_edge).drop(_CHUNK, _IS_LAST), further, partition_by, order, coarser)
    joined_up = edges.withColumn(name, F.coalesce(name, further)).drop(further)
    return linked.where(~is_edge).drop(_CHUNK, _IS_LAST).unionByName(joined_up)


def counter_delta(
    df: DataFrame,
    counters: Mapping[str, str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    chunks: Sequence[Column] = (),
) -> DataFrame:
    """Add the growth of each cumulative counter since the previous row of its partition.

    ``counters`` maps counter columns to delta columns. The first row and unknown counters give
    NULL, a reset gives 0.

    ``chunks``, non-decreasing functions of ``order_by`` from fine to coarse, split a partition
    over many tasks, so one long history is no single task's work. Inside a chunk the previous
    row is at hand. Only the first row of a chunk looks further back: the first and last rows of
    all chunks, two per chunk, are linked by the next coarser chunks and at last by a window over
    the whole partition. Both branches of a level read one shuffle.
    """
    with_counters = df.withColumn(_COUNTERS, F.struct(*counters))
    linked = _with_previous(with_counters, _PREVIOUS, partition_by, ascending(*order_by), chunks)
    deltas = {
        delta: non_negative_delta(F.col(counter), F.col(f"{_PREVIOUS}.{counter}"))
        for counter, delta in counters.items()
    }
    return linked.withColumns(deltas).drop(_COUNTERS, _PREVIOUS)


def hourly_rate(
    df: DataFrame,
    rates: Mapping[str, str],
    seconds: str,
    ts: str,
    keys: Sequence[str],
    scale: int = 1,
    digits: int = 1,
    hour: str = "hour_bucket",
) -> DataFrame:
    """Sum of each delta over sum of seconds, per key and hour of ``ts``.

    ``rates`` maps delta columns to rate columns. An hour's seconds include rows whose delta is
    unknown; an hour with no known delta has a NULL rate.
    """
    totals = df.groupBy(*keys, hour_bucket(F.col(ts)).alias(hour)).agg(
        F.sum(seconds).alias(seconds), *[F.sum(delta).alias(delta) for delta in rates]
    )
    return totals.select(
        *keys,
        hour,
        *[safe_ratio(F.col(d), F.col(seconds), scale, digits).alias(rate) for d, rate in rates.items()],
    )
