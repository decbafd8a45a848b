"""Workload baseline: I/O, throughput, waits, CPU and memory from snapshot history.

Counters are differenced per instance over snapshots in ascending order. Two database ids on one
instance interleave, as the source views have it; add ``dbid`` to ``source_keys`` to keep them
apart. A partition holds the snapshots of 90 days, so one level of chunks leaves the last window a
few rows. Snapshot times are wall-clock TIMESTAMP_NTZ; normalise them to UTC beforehand for hour
labels in UTC.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.functions import ascending, hour_bucket, hour_label, safe_ratio, seconds_between
from estatelens.operators import (
    counter_delta,
    hourly_rate,
    key_slot,
    rolling_window,
    slot_table,
    snapshot_chunk,
    stat_pivot,
    top_n,
)
from estatelens.operators.history import SNAPSHOTS_PER_CHUNK
from estatelens.plans.seeds import (
    CPU_TICKS,
    IDLE_WAIT_CLASS,
    IO_BYTES,
    IO_REQUESTS,
    MEMORY_GAUGE,
    MIB,
    TOP_WAITS,
    WINDOW_DAYS,
)

#: Bounds of a fleet's facts; with more sources than slots, some share the lower bound.
SOURCE_SLOTS = 1 << 12

_SNAPSHOT = ("snap_id", "instance_number", "dbid")
_HEADER_CHUNK, _HEADERS = "_header_chunk", "_headers"


def _unique(*names: str) -> list[str]:
    return list(dict.fromkeys(names))


def since(facts: DataFrame, window: DataFrame, source_keys: Sequence[str] = (), bands: int = 1) -> DataFrame:
    """The facts from the window's lowest snapshot id on, that of their own source in a fleet.

    Facts have no time. The bounds are scalar subqueries, so they are known when files are read: the lowest id
    skips row groups, and the join with the window decides. A fleet's bounds are one array of ``SOURCE_SLOTS``
    by hash of the source, whatever the number of sources; a slot has the lowest bound of its sources, so old
    facts go where they are read, and where extracts are partitioned by source, so do the folders of sources
    without a snapshot in the window.

    A single scan can only skip row groups by one id. With more ``bands``, sources are dealt into as many parts
    by their bounds, each with a scan of its own that starts at its lowest id. Use that for extracts partitioned
    by source, where a scan opens the folders of its own sources only; others would be read once per band.
    """
    if not source_keys:
        return facts.where(F.col("snap_id") >= window.agg(F.min("snap_id")).scalar())
    lowest = slot_table(window, key_slot(source_keys, SOURCE_SLOTS), F.min("snap_id"), SOURCE_SLOTS)
    own = F.get(lowest, key_slot(source_keys, SOURCE_SLOTS))
    known = facts.where(own.isNotNull())
    if bands == 1:
        return known.where(F.col("snap_id") >= window.agg(F.min("snap_id")).scalar()).where(F.col("snap_id") >= own)
    lows = window.groupBy(key_slot(source_keys, SOURCE_SLOTS)).agg(F.min("snap_id").alias("low"))
    lows = lows.agg(F.array_sort(F.collect_list("low")).alias("lows"))

    def first(band: int) -> Column:
        at = F.floor(F.size("lows") * band / bands).cast("int")
        return lows.select(F.get("lows", at)).scalar()

    def inside(band: int) -> Column:
        above = own >= first(band)
        return above & (own < first(band + 1)) if band + 1 < bands else above

    parts = []
    for band in range(bands):
        start = window.where(inside(band)).agg(F.min("snap_id")).scalar()
        parts.append(known.where(inside(band)).where(F.col("snap_id") >= start).where(F.col("snap_id") >= own))
    return reduce(DataFrame.unionByName, parts)


def _with_header(facts: DataFrame, window: DataFrame, source_keys: Sequence[str], chunk_size: int) -> DataFrame:
    """The facts whose snapshot is in the window, with their chunk.

    Headers become one row per instance and chunk, with a bit for each snapshot of each database id. So few
    rows are mostly broadcast; where they are not, facts are shuffled by instance and chunk, and windows over
    series in chunks need no other shuffle.
    """
    place = F.pmod("snap_id", F.lit(chunk_size)).cast("int")
    chunk = F.call_function("div", F.col("snap_id") - place, F.lit(chunk_size))
    slot, bit = F.floor(place / 64).cast("int"), place % 64
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    slots = [F.coalesce(F.bit_or(F.when(slot == i, one)), F.lit(0)) for i in range(-(-chunk_size // 64))]
    keys = _unique(*source_keys, "instance_number", _HEADER_CHUNK)
    chunked = window.where(F.col("snap_id").isNotNull() & F.col("dbid").isNotNull()).withColumn(_HEADER_CHUNK, chunk)
    per_id = chunked.groupBy(*_unique(*keys, "dbid")).agg(F.array(*slots).alias(_HEADERS))
    by_id = F.map_from_entries(F.collect_list(F.struct(F.col("dbid").alias("id"), _HEADERS)))
    headers = per_id.groupBy(*keys).agg(by_id.alias(_HEADERS))
    joined = facts.withColumn(_HEADER_CHUNK, chunk).join(headers, keys)
    seen = F.getbit(F.get(F.try_element_at(_HEADERS, F.col("dbid")), slot), bit)
    return joined.where(seen == 1).drop(_HEADERS)


def _delta_totals(
    snapshots: DataFrame,
    sysstat: DataFrame,
    as_of: datetime | str,
    stats: Mapping[str, str],
    source_keys: Sequence[str],
    chunk_size: int,
    bands: int,
) -> DataFrame:
    """Statistics of each snapshot in the window that has any, with deltas and interval seconds."""
    keys = _unique(*source_keys, *_SNAPSHOT)
    window = rolling_window(snapshots, "begin_interval_time", as_of, WINDOW_DAYS).select(
        *keys,
        "end_interval_time",
        seconds_between(F.col("begin_interval_time"), F.col("end_interval_time")).alias("secs"),
    )
    joined = window.join(stat_pivot(since(sysstat, window, source_keys, bands), keys, stats), keys)
    return counter_delta(
        joined,
        {column: f"{column}_delta" for column in stats.values()},
        partition_by=_unique(*source_keys, "instance_number"),
        order_by=["snap_id", "dbid"],
        chunks=[snapshot_chunk(size=chunk_size)],
    )


def _hourly_report(
    deltas: DataFrame, rates: Mapping[str, str], scale: int, digits: int, source_keys: Sequence[str]
) -> DataFrame:
    keys = _unique(*source_keys, "instance_number")
    rated = hourly_rate(deltas, rates, "secs", "end_interval_time", keys, scale, digits)
    ordered = rated.orderBy(*ascending(*source_keys, "hour_bucket", "instance_number"))
    return ordered.select(*keys, hour_label(F.col("hour_bucket")).alias("hour_utc"), *rates.values())


def iops_by_hour(
    snapshots: DataFrame,
    sysstat: DataFrame,
    as_of: datetime | str,
    source_keys: Sequence[str] = (),
    chunk_size: int = SNAPSHOTS_PER_CHUNK,
    bands: int = 1,
) -> DataFrame:
    """Read and write requests per second by hour of interval end and instance."""
    deltas = _delta_totals(snapshots, sysstat, as_of, IO_REQUESTS, source_keys, chunk_size, bands)
    rates = {"read_reqs_delta": "read_iops_avg", "write_reqs_delta": "write_iops_avg"}
    return _hourly_report(deltas, rates, 1, 1, source_keys)


def throughput_by_hour(
    snapshots: DataFrame,
    sysstat: DataFrame,
    as_of: datetime | str,
    source_keys: Sequence[str] = (),
    chunk_size: int = SNAPSHOTS_PER_CHUNK,
    bands: int = 1,
) -> DataFrame:
    """Read, write and redo MiB per second by hour of interval end and instance."""
    deltas = _delta_totals(snapshots, sysstat, as_of, IO_BYTES, source_keys, chunk_size, bands)
    rates = {
        "read_bytes_delta": "read_mb_per_sec",
        "write_bytes_delta": "write_mb_per_sec",
        "redo_bytes_delta": "redo_mb_per_sec",
    }
    return _hourly_report(deltas, rates, MIB, 2, source_keys)


def top_waits(
    snapshots: DataFrame,
    system_event: DataFrame,
    as_of: datetime | str,
    source_keys: Sequence[str] = (),
    n: int = TOP_WAITS,
    chunk_size: int = SNAPSHOTS_PER_CHUNK,
    bands: int = 1,
) -> DataFrame:
    """The ``n`` non-idle wait events with the most waited time in the window, per source.

    A snapshot has one header.
    """
    window = rolling_window(snapshots, "begin_interval_time", as_of, WINDOW_DAYS)
    waits = since(system_event, window, source_keys, bands).where(F.col("wait_class") != IDLE_WAIT_CLASS)
    waits = _with_header(waits, window, source_keys, chunk_size)
    deltas = counter_delta(
        waits,
        {"time_waited_micro_fg": "waited_micro", "total_waits_fg": "waits"},
        partition_by=_unique(*source_keys, "instance_number", "event_name"),
        order_by=["snap_id", "dbid", "wait_class"],
        chunks=[F.col(_HEADER_CHUNK)],
    )
    totals = deltas.groupBy(*source_keys, "event_name", "wait_class").agg(
        F.sum("waited_micro").alias("waited_micro"), F.sum("waits").alias("total_waits")
    )
    report = totals.select(
        *source_keys,
        "event_name",
        "wait_class",
        safe_ratio(F.col("waited_micro"), scale=1_000_000, digits=1).alias("total_wait_secs"),
        "total_waits",
        safe_ratio(F.col("waited_micro"), F.col("total_waits"), 1000, 3).alias("avg_ms_per_wait"),
    )
    order = [F.col("total_wait_secs").desc_nulls_last(), *ascending("event_name", "wait_class")]
    return top_n(report, n, order, by=source_keys)


def cpu_memory_by_snapshot(
    snapshots: DataFrame,
    osstat: DataFrame,
    pgastat: DataFrame,
    as_of: datetime | str,
    source_keys: Sequence[str] = (),
    chunk_size: int = SNAPSHOTS_PER_CHUNK,
    bands: int = 1,
) -> DataFrame:
    """CPU percentage and allocated session memory, one row per snapshot under its hour label.

    Snapshots without statistics stay, with NULLs. Statistics are summed per snapshot id and
    instance over the database ids, as the source views have it.
    """
    keys = _unique(*source_keys, *_SNAPSHOT)
    joint = _unique(*source_keys, "snap_id", "instance_number")
    window = rolling_window(snapshots, "begin_interval_time", as_of, WINDOW_DAYS)
    ticks = since(osstat, window, source_keys, bands).where(F.col("stat_name").isin(*CPU_TICKS))
    gauge = since(pgastat, window, source_keys, bands).where(F.col("name").isin(*MEMORY_GAUGE)).withColumnRenamed("name", "stat_name")
    stats = CPU_TICKS | MEMORY_GAUGE
    wide = stat_pivot(
        ticks.select(*keys, "stat_name", "value").unionByName(gauge.select(*keys, "stat_name", "value")),
        keys,
        stats,
        how={"pga_bytes": "max"},
    )
    # Sums over the database ids of a snapshot are taken beside each header.
    ids = Window.partitionBy(*joint)
    measured = window.select(*keys, "end_interval_time").join(wide, keys, "left").withColumns(
        {"busy_cs": F.sum("busy_cs").over(ids), "idle_cs": F.sum("idle_cs").over(ids), "pga_bytes": F.max("pga_bytes").over(ids)}
    )
    deltas = counter_delta(
        measured,
        {"busy_cs": "busy", "idle_cs": "idle"},
        partition_by=_unique(*source_keys, "instance_number"),
        order_by=["snap_id", "dbid"],
        chunks=[snapshot_chunk(size=chunk_size)],
    )
    return deltas.orderBy(*ascending(*source_keys, "end_interval_time", "instance_number", "snap_id", "dbid")).select(
        *_unique(*source_keys, "instance_number"),
        hour_label(hour_bucket(F.col("end_interval_time"))).alias("hour_utc"),
        safe_ratio(F.col("busy"), F.col("busy") + F.col("idle"), 1, 1, times=100).alias("cpu_pct"),
        safe_ratio(F.col("pga_bytes"), scale=MIB, digits=1).alias("pga_mb"),
    )
