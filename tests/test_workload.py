"""Workload reports on hand-made histories."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from estatelens.plans import cpu_memory_by_snapshot, iops_by_hour, throughput_by_hour, top_waits
from estatelens.sources import SCHEMAS
from tests.conftest import tuples

AS_OF = datetime(2024, 4, 1)
START = datetime(2024, 3, 1)
READ, WRITE = "physical read total IO requests", "physical write total IO requests"
HALF_HOUR = timedelta(minutes=30)


@pytest.fixture
def history(make):
    def build(**tables):
        return {name: make(SCHEMAS[name], rows) for name, rows in tables.items()}

    return build


def snapshot(snap_id, begin, instance=1, dbid=1, length=HALF_HOUR):
    return (snap_id, instance, dbid, begin, begin + length)


def iops(history, snapshots, facts, **options):
    h = history(dba_hist_snapshot=snapshots, dba_hist_sysstat=facts)
    return tuples(iops_by_hour(h["dba_hist_snapshot"], h["dba_hist_sysstat"], AS_OF, **options))


def stats(snap_id, read, write, instance=1, dbid=1):
    rows = [(snap_id, instance, dbid, READ, read), (snap_id, instance, dbid, WRITE, write)]
    return [r for r in rows if r[-1] is not None]


def test_first_snapshot_has_no_rate(history):
    assert iops(history, [snapshot(1, START)], stats(1, 100, 50)) == [(1, "2024-03-01T00:00:00", None, None)]


def test_hour_is_that_of_the_interval_end_and_seconds_include_unknown_deltas(history):
    snapshots = [snapshot(1, START), snapshot(2, START + HALF_HOUR), snapshot(3, START + 2 * HALF_HOUR)]
    facts = stats(1, 1000, 0) + stats(2, 4600, 1800) + stats(3, 8200, 1800)
    # 00:00-00:30 ends in hour 0; 00:30-01:00 and 01:00-01:30 end in hour 1.
    assert iops(history, snapshots, facts) == [
        (1, "2024-03-01T00:00:00", None, None),
        (1, "2024-03-01T01:00:00", 2.0, 0.5),
    ]
    facts = stats(1, 1000, 0) + stats(2, None, 1800) + stats(3, 8200, 1800)
    # The read counter is missing at 2, so its growth at 2 and 3 is unknown.
    assert iops(history, snapshots, facts)[1] == (1, "2024-03-01T01:00:00", None, 0.5)


def test_hour_denominator_counts_the_first_snapshot(history):
    snapshots = [snapshot(1, START + HALF_HOUR), snapshot(2, START + 2 * HALF_HOUR)]
    assert iops(history, snapshots, stats(1, 0, 0) + stats(2, 3600, 360)) == [(1, "2024-03-01T01:00:00", 1.0, 0.1)]


def test_counter_reset_counts_as_zero(history):
    snapshots = [snapshot(i, START + (2 * i) * HALF_HOUR) for i in range(3)]
    facts = stats(0, 9000, 9000) + stats(1, 10, 12600) + stats(2, 1810, 12600)
    assert [r[2:] for r in iops(history, snapshots, facts)] == [(None, None), (0.0, 2.0), (1.0, 0.0)]


def test_snapshot_without_any_statistic_is_bridged(history):
    snapshots = [snapshot(i, START + (2 * i) * HALF_HOUR) for i in range(3)]
    facts = stats(0, 0, 0) + [(1, 1, 1, "user commits", 5)] + stats(2, 3600, 1800)
    assert [r[1:] for r in iops(history, snapshots, facts)] == [
        ("2024-03-01T00:00:00", None, None),
        ("2024-03-01T02:00:00", 2.0, 1.0),
    ]


def test_zero_length_hour_has_no_rate(history):
    snapshots = [snapshot(1, START), snapshot(2, START + timedelta(hours=2), length=timedelta())]
    assert iops(history, snapshots, stats(1, 0, 0) + stats(2, 10, 10))[1][2:] == (None, None)


def test_window_is_ninety_days_on_the_interval_begin(history):
    edge = AS_OF - timedelta(days=90)
    snapshots = [snapshot(1, edge - timedelta(seconds=1)), snapshot(2, edge), snapshot(3, edge + 2 * HALF_HOUR)]
    facts = stats(1, 0, 0) + stats(2, 5, 5) + stats(3, 1805, 5)
    assert [r[2:] for r in iops(history, snapshots, facts)] == [(None, None), (1.0, 0.0)]


def test_database_ids_on_one_instance_interleave_unless_kept_apart(history):
    snapshots = [s for i in (1, 2) for s in (snapshot(i, START + i * 2 * HALF_HOUR, dbid=d) for d in (7, 8))]
    facts = [f for i in (1, 2) for d in (7, 8) for f in stats(i, 1800 * i * (10 if d == 8 else 1), 0, dbid=d)]
    together = iops(history, snapshots, facts)
    # order 1/7, 1/8, 2/7, 2/8: reads 1800, 18000, 3600 (falls: 0), 36000
    assert [r[2] for r in together] == [4.5, 9.0]
    apart = iops(history, snapshots, facts, source_keys=["dbid"])
    assert [(r[0], r[3]) for r in apart] == [(7, None), (7, 1.0), (8, None), (8, 10.0)]


def test_instances_are_ordered_within_the_hour(history):
    snapshots = [snapshot(1, START, instance=i) for i in (2, 1)] + [snapshot(2, START + 2 * HALF_HOUR, instance=2)]
    facts = stats(1, 0, 0, instance=1) + stats(1, 0, 0, instance=2) + stats(2, 1800, 0, instance=2)
    assert [(r[1], r[0]) for r in iops(history, snapshots, facts)] == [
        ("2024-03-01T00:00:00", 1),
        ("2024-03-01T00:00:00", 2),
        ("2024-03-01T01:00:00", 2),
    ]


def test_throughput_is_mebibytes_per_second(history):
    snapshots = [snapshot(1, START), snapshot(2, START + HALF_HOUR)]
    mib = 1048576
    names = ("physical read total bytes", "physical write total bytes", "redo size")
    facts = [(1, 1, 1, n, 0) for n in names] + [
        (2, 1, 1, n, v) for n, v in zip(names, (1800 * mib, 900 * mib, 9 * mib))
    ]
    h = history(dba_hist_snapshot=snapshots, dba_hist_sysstat=facts)
    report = throughput_by_hour(h["dba_hist_snapshot"], h["dba_hist_sysstat"], AS_OF)
    assert report.columns == ["instance_number", "hour_utc", "read_mb_per_sec", "write_mb_per_sec", "redo_mb_per_sec"]
    # 9 / 1800 = 0.005 rounds up
    assert tuples(report)[1] == (1, "2024-03-01T01:00:00", 1.0, 0.5, 0.01)


def waits(history, snapshots, events, **options):
    h = history(dba_hist_snapshot=snapshots, dba_hist_system_event=events)
    return tuples(top_waits(h["dba_hist_snapshot"], h["dba_hist_system_event"], AS_OF, **options))


def test_waits_drop_idle_and_unknown_classes_and_round_before_sorting(history):
    snapshots = [snapshot(i, START + i * HALF_HOUR, instance=n) for i in (1, 2) for n in (1, 2)]

    def event(name, wait_class, micro, count, instance=1):
        return [
            (1, instance, 1, name, wait_class, 0, 0),
            (2, instance, 1, name, wait_class, micro, count),
        ]

    events = (
        event("b", "User I/O", 1_020_000, 3)
        + event("a", "Commit", 1_040_000, 2)
        + event("c", "Commit", 2_000_000, 8)
        + event("c", "Commit", 1_000_000, 4, instance=2)
        + event("z", "Commit", 0, 0)
        + event("idle", "Idle", 9_000_000, 1)
        + event("none", None, 9_000_000, 1)
    )
    # a and b both show 1.0 seconds, so the name decides although b waited less
    assert waits(history, snapshots, events) == [
        ("c", "Commit", 3.0, 12, 250.0),
        ("a", "Commit", 1.0, 2, 520.0),
        ("b", "User I/O", 1.0, 3, 340.0),
        ("z", "Commit", 0.0, 0, None),
    ]


def test_waits_keep_twenty_five_per_source(history):
    snapshots = [snapshot(i, START + i * HALF_HOUR, dbid=d) for i in (1, 2) for d in (1, 2)]
    events = [
        (i, 1, d, f"e{n:02d}", "Commit", i * (n + 1) * 1_000_000, i) for i in (1, 2) for d in (1, 2) for n in range(30)
    ]
    report = waits(history, snapshots, events, source_keys=["dbid"])
    assert [r[0] for r in report] == [1] * 25 + [2] * 25
    assert [r[1] for r in report][:2] == ["e29", "e28"]
    single = waits(history, snapshots[::2], [e for e in events if e[2] == 1])
    assert [r[0] for r in single] == [f"e{n:02d}" for n in range(29, 4, -1)]


def test_event_seen_once_has_unknown_totals_and_sorts_last(history):
    snapshots = [snapshot(i, START + i * HALF_HOUR) for i in (1, 2)]
    events = [(1, 1, 1, "once", "Commit", 5, 5), (1, 1, 1, "x", "Commit", 0, 0), (2, 1, 1, "x", "Commit", 1, 1)]
    assert waits(history, snapshots, events)[-1] == ("once", "Commit", None, None, None)


def cpu(history, snapshots, os, pga, **options):
    h = history(dba_hist_snapshot=snapshots, dba_hist_osstat=os, dba_hist_pgastat=pga)
    return tuples(
        cpu_memory_by_snapshot(h["dba_hist_snapshot"], h["dba_hist_osstat"], h["dba_hist_pgastat"], AS_OF, **options)
    )


PGA = "total PGA allocated"


def test_cpu_has_a_row_per_snapshot_and_keeps_gaps(history):
    snapshots = [snapshot(i, START + i * timedelta(minutes=15), length=timedelta(minutes=15)) for i in range(5)]
    os = [(i, 1, 1, s, v * i) for i in (0, 1, 3, 4) for s, v in (("BUSY_TIME", 30), ("IDLE_TIME", 10), ("LOAD", 999))]
    pga = [(i, 1, 1, PGA, (i + 1) * 1048576 + 524288) for i in (1, 2)] + [(3, 1, 1, "other", 5)]
    assert cpu(history, snapshots, os, pga) == [
        (1, "2024-03-01T00:00:00", None, None),
        (1, "2024-03-01T00:00:00", 75.0, 2.5),
        (1, "2024-03-01T00:00:00", None, 3.5),
        (1, "2024-03-01T01:00:00", None, None),  # not bridged: snapshot 2 has no ticks
        (1, "2024-03-01T01:00:00", 75.0, None),
    ]


def test_cpu_without_growth_is_unknown(history):
    snapshots = [snapshot(i, START + i * HALF_HOUR) for i in (1, 2)]
    os = [(i, 1, 1, s, 7) for i in (1, 2) for s in ("BUSY_TIME", "IDLE_TIME")]
    assert cpu(history, snapshots, os, [])[1][2] is None


def test_cpu_sums_database_ids_sharing_a_snapshot_id(history):
    snapshots = [snapshot(i, START + i * HALF_HOUR, dbid=d) for i in (1, 2) for d in (7, 8)]
    os = [
        (i, 1, d, s, v * i) for i in (1, 2) for d in (7, 8, 9) for s, v in (("BUSY_TIME", d), ("IDLE_TIME", 15))
    ]
    pga = [(1, 1, 7, PGA, 1048576), (1, 1, 8, PGA, 3145728), (1, 1, 9, PGA, 9 * 1048576)]
    # two header rows per snapshot id; both show the sum over ids 7 and 8 (9 has no header)
    report = cpu(history, snapshots, os, pga)
    assert [r[2:] for r in report] == [(None, 3.0), (None, 3.0), (33.3, None), (None, None)]


@pytest.mark.parametrize("size", [1, 2, 5, 10_000])
def test_chunk_size_does_not_change_reports(history, size):
    snapshots = [snapshot(i, START + i * HALF_HOUR, instance=n) for i in range(40) for n in (1, 2)]
    facts = [f for i in range(40) for n in (1, 2) for f in stats(i, i * i * 37 % 1000, i * 180, instance=n)]
    assert iops(history, snapshots, facts, chunk_size=size) == iops(history, snapshots, facts, chunk_size=7)


def test_rates_times_seconds_add_up_to_the_growth(history):
    snapshots = [snapshot(i, START + i * 2 * HALF_HOUR, length=2 * HALF_HOUR) for i in range(30)]
    facts = [f for i in range(30) for f in stats(i, i * 3600, i * 7200)]
    report = iops(history, snapshots, facts)
    assert sum(r[2] or 0 for r in report) * 3600 == 29 * 3600
    assert all(r[2] is None or r[2] >= 0 for r in report)
