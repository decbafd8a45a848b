"""Readers, CSV rowsets, checksums and the whole bundle."""

from __future__ import annotations

import csv
import hashlib
import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from estatelens.plans import write_bundle
from estatelens.plans import bundle
from estatelens.plans.bundle import rowsets
from estatelens.sources import SCHEMAS, checksum_manifest, conform, malformed_rows, read_catalog, read_rowset, write_rowset
from estatelens.session import shared_folder
from tests.conftest import tuples

REPORTS = {
    "feature_usage/feature_score.csv",
    "workload_baseline/awr_iops.csv",
    "workload_baseline/awr_throughput.csv",
    "workload_baseline/awr_top_waits.csv",
    "workload_baseline/awr_cpu_pga.csv",
    "blockers/blockers_inventory.csv",
    "schema_complexity/plsql_inventory.csv",
    "schema_complexity/plsql_hotspots.csv",
    "schema_complexity/partition_topology.csv",
    "schema_complexity/fga_policies.csv",
}


def test_rowset_round_trip(spark, make, tmp_path):
    rows = [(1, '  a "quoted", text ', date(2024, 1, 2), 0.5), (2, "line\nbreak", None, None), (3, None, None, 12345678.1)]
    df = make("id bigint, text string, day date, rate double", rows)
    path = str(tmp_path / "out.csv")
    write_rowset(df.coalesce(1), path)
    (part,) = Path(path).glob("part-*.csv")
    assert part.read_text().splitlines()[0] == '"ID","TEXT","DAY","RATE"'
    with part.open(newline="") as f:
        assert next(csv.DictReader(f))["TEXT"] == '  a "quoted", text '
    assert sorted(tuples(read_rowset(spark, path, df.schema))) == rows


def test_rowset_with_other_columns_is_refused(spark, make, tmp_path):
    path = str(tmp_path / "out.csv")
    write_rowset(make("a int, b int", [(1, 2)]), path)
    with pytest.raises(Exception, match="(?i)header|column"):
        tuples(read_rowset(spark, path, make("a int, c int", []).schema))


def test_checksums_equal_sha256(spark, tmp_path):
    files = {"a.txt": b"one", "_u.txt": b"u", ".h.txt": b"h", "_d/x.txt": b"", "large": b"0123456789" * 2_000_000, "sub/b.bin": bytes(range(256)) * 50, "sub/deep/c c.txt": b"", "sub/d+%20é.txt": b"d", "e+%é": b"", "checksums.sha256": b"x", "sub/mab.sig": b"y"}
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    wanted = [(hashlib.sha256(c).hexdigest(), f"./{n}") for n, c in sorted(files.items()) if not n.endswith(("sha256", "sig"))]
    assert tuples(checksum_manifest(spark, str(tmp_path))) == wanted
    assert tuples(checksum_manifest(spark, f"file://{tmp_path}/")) == wanted
    with pytest.raises(ValueError, match="dbfs"):
        checksum_manifest(spark, "dbfs:/x")
    with pytest.raises(ValueError, match="absolute"):
        checksum_manifest(spark, "relative/path")


def test_conform_finds_columns_in_any_case(make):
    df = make("EXTRA int, USERNAME string, Oracle_Maintained string", [(1, "APP", "N")])
    assert conform(df, "dba_users").columns == ["username", "oracle_maintained"]
    with pytest.raises(ValueError, match="oracle_maintained"):
        conform(df.drop("Oracle_Maintained"), "dba_users")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_read_catalog(spark, make, tmp_path, fmt):
    snapshots = make(
        "source_id string, " + SCHEMAS["dba_hist_snapshot"],
        [(s, i, 1, 1, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 30)) for s in "ab" for i in (1, 2)],
    )
    snapshots.write.partitionBy("source_id").format(fmt).options(header="true").save(f"{tmp_path}/dba_hist_snapshot")
    catalog = read_catalog(spark, str(tmp_path), ["dba_hist_snapshot"], fmt, source_keys=["source_id"])
    read = catalog["dba_hist_snapshot"]
    assert read.dtypes == snapshots.dtypes
    assert sorted(tuples(read)) == sorted(tuples(snapshots))


def test_csv_files_with_other_headers_are_refused(spark, make, tmp_path):
    path = f"{tmp_path}/dba_users"
    make("ORACLE_MAINTAINED string, USERNAME string", [("N", "APP")]).coalesce(1).write.csv(path, header=True)
    make("USERNAME string, ORACLE_MAINTAINED string", [("HR", "Y")]).coalesce(1).write.mode("append").csv(path, header=True)
    with pytest.raises(Exception, match="(?i)header|column"):
        tuples(read_catalog(spark, str(tmp_path), ["dba_users"], "csv")["dba_users"])


GOOD_JSON = ['{"SNAP_ID": 1, "instance_number": "2", "dbid": null}', '{"snap_id": 2}', "{}"]
BAD_JSON = ['{"snap_id": 3', "[1]", "text", '{"snap_id": "x"}', '{"snap_id": 4, "begin_interval_time": "yesterday"}']
GOOD_CSV = ["1,2,3,,", '2,"",,2024-01-01 00:00:00,', ",,,,"]
BAD_CSV = ["3,2", "4,2,3,,,9,9", "x,2,3,,", "5,2,3,noon,"]


@pytest.mark.parametrize("fmt, good, bad", [("json", GOOD_JSON, BAD_JSON), ("csv", GOOD_CSV, BAD_CSV)])
def test_malformed_rows(spark, tmp_path, fmt, good, bad):
    """Refused by default, with file and line; or left out and listed, and nothing else is."""
    view = "dba_hist_snapshot"
    folder = tmp_path / view
    folder.mkdir()
    header = ["SNAP_ID,INSTANCE_NUMBER,DBID,BEGIN_INTERVAL_TIME,END_INTERVAL_TIME"] if fmt == "csv" else []
    for i in range(2):
        (folder / f"{i}.{fmt}").write_text("\n".join(header + good[i::2] + bad[i::2]) + "\n")
    whole = read_catalog(spark, str(tmp_path), [view], fmt, malformed="leave_out")[view]
    assert sorted(r["snap_id"] or 0 for r in whole.collect()) == [0, 1, 2]
    listed = malformed_rows(spark, str(tmp_path), [view], fmt).collect()
    assert len(listed) == len(bad) and {r["view"] for r in listed} == {view}
    assert {Path(r["file"]).name for r in listed} == {f"0.{fmt}", f"1.{fmt}"}
    if fmt == "json":
        assert {r["line"] for r in listed} == set(bad)
    with pytest.raises(Exception, match="malformed row in"):
        read_catalog(spark, str(tmp_path), [view], fmt)[view].select("dbid").collect()
    for i in range(2):
        (folder / f"{i}.{fmt}").write_text("\n".join(header + good[i::2]) + "\n")
    assert read_catalog(spark, str(tmp_path), [view], fmt)[view].count() == 3
    with pytest.raises(ValueError, match="malformed"):
        read_catalog(spark, str(tmp_path), [view], fmt, malformed="maybe")


def test_shared_folder_is_the_clusters(spark, monkeypatch):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="module")
def catalog(spark, make, tmp_path_factory):
    """A small catalog as parquet extracts, every view present."""
    begin = datetime(2024, 3, 1)
    half = timedelta(minutes=30)
    ids = range(6)
    rows = {
        "dba_feature_usage_statistics": [
            (1, "Java", "TRUE", 1, 2, date(2023, 1, 1), date(2023, 2, 1), date(2024, 1, 1), 0),
            (1, "Heat Map", "TRUE", 1, 2, None, None, date(2024, 1, 1), None),
        ],
        "dba_hist_snapshot": [(i, 1, 1, begin + i * half, begin + (i + 1) * half) for i in ids],
        "dba_hist_sysstat": [
            (i, 1, 1, s, i * 1800)
            for i in ids
            for s in (
                "physical read total IO requests",
                "physical write total IO requests",
                "physical read total bytes",
                "physical write total bytes",
                "redo size",
            )
        ],
        "dba_hist_system_event": [(i, 1, 1, "read", "User I/O", i * 1000, i) for i in ids],
        "dba_hist_osstat": [(i, 1, 1, s, i * 10) for i in ids for s in ("BUSY_TIME", "IDLE_TIME")],
        "dba_hist_pgastat": [(i, 1, 1, "total PGA allocated", 1048576) for i in ids],
        "dba_objects": [("APP", "J", "JAVA CLASS")],
        "dba_users": [("APP", "N")],
        "dba_source": [("APP", "FUNCTION", "F")] * 3,
        "dba_part_tables": [("APP", "T", "RANGE", "NONE", 2, 0, None, None)],
        "audit_unified_policies": [("APP", "T", "P", "SELECT")],
        "v_database": [("ORCL", "NO", "Linux")],
        "v_instance": [("19.3",)],
        "gv_instance": [(1,), (2,)],
        "nls_database_parameters": [("NLS_CHARACTERSET", "AL32UTF8")],
    }
    folder = tmp_path_factory.mktemp("extract")
    for name, ddl in SCHEMAS.items():
        make(ddl, rows.get(name, [])).coalesce(1).write.parquet(str(folder / name))
    return read_catalog(spark, str(folder))


def test_bundle(spark, catalog, tmp_path):
    out = write_bundle(spark, catalog, str(tmp_path / "runs"), "run-7", "2024-04-01T00:00:00Z", "h", datetime(2024, 4, 1))
    folder = Path(out)
    assert folder == tmp_path / "runs" / "run-7"

    def text(name):
        return "".join(p.read_text() for p in sorted((folder / name).glob("part-*")))

    assert json.loads(text("manifest.json"))["source"]["rac_nodes"] == 2
    summary = json.loads(text("summary/mab_summary.json"))
    assert summary["run_id"] == "run-7"
    assert summary["scorecard"] == {"red_features": 1, "amber_features": 0, "green_features": 1, "high_blockers": 1}
    assert set(rowsets(catalog, "2024-04-01 00:00:00")) == REPORTS
    for report in REPORTS:
        header, *body = text(report).splitlines()
        assert header == header.upper()
        assert body, report
    listed = dict(reversed(line.split("  ")) for line in text("checksums.sha256").splitlines())
    written = {
        f"./{p.relative_to(folder)}": hashlib.sha256(p.read_bytes()).hexdigest()
        for p in folder.rglob("*")
        if p.is_file() and "checksums.sha256" not in p.parts
    }
    assert listed == written


def test_a_failed_run_is_not_seen_and_goes_on(spark, catalog, tmp_path, monkeypatch):
    """A failure in the fifth report: nothing under the run's name; the next call writes the other six and publishes."""
    written = []
    real = bundle.write_rowset

    def failing(report, path):
        if len(written) == 4:
            raise OSError("disk full")
        written.append(path)
        real(report, path)

    monkeypatch.setattr(bundle, "write_rowset", failing)
    call = (spark, catalog, str(tmp_path / "runs"), "run-8", "2024-04-01T00:00:00Z", "h", datetime(2024, 4, 1))
    with pytest.raises(OSError, match="disk full"):
        write_bundle(*call)
    assert [p.name for p in (tmp_path / "runs").iterdir()] == ["run-8.partial"]
    # The piece that was being written when it failed is begun again.
    half = tmp_path / "runs" / "run-8.partial" / "workload_baseline" / "awr_cpu_pga.csv"
    half.mkdir(parents=True)
    (half / "part-00000.csv").write_text("half a row")
    again = []
    monkeypatch.setattr(bundle, "write_rowset", lambda report, path: (again.append(path), real(report, path)))
    out = Path(write_bundle(*call))
    assert len(again) == 6 and not {Path(p).name for p in again} & {Path(p).name for p in written}
    assert [p.name for p in (tmp_path / "runs").iterdir()] == ["run-8"]
    assert not Path(shared_folder(spark).removeprefix("file://"), "staged-run-8").exists()
    lines = "".join(p.read_text() for p in sorted((out / "checksums.sha256").glob("part-*"))).splitlines()
    for digest, path in (line.split("  ") for line in lines):
        assert hashlib.sha256((out / path).read_bytes()).hexdigest() == digest
    assert REPORTS <= {str(p.parent.relative_to(out)) for p in out.rglob("_SUCCESS")}
    assert "half a row" not in "".join(p.read_text() for p in (out / "workload_baseline" / "awr_cpu_pga.csv").glob("part-*"))


def test_each_source_of_a_fleet_gets_its_own_reports(catalog):
    def of(source, table):
        return table.select(F.lit(source).alias("source_id"), *table.columns)

    fleet = {name: of("a", table).unionByName(of("b", table)) for name, table in catalog.items()}
    single = rowsets(catalog, "2024-04-01 00:00:00")
    for place, report in rowsets(fleet, "2024-04-01 00:00:00", source_keys=["source_id"]).items():
        wanted = tuples(single[place])
        assert tuples(report) == [(s, *row) for s in "ab" for row in wanted], place


def test_a_run_never_overwrites_another(spark, catalog, tmp_path):
    (tmp_path / "runs" / "run-7" / "manifest.json").mkdir(parents=True)
    with pytest.raises(Exception, match="(?i)exists"):
        write_bundle(spark, catalog, str(tmp_path / "runs"), "run-7", "t", "h", "2024-04-01 00:00:00")
