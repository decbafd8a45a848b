"""The whole assessment of a catalog, written as one folder per run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators import rolling_window
from estatelens.plans import summary
from estatelens.plans.blockers import blocker_inventory
from estatelens.plans.code import code_hotspots, code_inventory, code_units
from estatelens.plans.features import feature_score
from estatelens.plans.schema import audit_policies, partition_topology
from estatelens.plans.seeds import IO_BYTES, IO_REQUESTS, WINDOW_DAYS
from estatelens.plans.workload import cpu_memory_by_snapshot, iops_by_hour, since, throughput_by_hour, top_waits
from estatelens.session import shared_folder
from estatelens.sources.files import checksum_manifest
from estatelens.sources.rowset import read_rowset, write_rowset

# Folder layout.
FEATURES = "feature_usage/feature_score.csv"
BLOCKERS = "blockers/blockers_inventory.csv"
MANIFEST = "manifest.json"
SUMMARY = "summary/mab_summary.json"
CHECKSUMS = "checksums.sha256"

#: What a run that is not complete is called beside the complete ones.
PARTIAL = ".partial"

_IO_REPORTS = ("workload_baseline/awr_iops.csv", "workload_baseline/awr_throughput.csv")
_UNIT_REPORTS = ("schema_complexity/plsql_inventory.csv", "schema_complexity/plsql_hotspots.csv")
#: Tables that several reports read, and which.
STAGED = {"io": _IO_REPORTS, "units": _UNIT_REPORTS}


def rowsets(
    catalog: Mapping[str, DataFrame],
    as_of: datetime | str,
    rubric: DataFrame | None = None,
    source_keys: Sequence[str] = (),
    stage: Callable[[str, DataFrame], DataFrame] = lambda name, table: table,
    bands: int = 1,
) -> dict[str, DataFrame]:
    """The ten reports by their place in the folder.

    ``stage`` may store a table two reports read, so its input is scanned once.
    """
    c, keys = catalog, source_keys
    snapshots, users = c["dba_hist_snapshot"], c["dba_users"]
    window = rolling_window(snapshots, "begin_interval_time", as_of, WINDOW_DAYS)
    facts = since(c["dba_hist_sysstat"], window, keys, bands)
    io = stage("io", facts.where(F.col("stat_name").isin(*IO_REQUESTS, *IO_BYTES)))
    units = stage("units", code_units(c["dba_source"], keys))
    return {
        FEATURES: feature_score(c["dba_feature_usage_statistics"], rubric, keys),
        "workload_baseline/awr_iops.csv": iops_by_hour(snapshots, io, as_of, keys),
        "workload_baseline/awr_throughput.csv": throughput_by_hour(snapshots, io, as_of, keys),
        "workload_baseline/awr_top_waits.csv": top_waits(
            snapshots, c["dba_hist_system_event"], as_of, keys, bands=bands
        ),
        "workload_baseline/awr_cpu_pga.csv": cpu_memory_by_snapshot(
            snapshots, c["dba_hist_osstat"], c["dba_hist_pgastat"], as_of, keys, bands=bands
        ),
        BLOCKERS: blocker_inventory(c, source_keys=keys),
        "schema_complexity/plsql_inventory.csv": code_inventory(users, units, keys),
        "schema_complexity/plsql_hotspots.csv": code_hotspots(users, units, c["dba_dependencies"], keys),
        "schema_complexity/partition_topology.csv": partition_topology(
            users, c["dba_part_tables"], c["dba_tab_subpartitions"], c["dba_tables"], keys
        ),
        "schema_complexity/fga_policies.csv": audit_policies(
            users,
            c["dba_audit_policies"],
            c["audit_unified_policies"],
            c["audit_unified_enabled_policies"],
            keys,
        ),
    }


def write_bundle(
    spark: SparkSession,
    catalog: Mapping[str, DataFrame],
    folder: str,
    run_id: str,
    captured_at_utc: str,
    host: str,
    as_of: datetime | str,
    rubric: DataFrame | None = None,
    source_keys: Sequence[str] = (),
    bands: int = 1,
) -> str:
    """Write manifest, reports, summary and checksums below ``<folder>/<run_id>``; return that path.

    The run is written aside, in ``<run_id>.partial``, and gets its name when all of it is there, so a reader never
    sees half a bundle. After a failure, the same call goes on with what is missing: a piece is complete once its
    writer has marked it, and is not written again. A run that exists is not overwritten.

    The summary counts the reports as written, so they are not computed again. Tables that several of the missing
    reports read are stored once in the cluster's shared folder, and removed at the end, also after a failure.
    """
    out = f"{folder.rstrip('/')}/{run_id}"
    aside, staging = f"{out}{PARTIAL}", f"{shared_folder(spark)}/staged-{run_id}"
    if _exists(spark, out):
        raise FileExistsError(f"run exists: {out}")

    def is_complete(place: str) -> bool:
        return _exists(spark, f"{aside}/{place}/_SUCCESS")

    def write_once(place: str, write: Callable[[str], None]) -> None:
        if not is_complete(place):
            _remove(spark, f"{aside}/{place}")
            write(f"{aside}/{place}")

    def stage(name: str, table: DataFrame) -> DataFrame:
        if all(is_complete(place) for place in STAGED[name]):
            return table
        path = f"{staging}/{name}"
        table.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    environment = summary.fingerprint(
        catalog["v_database"],
        catalog["v_instance"],
        catalog["gv_instance"],
        catalog["nls_database_parameters"],
        source_keys,
    )
    run = summary.manifest(environment, run_id, captured_at_utc, host)
    document = summary.manifest_document(run, source_keys).select("document")
    write_once(MANIFEST, document.write.text)
    try:
        reports = rowsets(catalog, as_of, rubric, source_keys, stage, bands)
        for place, report in reports.items():
            write_once(place, lambda path, report=report: write_rowset(report, path))
    finally:
        _remove(spark, staging)
    written = {place: read_rowset(spark, f"{aside}/{place}", reports[place].schema) for place in (FEATURES, BLOCKERS)}
    scores = summary.scorecard(written[FEATURES], written[BLOCKERS], run, source_keys)
    write_once(SUMMARY, summary.summary_document(scores, source_keys).select("document").write.text)
    _remove(spark, f"{aside}/{CHECKSUMS}")
    sums = checksum_manifest(spark, aside)
    sums.selectExpr("concat(sha256, '  ', path) AS line").write.text(f"{aside}/{CHECKSUMS}")
    _publish(spark, aside, out)
    return out


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, store = _path(spark, name)
    return store.exists(path)


def _remove(spark: SparkSession, name: str) -> None:
    path, store = _path(spark, name)
    store.delete(path, True)


def _publish(spark: SparkSession, aside: str, out: str) -> None:
    """One rename; on a store without renames it is a copy, and the checksums are what proves a run whole."""
    path, store = _path(spark, aside)
    if not store.rename(path, _path(spark, out)[0]):
        raise OSError(f"could not rename {aside} to {out}")
