"""The assessment reports; each takes and returns DataFrames."""

from estatelens.plans.blockers import DETECTORS, Detector, blocker_counts, blocker_inventory
from estatelens.plans.bundle import rowsets, write_bundle
from estatelens.plans.code import app_owners, code_hotspots, code_inventory, code_units
from estatelens.plans.features import feature_score
from estatelens.plans.schema import audit_policies, partition_topology
from estatelens.plans.summary import fingerprint, manifest, manifest_document, scorecard, summary_document
from estatelens.plans.workload import cpu_memory_by_snapshot, iops_by_hour, throughput_by_hour, top_waits

__all__ = [
    "DETECTORS",
    "Detector",
    "app_owners",
    "audit_policies",
    "blocker_counts",
    "blocker_inventory",
    "code_hotspots",
    "code_inventory",
    "code_units",
    "cpu_memory_by_snapshot",
    "feature_score",
    "fingerprint",
    "iops_by_hour",
    "manifest",
    "manifest_document",
    "partition_topology",
    "rowsets",
    "scorecard",
    "summary_document",
    "throughput_by_hour",
    "top_waits",
    "write_bundle",
]
