"""Environment fingerprint, manifest and scorecard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators import attach_one, band_counts, json_document
from estatelens.plans.seeds import CHARACTER_SET_PARAMETER

# Kind of document, and version of the report layout.
ARTIFACT = "mab"
TOOL_VERSION = "1.0.0"

_SOURCE = {
    "db_name": "db_name",
    "version": "version",
    "cdb": "cdb",
    "rac_nodes": "rac_nodes",
    "characterset": "characterset",
    "platform": "platform",
}


def fingerprint(
    database: DataFrame,
    instance: DataFrame,
    cluster_instances: DataFrame,
    parameters: DataFrame,
    source_keys: Sequence[str] = (),
) -> DataFrame:
    """Name, version, container flag, node count, character set and platform of each source.

    Of several database or instance rows the smallest counts. Unknown texts are empty, and a source
    without node rows has 0 nodes.
    """
    first = F.min(F.struct("name", "cdb", "platform_name")).alias("d")
    base = database.groupBy(*source_keys).agg(first).where(F.col("d").isNotNull())
    version = instance.groupBy(*source_keys).agg(F.min("version_full").alias("version"))
    nodes = cluster_instances.groupBy(*source_keys).agg(F.count("*").alias("rac_nodes"))
    charset = (
        parameters.where(F.col("parameter") == CHARACTER_SET_PARAMETER)
        .groupBy(*source_keys)
        .agg(F.min("value").alias("characterset"))
    )
    for lookup in (version, nodes, charset):
        base = attach_one(base, lookup, source_keys)
    texts = {
        "db_name": F.col("d.name"),
        "version": F.col("version"),
        "cdb": F.col("d.cdb"),
        "characterset": F.col("characterset"),
        "platform": F.col("d.platform_name"),
    }
    filled = {name: F.coalesce(column, F.lit("")).alias(name) for name, column in texts.items()}
    filled["rac_nodes"] = F.coalesce(F.col("rac_nodes"), F.lit(0)).alias("rac_nodes")
    return base.select(*source_keys, *[filled[name] for name in _SOURCE])


def manifest(
    environment: DataFrame, run_id: str, captured_at_utc: str, host: str, tool_version: str = TOOL_VERSION
) -> DataFrame:
    """The fingerprint with the run it belongs to."""
    return environment.withColumns(
        {
            "run_id": F.lit(run_id),
            "captured_at_utc": F.lit(captured_at_utc),
            "script_bundle_version": F.lit(tool_version),
            "host": F.lit(host),
        }
    )


def manifest_document(manifest_rows: DataFrame, source_keys: Sequence[str] = ()) -> DataFrame:
    """The manifest as one JSON text per source."""
    shape = {
        "run_id": "run_id",
        "captured_at_utc": "captured_at_utc",
        "source": _SOURCE,
        "tooling": {"script_bundle_version": "script_bundle_version"},
        "operator": {"host": "host"},
    }
    return json_document(manifest_rows, shape, by=source_keys)


def scorecard(
    features: DataFrame, blockers: DataFrame, manifest_rows: DataFrame, source_keys: Sequence[str] = ()
) -> DataFrame:
    """Numbers of features by score and of high-band blockers, beside the manifest.

    ``blockers`` needs a row and a ``band`` per blocker: ``blocker_counts``, or the inventory as written.
    A source without features or blockers counts 0.
    """
    scores = {"RED": "red_features", "AMBER": "amber_features", "GREEN": "green_features"}
    counted = attach_one(manifest_rows, band_counts(features, "target_score", scores, source_keys), source_keys)
    counted = attach_one(counted, band_counts(blockers, "band", {"HIGH": "high_blockers"}, source_keys), source_keys)
    counts = [*scores.values(), "high_blockers"]
    return counted.select(
        *source_keys, "run_id", *_SOURCE, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts]
    )


def summary_document(scorecards: DataFrame, source_keys: Sequence[str] = ()) -> DataFrame:
    """The scorecard as one JSON text per source."""
    counts = ("red_features", "amber_features", "green_features", "high_blockers")
    shape = {
        "_artifact": F.lit(ARTIFACT),
        "run_id": "run_id",
        "source": _SOURCE,
        "scorecard": {c: c for c in counts},
        "open_questions": F.array().cast("array<string>"),
    }
    return json_document(scorecards, shape, by=source_keys)
