"""Partition topology and audit policies of application schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import ascending, descending
from estatelens.operators import enabled_flag, enrich, restrict_to_keys, sorted_rows, union_tagged
from estatelens.plans.code import app_owners

# Stand-in for an unnamed object, and the LIKE pattern of built-in policies, whose
# underscore matches any character.
GLOBAL_OBJECT = "<global>"
BUILT_IN_POLICIES = "ORA_%"


def partition_topology(
    users: DataFrame,
    part_tables: DataFrame,
    subpartitions: DataFrame,
    tables: DataFrame,
    source_keys: Sequence[str] = (),
) -> DataFrame:
    """Partitioning of each table with its subpartition count and row statistics.

    Unknown row counts stay NULL. Subpartitions are counted before the join.
    """
    table = [*source_keys, "owner", "table_name"]
    owners = app_owners(users, source_keys=source_keys)
    totals = (
        subpartitions.withColumnRenamed("table_owner", "owner")
        .groupBy(*table)
        .agg(F.count("*").alias("subpartition_total"))
    )
    stats = tables.select(*table, "num_rows", F.col("last_analyzed").alias("stats_last_analyzed"))
    kept = restrict_to_keys(part_tables, [*source_keys, "owner"], owners)
    joined = enrich(enrich(kept, totals, table, counts=["subpartition_total"]), stats, table)
    report = joined.select(
        *table,
        "partitioning_type",
        "subpartitioning_type",
        "partition_count",
        "subpartition_total",
        "def_subpartition_count",
        F.col("interval").alias("interval_clause"),
        F.col("ref_ptn_constraint_name").alias("reference_partitioned_by"),
        "num_rows",
        "stats_last_analyzed",
    )
    return report.orderBy(*ascending(*source_keys, "owner"), *descending("partition_count"), *ascending("table_name"))


_POLICY_SCHEMA = {
    "object_owner": "string",
    "object_name": "string",
    "policy_name": "string",
    "policy_column": "string",
    "enable": "string",
    "statement_types": "string",
    "audit_trail": "string",
}


#: Parts of the rows of one policy name: each is joined with all of its enabling rows.
POLICY_SPLITS = 8


def audit_policies(
    users: DataFrame,
    fine_grained: DataFrame,
    unified: DataFrame,
    enabled: DataFrame,
    source_keys: Sequence[str] = (),
) -> DataFrame:
    """Fine-grained policies on application schemas and all unified policies but the built-in."""
    owners = app_owners(users, source_keys=source_keys)
    on_app_schemas = restrict_to_keys(fine_grained, [*source_keys, "object_schema"], owners)
    custom = unified.where(~F.col("policy_name").like(BUILT_IN_POLICIES))
    flagged = enabled_flag(custom, enabled, [*source_keys, "policy_name"], "enabled_option", "enable", POLICY_SPLITS)
    same = {c: F.col(c) for c in ("object_name", "policy_name", "policy_column", "enable", "statement_types", "audit_trail")}
    report = union_tagged(
        [
            ("FGA", on_app_schemas, {"object_owner": F.col("object_schema"), **same}),
            (
                "UNIFIED",
                flagged,
                {
                    "object_owner": F.coalesce(F.col("object_schema"), F.lit(GLOBAL_OBJECT)),
                    "object_name": F.coalesce(F.col("object_name"), F.lit(GLOBAL_OBJECT)),
                    "policy_name": F.col("policy_name"),
                    "enable": F.col("enable"),
                    "statement_types": F.col("audit_option"),
                },
            ),
        ],
        _POLICY_SCHEMA,
        keep=source_keys,
    )
    # the last two split the many policies without an object
    order = ("source_type", "object_owner", "object_name", "policy_name", "statement_types")
    return sorted_rows(report, *source_keys, *order)
