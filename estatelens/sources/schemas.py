"""Columns of the catalog and history views the plans read.

Fixed values: view and column names are those of the source database's dictionary. ``$`` in a
view name is written ``_``.
"""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "dba_feature_usage_statistics": (
        "dbid bigint, name string, currently_used string, detected_usages bigint, total_samples bigint, "
        "first_usage_date date, last_usage_date date, last_sample_date date, aux_count bigint"
    ),
    "dba_hist_snapshot": (
        "snap_id bigint, instance_number bigint, dbid bigint, "
        "begin_interval_time timestamp_ntz, end_interval_time timestamp_ntz"
    ),
    "dba_hist_sysstat": "snap_id bigint, instance_number bigint, dbid bigint, stat_name string, value bigint",
    "dba_hist_system_event": (
        "snap_id bigint, instance_number bigint, dbid bigint, event_name string, wait_class string, "
        "time_waited_micro_fg bigint, total_waits_fg bigint"
    ),
    "dba_hist_osstat": "snap_id bigint, instance_number bigint, dbid bigint, stat_name string, value bigint",
    "dba_hist_pgastat": "snap_id bigint, instance_number bigint, dbid bigint, name string, value bigint",
    "dba_objects": "owner string, object_name string, object_type string",
    "dba_tab_columns": "owner string, table_name string, column_name string, data_type string",
    "dba_types": "owner string, type_name string, predefined string",
    "dba_db_links": "owner string, db_link string",
    "dba_mviews": "owner string, mview_name string",
    "dba_external_tables": "owner string, table_name string",
    "dba_queues": "owner string, name string",
    "dba_dependencies": (
        "owner string, name string, referenced_owner string, referenced_type string, referenced_name string"
    ),
    "dba_users": "username string, oracle_maintained string",
    "dba_source": "owner string, type string, name string",
    "dba_part_tables": (
        "owner string, table_name string, partitioning_type string, subpartitioning_type string, "
        "partition_count bigint, def_subpartition_count bigint, interval string, ref_ptn_constraint_name string"
    ),
    "dba_tab_subpartitions": "table_owner string, table_name string",
    "dba_tables": "owner string, table_name string, num_rows bigint, last_analyzed date",
    "dba_audit_policies": (
        "object_schema string, object_name string, policy_name string, policy_column string, enable string, "
        "statement_types string, audit_trail string"
    ),
    "audit_unified_policies": "object_schema string, object_name string, policy_name string, audit_option string",
    "audit_unified_enabled_policies": "policy_name string, enabled_option string",
    "v_database": "name string, cdb string, platform_name string",
    "v_instance": "version_full string",
    "gv_instance": "inst_id bigint",
    "nls_database_parameters": "parameter string, value string",
}


def columns(view: str) -> dict[str, str]:
    """Column names of a view with their types."""
    return dict(column.split(" ") for column in SCHEMAS[view].split(", "))
