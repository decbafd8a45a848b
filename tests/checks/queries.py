"""Every report and operator bound to the test data, one query each."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tests.checks.derived import Derived
from tests.checks.expected import AS_OF, CAPTURED_AT, HOST, RUN_ID
from estatelens import operators as ops
from estatelens import plans
from estatelens.functions import (
    ascending,
    band_rank,
    concat_text,
    hour_label,
    lookup_type,
    safe_ratio,
)
from estatelens.plans.seeds import IO_REQUESTS, SPEC_OF_BODY
from estatelens.session import shared_folder
from estatelens.sources import checksum_manifest, literal_table, malformed_rows, read_catalog, read_rowset, write_rowset

Query = Callable[[SparkSession, str], DataFrame]

DETECTORS = (
    plans.Detector(
        "Promotional objects",
        "dba_objects",
        "HIGH",
        ("owner", "object_name"),
        (("object_type", ("PROMO", "STANDARD")),),
    ),
    plans.Detector(
        "Economy objects", "dba_objects", "MEDIUM", ("owner", "object_name"), (("object_type", ("ECONOMY",)),)
    ),
    plans.Detector(
        "Absent objects", "dba_objects", "HIGH", ("owner", "object_name"), (("object_type", ("NO SUCH TYPE",)),)
    ),
    plans.Detector("Partitioned tables", "dba_part_tables", "LOW", ("owner", "table_name")),
    plans.Detector(
        "Code referencing suppliers",
        "dba_dependencies",
        "MEDIUM",
        ("owner", "name", "referenced_name"),
        (("referenced_owner", tuple(f"NATION_{i}" for i in range(13))),),
        (".", ":"),
    ),
)


def _feature_score(d: Derived) -> DataFrame:
    return plans.feature_score(d.features(), d.rubric(), d.keys)


def _iops(d: Derived) -> DataFrame:
    return plans.iops_by_hour(d.snapshots(), d.sysstat(), AS_OF, d.keys)


def _throughput(d: Derived) -> DataFrame:
    return plans.throughput_by_hour(d.snapshots(), d.sysstat(), AS_OF, d.keys)


def _top_waits(d: Derived) -> DataFrame:
    return plans.top_waits(d.snapshots(), d.system_event(), AS_OF, d.keys)


def _cpu_memory(d: Derived) -> DataFrame:
    return plans.cpu_memory_by_snapshot(d.snapshots(), d.osstat(), d.pgastat(), AS_OF, d.keys)


def _blocker_catalog(d: Derived) -> dict[str, DataFrame]:
    return {
        "dba_objects": d.objects(),
        "dba_part_tables": d.part_tables(),
        "dba_dependencies": d.dependencies(),
    }


def _blockers(d: Derived) -> DataFrame:
    return plans.blocker_inventory(_blocker_catalog(d), DETECTORS, d.excluded(), d.keys)


def _code_units(d: Derived) -> DataFrame:
    return plans.code_units(d.source(), d.keys)


def _code_inventory(d: Derived) -> DataFrame:
    return plans.code_inventory(d.users(), _code_units(d), d.keys)


def _code_hotspots(d: Derived) -> DataFrame:
    return plans.code_hotspots(d.users(), _code_units(d), d.dependencies(), d.keys)


def _partition_topology(d: Derived) -> DataFrame:
    return plans.partition_topology(d.users(), d.part_tables(), d.subpartitions(), d.tables(), d.keys)


def _audit_policies(d: Derived) -> DataFrame:
    return plans.audit_policies(d.users(), d.fine_grained(), d.unified(), d.enabled(), d.keys)


def _fingerprint(d: Derived) -> DataFrame:
    return plans.fingerprint(d.database(), d.instance(), d.cluster_instances(), d.parameters(), d.keys)


def _manifest(d: Derived) -> DataFrame:
    return plans.manifest(_fingerprint(d), RUN_ID, CAPTURED_AT, HOST)


def _manifest_document(d: Derived) -> DataFrame:
    return plans.manifest_document(_manifest(d), d.keys)


def _scorecard(d: Derived) -> DataFrame:
    counts = plans.blocker_counts(_blocker_catalog(d), DETECTORS, d.excluded(), d.keys)
    return plans.scorecard(_feature_score(d), counts, _manifest(d), d.keys)


def _summary_document(d: Derived) -> DataFrame:
    return plans.summary_document(_scorecard(d), d.keys)


def _feature_score_default(d: Derived) -> DataFrame:
    return plans.feature_score(d.default_features(), source_keys=d.keys)


def _blockers_default(d: Derived) -> DataFrame:
    return plans.blocker_inventory(d.default_catalog(), source_keys=d.keys)


def _file_checksums(d: Derived) -> DataFrame:
    return checksum_manifest(d.spark, d.sf_dir)


# -- single operators ---------------------------------------------------------------------------


def _latest_per_key(d: Derived) -> DataFrame:
    latest = ops.latest_per_key(d.features(), ["dbid", "name"], "last_sample_date", ["aux_count"])
    return latest.select("dbid", "name", "last_sample_date", "aux_count", "detected_usages")


def _rubric(d: Derived) -> DataFrame:
    default = {"target_score": "AMBER", "target_notes": "none"}
    parts = d.base("part").select("p_partkey", "p_name")
    return ops.rubric_join(parts, "p_name", d.rubric(), "feature_pattern", default)


def _rubric_wildcards(d: Derived) -> DataFrame:
    """Patterns with wildcards, some of nothing else."""
    rows = [("r_ng", "a"), ("s%l w", "b"), ("%", "c"), ("_" * 11, "d"), ("t", "e"), ("", "f"), (None, "g")]
    rubric = literal_table(d.spark, ["feature_pattern", "target_score"], rows)
    parts = d.base("part").select("p_partkey", "p_name")
    return ops.rubric_join(parts, "p_name", rubric, "feature_pattern", {"target_score": "AMBER"})


def _order_by_band(d: Derived) -> DataFrame:
    ranking = ("PROMO", "ECONOMY")
    parts = d.base("part").select(
        "p_partkey", "p_type", band_rank(F.col("p_type"), ranking, 3).alias("band_position")
    )
    return ops.order_by_band(parts, "p_type", ranking, then=["p_partkey"], otherwise=3)


def _rolling_window(d: Derived) -> DataFrame:
    return ops.rolling_window(d.snapshots(), "begin_interval_time", AS_OF)


def _stat_pivot(d: Derived) -> DataFrame:
    return ops.stat_pivot(d.sysstat(), ["snap_id", "instance_number", "dbid"], IO_REQUESTS)


def _counter_delta(d: Derived) -> DataFrame:
    facts = d.sysstat().select("instance_number", "stat_name", "snap_id", "value")
    return ops.counter_delta(
        facts, {"value": "delta"}, ["instance_number", "stat_name"], ["snap_id"], [ops.snapshot_chunk(size=64)]
    )


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


#: No window of the query has more rows, at any scale.
LONG_PARTITION_ROWS = 256


def _counter_delta_long_partition(d: Derived) -> DataFrame:
    """Two partitions hold all events; as many levels of chunks as their range asks for."""
    instance = ((F.col("user_id") % 2).cast("int") + 1).alias("instance_number")
    events = d.base("events").select("event_id", instance, _cents().alias("cents"))
    chunks = ops.chunk_levels(events, "event_id", LONG_PARTITION_ROWS)
    return ops.counter_delta(events, {"cents": "delta"}, ["instance_number"], ["event_id"], chunks)


def _hourly_rate(d: Derived) -> DataFrame:
    events = d.base("events").select("event_type", "ts", _cents().alias("cents"), (F.col("user_id") % 60).alias("secs"))
    rates = ops.hourly_rate(events, {"cents": "cents_per_sec"}, "secs", "ts", ["event_type"])
    return rates.select("event_type", hour_label(F.col("hour_bucket")).alias("hour_utc"), "cents_per_sec")


def _top_n(d: Derived) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = d.base("lineitem").select(*keys, "l_extendedprice")
    return ops.top_n(lines, 25, [F.col("l_extendedprice").desc_nulls_last(), *ascending(*keys)])


def _top_n_per_group(d: Derived) -> DataFrame:
    orders = d.base("orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc_nulls_last(), *ascending("o_orderkey")]
    return ops.top_n(orders, 25, order, by=["o_orderpriority"])


def _safe_ratio(d: Derived) -> DataFrame:
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    ratio = safe_ratio(price, F.col("l_linenumber") - 1, 7, 2).alias("ratio")
    return d.base("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ratio)


def _sampled(d: Derived, keys: tuple[str, ...] = ()) -> DataFrame:
    label = concat_text(F.col("owner"), ".", F.col("object_name"))
    return ops.sampled_inventory(d.objects(), label, ["owner", "object_name"], keys)


def _sampled_inventory(d: Derived) -> DataFrame:
    return _sampled(d, ("object_type",))


def _exclude_keys(d: Derived) -> DataFrame:
    return ops.exclude_keys(d.objects(), "owner", d.excluded())


def _restrict_to_keys(d: Derived) -> DataFrame:
    lines = d.base("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    in_debt = d.base("supplier").where(F.col("s_acctbal") < 5000).select("s_suppkey")
    return ops.restrict_to_keys(lines, ["l_suppkey"], in_debt)


def _unit_rollup(d: Derived) -> DataFrame:
    units = ops.count_units(d.source().withColumnRenamed("type", "object_type"), ["owner", "object_type", "name"], "loc")
    names = ["object_count", "total_loc", "avg_loc", "max_loc"]
    return ops.unit_rollup(units, "loc", ["owner", "object_type"], names)


def _fan_in(d: Derived) -> DataFrame:
    return ops.fan_in(
        d.dependencies(), ["referenced_owner", "referenced_type", "referenced_name"], ["owner", "name"]
    )


def _weighted_score(d: Derived) -> DataFrame:
    """Every scored unit, where the report keeps the top ones."""
    return plans.code_hotspots(d.users(), _code_units(d), d.dependencies(), n=None)


def _normalise_key(d: Derived) -> DataFrame:
    lookup = lookup_type(F.col("type"), SPEC_OF_BODY).alias("lookup_type")
    return d.source().groupBy("owner", lookup).agg(F.count("*").alias("lines"))


def _enrich(d: Derived) -> DataFrame:
    customers = d.base("customer").select("c_custkey", "c_name")
    totals = (
        d.base("orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    )
    return ops.enrich(customers, totals, ["c_custkey"], counts=["n_orders"])


def _union_tagged(d: Derived) -> DataFrame:
    return ops.union_tagged(
        [
            (
                "CUSTOMER",
                d.base("customer"),
                {"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "balance": F.col("c_acctbal")},
            ),
            ("SUPPLIER", d.base("supplier"), {"name": F.col("s_name"), "balance": F.col("s_acctbal")}),
        ],
        {"name": "string", "segment": "string", "balance": "double"},
        tag="party_type",
    )


def _enabled_flag(d: Derived) -> DataFrame:
    return ops.enabled_flag(d.unified(), d.enabled(), ["policy_name"], "enabled_option", "enable")


def _band_counts(d: Derived) -> DataFrame:
    return ops.band_counts(d.base("part"), "p_type", {"PROMO": "promo", "ECONOMY": "economy"}, by=["p_brand"])


def _scratch(d: Derived, name: str) -> str:
    return f"{shared_folder(d.spark)}/{name}/{uuid.uuid4()}"


def _csv_rowset(d: Derived) -> DataFrame:
    """A report written as CSV to the shared folder and read back; names with blanks at their edges."""
    report = _partition_topology(d).withColumn("table_name", F.concat(F.lit("  "), "table_name", F.lit(" ")))
    path = _scratch(d, "rowsets")
    write_rowset(report, path)
    return read_rowset(d.spark, path, report.schema)


def _foreign_features(d: Derived) -> DataFrame:
    """The usage view as another tool might write it: other order and case, a column more, several files.

    One row of fifty has a count that is no number.
    """
    f = d.features()
    counts = F.when(F.col("aux_count") % 50 == 0, "n/a").otherwise(F.col("detected_usages").cast("string"))
    return f.select(
        F.lit(1).alias("USER_ID"),
        F.date_format("last_sample_date", "yyyy-MM-dd").alias("LAST_SAMPLE_DATE"),
        counts.alias("DETECTED_USAGES"),
        F.concat(F.lit(" "), "name", F.lit('" ,x')).alias("NAME"),
        *[F.col(c).alias(c.title()) for c in ("dbid", "currently_used", "total_samples", "aux_count")],
        *[F.date_format(c, "yyyy-MM-dd").alias(c.upper()) for c in ("first_usage_date", "last_usage_date")],
    ).repartition(5, "AUX_COUNT")


def _foreign_view(d: Derived, fmt: str) -> DataFrame:
    """Read back, with what could not be read beside it: a row with the number of malformed ones."""
    folder, view = _scratch(d, f"catalog_{fmt}"), "dba_feature_usage_statistics"
    written = _foreign_features(d)
    if fmt == "csv":
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        written.write.csv(f"{folder}/{view}", header=True, quoteAll=True, escape='"', nullValue="", emptyValue="", **kept)
    else:
        lines = F.to_json(F.struct(*written.columns))
        # Some lines break off as well.
        cut = F.when(F.col("AUX_COUNT") % 77 == 0, F.substring(lines, 1, 40)).otherwise(lines)
        written.select(cut).write.text(f"{folder}/{view}")
    read = read_catalog(d.spark, folder, [view], fmt, malformed="leave_out")[view]
    bad = malformed_rows(d.spark, folder, [view], fmt).groupBy("view").agg(F.count("*").alias("n"))
    return read.unionByName(bad.select(F.concat("view", F.lit(": malformed")).alias("name"), F.col("n").alias("aux_count")), True)


def _catalog_csv(d: Derived) -> DataFrame:
    return _foreign_view(d, "csv")


def _catalog_json(d: Derived) -> DataFrame:
    return _foreign_view(d, "json")


def _row_text(rows: DataFrame) -> Column:
    """Values by bar, rates as whole thousandths, so that engines write them alike."""
    kinds = dict(rows.dtypes)
    return F.concat_ws("|", *[F.round(F.col(c) * 1000).cast("bigint") if kinds[c] == "double" else F.col(c) for c in rows.columns])


def _bundle_readback(d: Derived) -> DataFrame:
    """A whole bundle, written, and all of it read back: ten reports, both documents, and the wrong checksums."""
    catalog = d.default_catalog() | {
        "dba_feature_usage_statistics": d.default_features(),
        "dba_hist_snapshot": d.snapshots(),
        "dba_hist_sysstat": d.sysstat(),
        "dba_hist_system_event": d.system_event(),
        "dba_hist_osstat": d.osstat(),
        "dba_hist_pgastat": d.pgastat(),
        "dba_users": d.users(),
        "dba_source": d.source(),
        "dba_dependencies": d.dependencies(),
        "dba_part_tables": d.part_tables(),
        "dba_tab_subpartitions": d.subpartitions(),
        "dba_tables": d.tables(),
        "dba_audit_policies": d.fine_grained(),
        "audit_unified_policies": d.unified(),
        "audit_unified_enabled_policies": d.enabled(),
        "v_database": d.database(),
        "v_instance": d.instance(),
        "gv_instance": d.cluster_instances(),
        "nls_database_parameters": d.parameters(),
    }
    out = plans.write_bundle(d.spark, catalog, _scratch(d, "bundles"), RUN_ID, CAPTURED_AT, HOST, AS_OF)
    parts = []
    for place, report in plans.rowsets(catalog, AS_OF).items():
        rows = read_rowset(d.spark, f"{out}/{place}", report.schema)
        parts.append(rows.select(F.lit(place).alias("report"), _row_text(rows).alias("row_text")))
    for place in ("manifest.json", "summary/mab_summary.json"):
        parts.append(d.spark.read.text(f"{out}/{place}").select(F.lit(place).alias("report"), F.col("value").alias("row_text")))
    said = d.spark.read.text(f"{out}/checksums.sha256").select(F.col("value").alias("line"))
    found = checksum_manifest(d.spark, out).select(F.concat("sha256", F.lit("  "), "path").alias("line"))
    wrong = said.exceptAll(found).unionByName(found.exceptAll(said)).agg(F.count("*").cast("string").alias("row_text"))
    parts.append(wrong.select(F.lit("checksums.sha256").alias("report"), "row_text"))
    return reduce(DataFrame.unionByName, parts)


_JOBS = {
    "feature_score": _feature_score,
    "iops_by_hour": _iops,
    "throughput_by_hour": _throughput,
    "top_waits": _top_waits,
    "cpu_memory_by_snapshot": _cpu_memory,
    "blocker_inventory": _blockers,
    "code_inventory": _code_inventory,
    "code_hotspots": _code_hotspots,
    "partition_topology": _partition_topology,
    "audit_policies": _audit_policies,
    "fingerprint": _fingerprint,
    "manifest_document": _manifest_document,
    "scorecard": _scorecard,
    "summary_document": _summary_document,
    "file_checksums": _file_checksums,
    "bundle_readback": _bundle_readback,
    "feature_score_default": _feature_score_default,
    "blocker_inventory_default": _blockers_default,
}

_SINGLE_SOURCE_ONLY = ("file_checksums", "bundle_readback")
_FLEET = {name: build for name, build in _JOBS.items() if name not in _SINGLE_SOURCE_ONLY}

_OPERATORS = {
    "latest_per_key": _latest_per_key,
    "rubric_join": _rubric,
    "rubric_join_shuffled": _rubric,
    "rubric_join_wildcards": _rubric_wildcards,
    "order_by_band": _order_by_band,
    "rolling_window": _rolling_window,
    "stat_pivot": _stat_pivot,
    "counter_delta": _counter_delta,
    "counter_delta_long_partition": _counter_delta_long_partition,
    "hourly_rate": _hourly_rate,
    "top_n": _top_n,
    "top_n_per_group": _top_n_per_group,
    "safe_ratio": _safe_ratio,
    "sampled_inventory": _sampled_inventory,
    "sampled_inventory_whole_table": _sampled,
    "exclude_keys": _exclude_keys,
    "restrict_to_keys": _restrict_to_keys,
    "unit_rollup": _unit_rollup,
    "fan_in": _fan_in,
    "weighted_score": _weighted_score,
    "normalise_key": _normalise_key,
    "enrich": _enrich,
    "union_tagged": _union_tagged,
    "enabled_flag": _enabled_flag,
    "band_counts": _band_counts,
    "csv_rowset": _csv_rowset,
    "catalog_csv": _catalog_csv,
    "catalog_json": _catalog_json,
}


def _bound(build: Callable[[Derived], DataFrame], fleet: bool = False) -> Query:
    return lambda spark, sf_dir: build(Derived(spark, sf_dir, fleet))


def registered() -> dict[str, Query]:
    queries = {name: _bound(build) for name, build in (_JOBS | _OPERATORS).items()}
    return queries | {f"fleet_{name}": _bound(build, fleet=True) for name, build in _FLEET.items()}
