"""Catalog-shaped tables derived from the test data (FIXTURES.md, part B).

``fleet=True`` splits the same rows into five sources by a ``source_id`` column.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.plans.seeds import RUBRIC as DEFAULT_RUBRIC
from estatelens.sources import literal_table

SOURCE = "source_id"

RUBRIC = [
    ("RING", "RED", "r1"),
    ("widget", "GREEN", "g1"),
    ("small", "AMBER", "a1"),
    ("Plate", "RED", "r2"),
]

# The default rubric's patterns, and two features it does not know.
FEATURE_NAMES = [*[pattern for pattern, _, _ in DEFAULT_RUBRIC], "Resource Manager", "Flashback"]

# Columns of the test data's tables; given, no job has to read them from the files.
BASE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

STAT_FACTORS = {
    "physical read total IO requests": 1,
    "physical write total IO requests": 2,
    "physical read total bytes": 81920,
    "physical write total bytes": 16384,
    "redo size": 4096,
    "user commits": 1,
}

_ROW = ("snap_id", "instance_number", "dbid")


class Derived:
    """The derived tables of one scale folder, each built on request and once."""

    def __init__(self, spark: SparkSession, sf_dir: str, fleet: bool = False) -> None:
        self.spark, self.sf_dir, self.fleet = spark, sf_dir, fleet
        self.keys = [SOURCE] if fleet else []
        self.base = cache(self._base)
        self.events = cache(self._events)
        self.snapshots = cache(self._snapshots)
        self.dependencies = cache(self._dependencies)

    def _base(self, table: str) -> DataFrame:
        return self.spark.read.schema(BASE[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    def _source(self, number: str) -> list[str]:
        return [f"concat('S', CAST({number} % 5 AS STRING)) AS {SOURCE}"] if self.fleet else []

    # -- snapshot history ---------------------------------------------------------------------

    def _events(self) -> DataFrame:
        seconds_into_hour = "make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts))"
        return self.base("events").selectExpr(
            *self._source("user_id"),
            "CAST(user_id DIV 5 AS INT) + 1 AS instance_number",
            "CAST(1 AS BIGINT) AS dbid",
            "CAST(day(ts) * 48 + hour(ts) * 2 + IF(minute(ts) >= 30, 1, 0) AS BIGINT) AS snap_id",
            f"ts - {seconds_into_hour} + make_dt_interval(0, 0, IF(minute(ts) >= 30, 30, 0)) AS begin_interval_time",
            "IF(day(ts) >= 16, 1, 0) AS epoch_no",
            "event_type",
            "user_id",
            "CAST(round(value * 100) AS BIGINT) AS cents",
        )

    def _snapshots(self) -> DataFrame:
        columns = [*self.keys, *_ROW, "begin_interval_time"]
        return (
            self.events()
            .select(*columns)
            .distinct()
            .selectExpr(*columns, "begin_interval_time + INTERVAL '30' MINUTE AS end_interval_time")
        )

    def _running(self, value: str, *series: str) -> str:
        """A cumulative counter: restarts with ``epoch_no``. A series has one row per half hour."""
        partition = ", ".join([*self.keys, "instance_number", *series, "epoch_no"])
        return f"CAST(sum({value}) OVER (PARTITION BY {partition} ORDER BY snap_id) AS BIGINT)"

    def sysstat(self) -> DataFrame:
        stats = ", ".join(f"named_struct('stat_name', '{s}', 'k', {k})" for s, k in STAT_FACTORS.items())
        rows = self.events().groupBy(*self.keys, *_ROW, "epoch_no").agg({"cents": "sum"})
        return (
            rows.selectExpr("*", f"inline(array({stats}))")
            .where("NOT (stat_name LIKE 'physical write%' AND snap_id % 11 = 0)")
            .selectExpr(*self.keys, *_ROW, "stat_name", f"{self._running('`sum(cents)` * k', 'stat_name')} AS value")
        )

    def system_event(self) -> DataFrame:
        rows = self.events().selectExpr("*", "user_id % 9 AS slot", "cents * 1000 AS micros")
        totals = rows.groupBy(*self.keys, *_ROW, "event_type", "slot", "epoch_no").agg({"micros": "sum", "*": "count"})
        return totals.selectExpr(
            *self.keys,
            *_ROW,
            "concat(event_type, '-', CAST(slot AS STRING)) AS event_name",
            """CASE event_type WHEN 'signup' THEN 'Idle' WHEN 'error' THEN NULL
               WHEN 'click' THEN 'User I/O' ELSE 'Concurrency' END AS wait_class""",
            f"{self._running('`count(1)`', 'event_type', 'slot')} AS total_waits_fg",
            f"{self._running('`sum(micros)`', 'event_type', 'slot')} AS time_waited_micro_fg",
        )

    def osstat(self) -> DataFrame:
        busy = "event_type IN ('error', 'click')"
        rows = self.events().where("snap_id % 13 <> 0").selectExpr(
            "*", f"IF({busy}, cents, 0) AS busy", f"IF(NOT {busy}, cents, 0) AS idle"
        )
        totals = rows.groupBy(*self.keys, *_ROW, "epoch_no").agg({"busy": "sum", "idle": "sum"})
        stats = ", ".join(
            f"named_struct('stat_name', '{s}', 'v', `sum({c})`)"
            for s, c in {"BUSY_TIME": "busy", "IDLE_TIME": "idle", "LOAD": "idle"}.items()
        )
        return totals.selectExpr("*", f"inline(array({stats}))").selectExpr(
            *self.keys, *_ROW, "stat_name", f"{self._running('v', 'stat_name')} AS value"
        )

    def pgastat(self) -> DataFrame:
        rows = self.events().where("snap_id % 17 <> 0").groupBy(*self.keys, *_ROW).agg({"cents": "max"})
        return rows.selectExpr(
            *self.keys, *_ROW, "'total PGA allocated' AS name", "`max(cents)` * 1000 AS value"
        )

    # -- dictionary -----------------------------------------------------------------------------

    def features(self) -> DataFrame:
        return self.base("part").selectExpr(
            *self._source("p_size"),
            "CAST(p_size % 2 AS BIGINT) AS dbid",
            "p_name AS name",
            "IF(p_type = 'PROMO', 'TRUE', 'FALSE') AS currently_used",
            "CAST(p_size - 25 AS BIGINT) AS detected_usages",
            "CAST(p_size AS BIGINT) AS total_samples",
            "CASE WHEN p_size <= 40 THEN DATE '2023-01-01' + p_size END AS first_usage_date",
            "DATE '2023-06-01' + p_size AS last_usage_date",
            "CASE WHEN p_partkey % 7 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey AS INT) END AS last_sample_date",
            "p_partkey AS aux_count",
        )

    def rubric(self) -> DataFrame:
        return literal_table(self.spark, ["feature_pattern", "target_score", "target_notes"], RUBRIC)

    def objects(self) -> DataFrame:
        return self.base("part").selectExpr(
            *self._source("p_size"),
            "IF(p_partkey % 97 = 0, NULL, p_brand) AS owner",
            "concat(p_name, '#', CAST(p_partkey AS STRING)) AS object_name",
            "p_type AS object_type",
        )

    def excluded(self) -> DataFrame:
        return literal_table(self.spark, ["owner_name"], [("Brand#1",), ("Brand#2",), ("Brand#3",)])

    def users(self) -> DataFrame:
        return self.base("nation").selectExpr(
            *self._source("n_nationkey"),
            "n_name AS username",
            "IF(n_regionkey = 0, 'Y', 'N') AS oracle_maintained",
        )

    def _nations(self, key: str) -> DataFrame:
        return self.base("nation").selectExpr(f"n_nationkey AS {key}", "n_name")

    def _suppliers(self) -> DataFrame:
        return self.base("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")

    def _with_nation(self, table: str, nation_key: str) -> DataFrame:
        return self.base(table).join(self._nations(nation_key), nation_key)

    def source(self) -> DataFrame:
        return (
            self.base("lineitem")
            .join(self._suppliers(), "l_suppkey")
            .join(self._nations("s_nationkey"), "s_nationkey")
            .selectExpr(
                *self._source("s_nationkey"),
                "n_name AS owner",
                "CASE l_returnflag WHEN 'A' THEN 'PACKAGE' WHEN 'R' THEN 'PACKAGE BODY' ELSE 'FUNCTION' END AS type",
                "CAST(l_suppkey AS STRING) AS name",
            )
        )

    def _dependencies(self) -> DataFrame:
        orders = self.base("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        customers = self.base("customer").selectExpr("c_custkey AS o_custkey", "c_name", "c_mktsegment")
        return (
            self.base("lineitem")
            .where("l_suppkey % 5 <> 0")
            .join(orders, "l_orderkey")
            .join(customers, "o_custkey")
            .join(self._suppliers(), "l_suppkey")
            .join(self._nations("s_nationkey"), "s_nationkey")
            .selectExpr(
                *self._source("s_nationkey"),
                "c_mktsegment AS owner",
                "c_name AS name",
                "n_name AS referenced_owner",
                "IF(l_returnflag = 'A', 'PACKAGE', 'FUNCTION') AS referenced_type",
                "CAST(l_suppkey AS STRING) AS referenced_name",
            )
        )

    def part_tables(self) -> DataFrame:
        return self._with_nation("customer", "c_nationkey").selectExpr(
            *self._source("c_nationkey"),
            "n_name AS owner",
            "c_name AS table_name",
            "IF(c_custkey % 3 = 0, 'RANGE', 'LIST') AS partitioning_type",
            "c_mktsegment AS subpartitioning_type",
            "CASE WHEN c_custkey % 19 <> 0 THEN c_custkey % 50 END AS partition_count",
            "c_custkey % 4 AS def_subpartition_count",
            "CASE WHEN c_custkey % 3 = 0 THEN '1 DAY' END AS interval",
            "CASE WHEN c_custkey % 11 = 0 THEN c_name END AS ref_ptn_constraint_name",
        )

    def subpartitions(self) -> DataFrame:
        customers = self.base("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey", "c_name AS table_name")
        return (
            self.base("orders")
            .join(customers, "o_custkey")
            .join(self._nations("c_nationkey"), "c_nationkey")
            .selectExpr(*self._source("c_nationkey"), "n_name AS table_owner", "table_name")
        )

    def tables(self) -> DataFrame:
        return (
            self._with_nation("customer", "c_nationkey")
            .where("c_custkey % 5 <> 0")
            .selectExpr(
                *self._source("c_nationkey"),
                "n_name AS owner",
                "c_name AS table_name",
                "CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal) AS BIGINT) END AS num_rows",
                "DATE '2024-01-01' + CAST(c_custkey % 300 AS INT) AS last_analyzed",
            )
        )

    def fine_grained(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").selectExpr(
            *self._source("s_nationkey"),
            "n_name AS object_schema",
            "s_name AS object_name",
            "concat('POL_', CAST(s_suppkey AS STRING)) AS policy_name",
            "'COL' AS policy_column",
            "IF(s_acctbal < 0, 'NO', 'YES') AS enable",
            "'SELECT' AS statement_types",
            "'DB' AS audit_trail",
        )

    def unified(self) -> DataFrame:
        return self.base("part").selectExpr(
            *self._source("p_size"),
            "CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS object_schema",
            "CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS object_name",
            """concat(CASE WHEN p_size < 10 THEN 'ORA_' WHEN p_size < 12 THEN 'ORAX' ELSE 'APP_' END,
               CAST(p_size AS STRING)) AS policy_name""",
            "p_type AS audit_option",
        )

    def enabled(self) -> DataFrame:
        return (
            self.base("part")
            .selectExpr(
                *self._source("p_size"),
                "concat(IF(p_size < 12, 'ORAX', 'APP_'), CAST(p_size AS STRING)) AS policy_name",
                "p_brand AS enabled_option",
            )
            .distinct()
        )

    # -- production values ------------------------------------------------------------------------

    def default_features(self) -> DataFrame:
        """Features under the names of the default rubric, and two it does not know."""
        names = ", ".join(f"'{n}'" for n in FEATURE_NAMES)
        return self.features().withColumn(
            "name", F.expr(f"concat(get(array({names}), CAST(aux_count % {len(FEATURE_NAMES)} AS INT)), ' ', name)")
        )

    def default_catalog(self) -> dict[str, DataFrame]:
        """The views of the production detectors, from all rows, with some product-owned schemas."""
        views = {
            "dba_objects": ("part", "p_size", {
                "owner": "CASE p_size WHEN 7 THEN 'SYS' WHEN 8 THEN 'MDSYS' ELSE p_brand END",
                "object_name": "concat(p_name, '#', CAST(p_partkey AS STRING))",
                "object_type": "CASE p_partkey % 5 WHEN 0 THEN 'JAVA SOURCE' WHEN 1 THEN 'JAVA CLASS' "
                "WHEN 2 THEN 'JAVA RESOURCE' WHEN 3 THEN 'TABLE' ELSE 'VIEW' END",
            }),
            "dba_tab_columns": ("customer", "c_nationkey", {
                "owner": "IF(c_custkey % 7 = 0, 'XDB', c_mktsegment)",
                "table_name": "c_name",
                "column_name": "concat('C', CAST(c_nationkey AS STRING))",
                "data_type": "CASE c_custkey % 4 WHEN 0 THEN 'SDO_GEOMETRY' WHEN 1 THEN 'XMLTYPE' ELSE 'NUMBER' END",
            }),
            "dba_types": ("supplier", "s_nationkey", {
                "owner": "concat('APP_', CAST(s_nationkey AS STRING))",
                "type_name": "s_name",
                "predefined": "IF(s_suppkey % 2 = 0, 'NO', 'YES')",
            }),
            "dba_db_links": ("orders", "o_custkey", {
                "owner": "o_orderpriority", "db_link": "concat('L', CAST(o_orderkey AS STRING))"
            }),
            "dba_mviews": ("customer", "c_nationkey", {"owner": "c_mktsegment", "mview_name": "c_name"}),
            "dba_external_tables": ("supplier", "s_nationkey", {"owner": "'APP'", "table_name": "s_name"}),
            "dba_queues": ("nation", "n_nationkey", {"owner": "n_name", "name": "concat('Q_', n_name)"}),
            "dba_dependencies": ("lineitem", "l_suppkey", {
                "owner": "IF(l_returnflag = 'N', 'OUTLN', l_returnflag)",
                "name": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', "
                "CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING))",
                "referenced_owner": "IF(l_suppkey % 2 = 0, 'SYS', 'APP')",
                "referenced_name": "CASE l_partkey % 6 WHEN 0 THEN 'UTL_FILE' WHEN 1 THEN 'UTL_HTTP' "
                "WHEN 2 THEN 'UTL_SMTP' WHEN 3 THEN 'UTL_TCP' WHEN 4 THEN 'DBMS_PIPE' ELSE 'DBMS_LOCK' END",
            }),
        }
        return {
            view: self.base(table).selectExpr(*self._source(number), *[f"{e} AS {c}" for c, e in columns.items()])
            for view, (table, number, columns) in views.items()
        }

    # -- environment ----------------------------------------------------------------------------

    def database(self) -> DataFrame:
        return self.base("region").selectExpr(
            *self._source("r_regionkey"),
            "r_name AS name",
            "IF(r_regionkey % 2 = 0, 'YES', 'NO') AS cdb",
            "concat('Platform ', r_name) AS platform_name",
        )

    def instance(self) -> DataFrame:
        version = "concat('19.', CAST(user_id % 2 + 1 AS STRING)) AS version_full"
        return self.base("events").selectExpr(*self._source("user_id"), version)

    def cluster_instances(self) -> DataFrame:
        """One source of a fleet has no node rows."""
        nodes = self.snapshots().selectExpr(*self.keys, "instance_number AS inst_id").distinct()
        return nodes.where(f"{SOURCE} <> 'S4'") if self.fleet else nodes

    def parameters(self) -> DataFrame:
        return self.base("customer").selectExpr(
            *self._source("c_custkey"),
            "IF(c_custkey % 2 = 0, 'NLS_CHARACTERSET', 'NLS_LANGUAGE') AS parameter",
            "c_mktsegment AS value",
        )
