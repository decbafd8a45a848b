"""Fixed values the plans score and filter by; each can be replaced by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelens.sources.literals import literal_table

# Feature patterns and their portability scores. What to do about a feature, and the effort
# from 1 (least) to 5, are ours.
_FEATURES = [
    ("Partitioning", "GREEN", "keep", 2),
    ("Advanced Compression", "AMBER", "measure", 2),
    ("Transparent Data Encryption", "GREEN", "keep", 1),
    ("Real Application Clusters (RAC)", "RED", "redesign", 5),
    ("Data Guard", "AMBER", "replace", 3),
    ("Spatial and Graph", "RED", "convert", 4),
    ("OLAP", "RED", "replace", 5),
    ("Java", "RED", "rewrite", 5),
    ("Advanced Queuing", "AMBER", "replace", 3),
    ("GoldenGate", "GREEN", "keep", 1),
    ("Materialized View", "AMBER", "convert", 3),
    ("Virtual Private Database", "AMBER", "rewrite", 3),
    ("Fine-Grained Auditing", "AMBER", "convert", 2),
    ("Label Security", "RED", "redesign", 4),
    ("Database Vault", "RED", "redesign", 4),
    ("Multitenant", "AMBER", "split", 2),
    ("Sharding", "RED", "redesign", 5),
    ("Heat Map", "GREEN", "drop", 1),
    ("Automatic Data Optimization", "AMBER", "replace", 2),
    ("In-Memory", "AMBER", "measure", 2),
    ("XML DB", "AMBER", "convert", 3),
    ("Text", "AMBER", "convert", 3),
    ("Streams", "RED", "replace", 4),
    ("Change Data Capture", "RED", "replace", 4),
    ("Editions", "RED", "redesign", 3),
    ("Workspace Manager", "RED", "rewrite", 4),
]


def _note(action: str, effort: int) -> str:
    return f"{action} (effort {effort} of 5)"


RUBRIC = [(pattern, score, _note(action, effort)) for pattern, score, action, effort in _FEATURES]
RUBRIC_COLUMNS = ("feature_pattern", "target_score", "target_notes")

# Score of a feature no pattern matches, and the order of scores.
UNMATCHED = {"target_score": "AMBER", "target_notes": "assess (effort unknown)"}
SCORE_ORDER = ("RED", "AMBER", "GREEN")

# Bands of blockers, highest first, and the sort rank of any other band.
BAND_ORDER = ("HIGH", "MEDIUM")
OTHER_BAND_RANK = 3

# Schemas that belong to the database product.
EXCLUDED_OWNERS = [
    "SYS",
    "SYSTEM",
    "OUTLN",
    "DBSNMP",
    "APPQOSSYS",
    "AUDSYS",
    "GSMADMIN_INTERNAL",
    "GSMUSER",
    "GSMCATUSER",
    "DBSFWUSER",
    "REMOTE_SCHEDULER_AGENT",
    "SYSBACKUP",
    "SYSDG",
    "SYSKM",
    "SYSRAC",
    "XS$NULL",
    "OJVMSYS",
    "XDB",
    "WMSYS",
    "CTXSYS",
    "ORDSYS",
    "ORDDATA",
    "ORDPLUGINS",
    "MDSYS",
    "OLAPSYS",
    "DVSYS",
    "DVF",
    "LBACSYS",
]

# Schemas the code inventory drops although not marked as product-owned.
INVENTORY_DROPPED_OWNERS = ("AUDSYS", "GSMADMIN_INTERNAL", "REMOTE_SCHEDULER_AGENT")

# Unit types counted by the code inventory and by the hotspots.
INVENTORY_TYPES = ("PACKAGE", "PACKAGE BODY", "PROCEDURE", "FUNCTION", "TRIGGER", "TYPE", "TYPE BODY")
HOTSPOT_TYPES = ("PACKAGE BODY", "PROCEDURE", "FUNCTION", "TRIGGER", "TYPE BODY")

# Dependents refer to a specification, code lines sit in its body.
SPEC_OF_BODY = {"PACKAGE BODY": "PACKAGE", "TYPE BODY": "TYPE"}
DEPENDENT_WEIGHT = 50

# Statistic names and the columns they become.
IO_REQUESTS = {
    "physical read total IO requests": "read_reqs",
    "physical write total IO requests": "write_reqs",
}
IO_BYTES = {
    "physical read total bytes": "read_bytes",
    "physical write total bytes": "write_bytes",
    "redo size": "redo_bytes",
}
CPU_TICKS = {"BUSY_TIME": "busy_cs", "IDLE_TIME": "idle_cs"}
MEMORY_GAUGE = {"total PGA allocated": "pga_bytes"}
IDLE_WAIT_CLASS = "Idle"
CHARACTER_SET_PARAMETER = "NLS_CHARACTERSET"

# Window length and report sizes.
WINDOW_DAYS = 90
TOP_WAITS = 25
TOP_HOTSPOTS = 50
SAMPLES_PER_BLOCKER = 10
MIB = 1048576


def default_rubric(spark: SparkSession) -> DataFrame:
    return literal_table(spark, RUBRIC_COLUMNS, RUBRIC)
