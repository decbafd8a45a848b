"""Read catalog extracts into DataFrames with the schemas the plans expect."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from estatelens.sources.schemas import SCHEMAS, columns

Catalog = Mapping[str, DataFrame]

_CORRUPT = "_corrupt"


def conform(df: DataFrame, view: str, source_keys: Sequence[str] = ()) -> DataFrame:
    """Select and cast the columns of ``view``, found by name in any letter case."""
    by_name = {c.lower(): c for c in df.columns}
    wanted = columns(view)
    missing = [name for name in wanted if name not in by_name]
    if missing:
        raise ValueError(f"{view}: missing columns {missing}")
    typed = [F.col(f"`{by_name[name]}`").cast(kind).alias(name) for name, kind in wanted.items()]
    return df.select(*source_keys, *typed)


def read_catalog(
    spark: SparkSession,
    location: str,
    views: Iterable[str] = tuple(SCHEMAS),
    fmt: str = "parquet",
    source_keys: Sequence[str] = (),
    malformed: str = "fail",
    **options: str,
) -> dict[str, DataFrame]:
    """One DataFrame per view from ``<location>/<view>`` in a file format Spark reads.

    For a fleet, keep the extracts partitioned by the source keys
    (``<view>/source_id=<id>/...``): they come back as columns and prune by directory. Columns are
    found by name in any case and order, and cast to the view's types; others are ignored. CSV files of
    a view must share one header; a file with another one is an error. In JSON, one object a line, a key
    that is not there is NULL.

    A row of CSV or JSON that cannot be read is an error that names its file and line, whichever columns a
    report takes: a line that is no object, has too few or too many fields, or a value that is not of its column's
    type. With ``malformed="leave_out"`` such rows are left out, all of them and no others; ``malformed_rows`` has them.
    """
    if malformed not in ("fail", "leave_out"):
        raise ValueError(f"malformed is 'fail' or 'leave_out', not {malformed!r}")
    tables = {}
    for view in views:
        path = f"{location.rstrip('/')}/{view}"
        if fmt in _READERS:
            raw = _READERS[fmt](spark, path, view, source_keys, options)
            tables[view] = _typed(raw, view, source_keys, malformed)
        else:
            tables[view] = conform(spark.read.format(fmt).options(**options).load(path), view, source_keys)
    return tables


def malformed_rows(
    spark: SparkSession,
    location: str,
    views: Iterable[str] = tuple(SCHEMAS),
    fmt: str = "csv",
    source_keys: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """``view, file, line`` of the CSV or JSON rows that ``read_catalog`` refuses or leaves out."""
    found = []
    for view in views:
        raw = _READERS[fmt](spark, f"{location.rstrip('/')}/{view}", view, source_keys, options)
        found.append(raw.where(~_reads(view)).select(F.lit(view).alias("view"), "_file", "_line"))
    return reduce(DataFrame.unionByName, found).toDF("view", "file", "line")


def _reads(view: str) -> Column:
    """Whether a raw row is one of the view: parsed, and every value there is of its type."""
    fits = [F.col(f"_raw.{c}").isNull() | F.col(f"_raw.{c}").try_cast(kind).isNotNull() for c, kind in columns(view).items()]
    return reduce(lambda a, b: a & b, fits, F.col("_parsed"))


def _typed(raw: DataFrame, view: str, source_keys: Sequence[str], malformed: str) -> DataFrame:
    good = _reads(view)
    if malformed == "fail":
        said = F.concat(F.lit(f"{view}: malformed row in "), "_file", F.lit(": "), F.substring("_line", 1, 200))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))
    typed = [F.col(f"_raw.{c}").try_cast(kind).alias(c) for c, kind in columns(view).items()]
    return raw.where(good).select(*source_keys, *typed)


def _read_csv(
    spark: SparkSession, path: str, view: str, source_keys: Sequence[str], options: Mapping[str, str]
) -> DataFrame:
    """``_raw``, the view's columns as text, ``_parsed``, ``_file`` and ``_line`` of every row, under the files' own header."""
    reader = spark.read.options(header="true", escape='"', enforceSchema="false").options(**options)
    names = [c for c in reader.csv(path).columns if c not in source_keys]
    by_name = {c.lower(): c for c in names}
    missing = [c for c in columns(view) if c not in by_name]
    if missing:
        raise ValueError(f"{view}: missing columns {missing}")
    # All columns are parsed, so that a line with too few or too many is told from others.
    schema = StructType([StructField(c, StringType()) for c in (*names, _CORRUPT)])
    rows = reader.options(columnPruning="false", columnNameOfCorruptRecord=_CORRUPT).schema(schema).csv(path)
    values = F.struct(*[F.col(f"`{by_name[c]}`").alias(c) for c in columns(view)])
    return rows.select(
        *source_keys,
        values.alias("_raw"),
        F.col(_CORRUPT).isNull().alias("_parsed"),
        F.col("_metadata.file_path").alias("_file"),
        F.coalesce(_CORRUPT, F.to_json(values)).alias("_line"),
    )


def _read_json(
    spark: SparkSession, path: str, view: str, source_keys: Sequence[str], options: Mapping[str, str]
) -> DataFrame:
    """The same of JSON lines, with keys in any case."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    found = lines.withColumn("_keys", F.from_json("value", "map<string,string>", dict(options)))
    found = found.withColumn("_lowered", F.transform_keys("_keys", lambda key, value: F.lower(key)))
    return found.select(
        *source_keys,
        F.struct(*[F.col("_lowered")[name].alias(name) for name in columns(view)]).alias("_raw"),
        F.col("_keys").isNotNull().alias("_parsed"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("value").alias("_line"),
    )


_READERS = {"csv": _read_csv, "json": _read_json}


def read_jdbc(
    spark: SparkSession,
    url: str,
    view: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
) -> DataFrame:
    """One view straight from a database over JDBC; needs the vendor's driver on the classpath.

    Give a numeric ``column`` with its range, such as ``snap_id``, to read a history view in
    parallel; filters and columns are pushed to the database.
    """
    ranges = {"column": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    df = spark.read.jdbc(url, table, properties=dict(properties), **(ranges if column else {}))
    return conform(df, view)
