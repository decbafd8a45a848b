"""Counts: sampled inventories, unit roll-ups, fan-in, band counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.numeric import rounded_mean
from estatelens.functions.ordering import ascending
from estatelens.functions.text import concat_text
from estatelens.operators.ranking import first_rows


def sampled_inventory(
    df: DataFrame,
    label: Column,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    k: int = 10,
    sep: str = " | ",
) -> DataFrame:
    """Per group: ``object_count`` and ``sample_objects``, the first ``k`` labels in order.

    Counting combines on the map side and the samples are cut to ``k`` rows a group before any
    shuffle, so a group of any size moves a handful of rows. Groups without rows are absent.
    """
    firsts = first_rows(df, k, ascending(*order_by), by=keys)
    samples = firsts.select(*keys, *order_by, F.lit(0).cast("bigint").alias("_n"), label.alias("_label"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_label", F.lit(None).cast("string"))
    ordering = ", ".join(f"`{c}` ASC NULLS LAST" for c in order_by)
    quoted = sep.replace("'", "\\'")
    return (
        counts.unionByName(samples, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("object_count"),
            F.expr(f"listagg(_label, '{quoted}') WITHIN GROUP (ORDER BY {ordering})").alias("sample_objects"),
        )
        .where(F.col("object_count") > 0)
    )


def count_units(df: DataFrame, unit: Sequence[str], size: str) -> DataFrame:
    """Number of rows of each unit."""
    return df.groupBy(*unit).agg(F.count("*").alias(size))


def unit_rollup(units: DataFrame, size: str, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Units, total, rounded mean and largest ``size`` per group, under the four ``names``."""
    n_units, total, mean, largest = names
    n, lines = F.count("*"), F.sum(size)
    return units.groupBy(*group).agg(
        n.alias(n_units), lines.alias(total), rounded_mean(lines, n).alias(mean), F.max(size).alias(largest)
    )


def fan_in(edges: DataFrame, target: Sequence[str], source: Sequence[str], name: str = "dependents") -> DataFrame:
    """Exact number of distinct sources, compared as dotted text, that point at each target.

    Duplicates go first, by (target, source), so the sources of a popular target are spread over
    tasks; counting what is left combines on the map side.
    """
    parts = [p for c in source for p in (".", F.col(c))][1:]
    pairs = edges.select(*target, concat_text(*parts).alias("_source")).distinct()
    return pairs.groupBy(*target).agg(F.count("*").alias(name))


def band_counts(df: DataFrame, column: str, values: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Number of rows whose trimmed ``column`` equals each value, as one column per value."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} among {df.columns}")
    trimmed = F.trim(F.col(column), F.lit(" \t\r\n\v\f"))
    return df.groupBy(*by).agg(*[F.count_if(trimmed == value).alias(name) for value, name in values.items()])
