"""Restrict rows by key lists, attach lookups, merge differently shaped sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.ordering import ascending


def exclude_keys(df: DataFrame, column: str, keys: DataFrame | Sequence[str]) -> DataFrame:
    """``column NOT IN (keys)``: an unknown key drops its row, an unknown list entry drops all.

    A literal list becomes a plain filter. A one-column table becomes an anti join that Spark
    may broadcast or shuffle by its size; the null-aware form of that join can only broadcast,
    so the NULL rules are two scalar conditions beside it.
    """
    if not isinstance(keys, DataFrame):
        return df.where(~F.col(column).isin(*keys)) if keys else df
    (key,) = keys.columns
    known = keys.where(F.col(key).isNotNull()).select(F.col(key).alias(column))
    list_is_empty = ~keys.exists()
    list_is_known = ~keys.where(F.col(key).isNull()).exists()
    allowed = df.where(list_is_empty | (F.col(column).isNotNull() & list_is_known))
    return allowed.join(known, column, "left_anti").select(*df.columns)


def restrict_to_keys(df: DataFrame, columns: Sequence[str], keys: DataFrame) -> DataFrame:
    """Rows whose ``columns`` occur in ``keys``, matched by position and never multiplied."""
    renamed = keys.toDF(*columns)
    return df.join(renamed, list(columns), "left_semi").select(*df.columns)


def enrich(df: DataFrame, lookup: DataFrame, on: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """Left join a lookup; ``counts`` columns become 0 without a match, the others stay NULL."""
    joined = df.join(lookup, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts}) if counts else joined


def attach_one(df: DataFrame, lookup: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the columns of a lookup with one row per ``by`` group, or one row in all.

    Without groups the row is read as a scalar subquery, so an empty lookup gives NULLs and no
    rows are paired. Groups match NULL to NULL.
    """
    added = [c for c in lookup.columns if c not in by]
    if not by:
        row = lookup.select(F.struct(*added).alias("row")).scalar()
        return df.withColumn("_row", row).select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in added])
    right = lookup.select(*[F.col(c).alias(f"_{c}") for c in by], *added)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return df.join(right, same, "left").drop(*[f"_{c}" for c in by])


def slot_table(rows: DataFrame, slot: Column, value: Column, slots: int) -> Column:
    """``value``, an aggregate, of the rows of each of ``slots`` slots, as one scalar array; NULL where there are none.

    A lookup of fixed size for a filter: it is one subquery, known when files are read, and an element is found by
    its place, so its cost grows neither with ``rows`` nor with the rows that are filtered.
    """
    found = rows.groupBy(slot.cast("int").alias("_slot")).agg(value.alias("_value"))
    pairs = found.agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_value"))).alias("_pairs"))
    every = F.sequence(F.lit(0), F.lit(slots - 1))
    return pairs.select(F.transform(every, lambda i: F.try_element_at("_pairs", i))).scalar()


def key_slot(keys: Sequence[str], slots: int) -> Column:
    """The slot of a row's keys, by hash."""
    return F.pmod(F.hash(*keys), F.lit(slots)).cast("int")


def union_tagged(
    sources: Sequence[tuple[str, DataFrame, Mapping[str, Column]]],
    schema: Mapping[str, str],
    tag: str = "source_type",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Stack differently shaped sources as a bag of rows under one schema.

    Each source is ``(tag value, rows, {output column: expression})``; an output column it does
    not give is a typed NULL. ``keep`` columns pass through unchanged, in front.
    """
    result = None
    for label, rows, given in sources:
        columns = [given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in schema.items()]
        shaped = rows.select(*keep, F.lit(label).alias(tag), *columns)
        result = shaped if result is None else result.unionByName(shaped)
    return result


def enabled_flag(
    df: DataFrame, enabled: DataFrame, on: Sequence[str], option: str, flag: str, splits: int = 1
) -> DataFrame:
    """YES where an enabling row exists, NO elsewhere; several enabling rows repeat the row.

    With ``splits``, the rows of one key are dealt into as many parts by their place, and each enabling row is
    there for every part, so that a popular key is several tasks' work without adaptive execution.
    """
    options = enabled.select(*on, F.col(option).alias("_option"))
    keys = list(on)
    if splits > 1:
        df = df.withColumn("_split", F.pmod(F.monotonically_increasing_id(), F.lit(splits)).cast("int"))
        options = options.withColumn("_split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
        keys.append("_split")
    joined = df.join(options, keys, "left")
    yes_no = F.when(F.col("_option").isNotNull(), "YES").otherwise("NO")
    return joined.withColumn(flag, yes_no).drop("_option", "_split")


def sorted_rows(df: DataFrame, *names: str) -> DataFrame:
    """Sort ascending with NULLs last."""
    return df.orderBy(*ascending(*names))
