"""Stored code: size by schema and type, and the units most worth attention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import ascending, lookup_type, weighted_score
from estatelens.operators import count_units, enrich, fan_in, restrict_to_keys, sorted_rows, top_n, unit_rollup
from estatelens.plans.seeds import (
    DEPENDENT_WEIGHT,
    HOTSPOT_TYPES,
    INVENTORY_DROPPED_OWNERS,
    INVENTORY_TYPES,
    SPEC_OF_BODY,
    TOP_HOTSPOTS,
)


def app_owners(users: DataFrame, dropped: Sequence[str] = (), source_keys: Sequence[str] = ()) -> DataFrame:
    """Schemas that do not belong to the database product."""
    owners = users.where(F.col("oracle_maintained") == "N")
    if dropped:
        owners = owners.where(~F.col("username").isin(*dropped))
    return owners.select(*source_keys, F.col("username").alias("owner"))


def code_units(source: DataFrame, source_keys: Sequence[str] = ()) -> DataFrame:
    """Lines of every stored unit, from one row per code line; input of both reports below.

    Counting comes before the owners are checked, so a schema holding most of the code is
    combined on the map side. Where the owners are few enough to broadcast, Catalyst moves that
    check below the count by itself.
    """
    lines = source.where(F.col("type").isin(*INVENTORY_TYPES))
    return count_units(lines, [*source_keys, "owner", "type", "name"], "lines_of_code")


def code_inventory(users: DataFrame, units: DataFrame, source_keys: Sequence[str] = ()) -> DataFrame:
    """Units, lines, mean and largest unit by schema and type."""
    owners = app_owners(users, INVENTORY_DROPPED_OWNERS, source_keys)
    group = [*source_keys, "owner", "object_type"]
    names = ["object_count", "total_loc", "avg_loc", "max_loc"]
    rolled = unit_rollup(units.withColumnRenamed("type", "object_type"), "lines_of_code", group, names)
    return sorted_rows(restrict_to_keys(rolled, [*source_keys, "owner"], owners), *group)


def code_hotspots(
    users: DataFrame,
    units: DataFrame,
    dependencies: DataFrame,
    source_keys: Sequence[str] = (),
    n: int | None = TOP_HOTSPOTS,
) -> DataFrame:
    """The ``n`` units with the highest lines plus weighted dependents, per source; all for None.

    Dependents of product-owned code cannot be joined below, and most dependencies are of that
    kind, so their targets are restricted too.
    """
    owners = app_owners(users, source_keys=source_keys)
    bodies = units.where(F.col("type").isin(*HOTSPOT_TYPES))
    looked_up = restrict_to_keys(bodies, [*source_keys, "owner"], owners).withColumn(
        "referenced_type", lookup_type(F.col("type"), SPEC_OF_BODY)
    )
    referable = [SPEC_OF_BODY.get(t, t) for t in HOTSPOT_TYPES]
    target = [*source_keys, "referenced_owner", "referenced_type", "referenced_name"]
    dependents = fan_in(
        dependencies.where(F.col("referenced_type").isin(*referable)), target, source=["owner", "name"]
    )
    referred = restrict_to_keys(dependents, [*source_keys, "referenced_owner"], owners).withColumnsRenamed(
        {"referenced_owner": "owner", "referenced_name": "name"}
    )
    joined = enrich(looked_up, referred, [*source_keys, "owner", "name", "referenced_type"], counts=["dependents"])
    scored = joined.select(
        *source_keys,
        "owner",
        "type",
        "name",
        "lines_of_code",
        "dependents",
        weighted_score(F.col("lines_of_code"), F.col("dependents"), DEPENDENT_WEIGHT).alias("hotspot_score"),
    )
    order = [F.col("hotspot_score").desc_nulls_last(), *ascending("owner", "type", "name")]
    return scored.orderBy(*ascending(*source_keys), *order) if n is None else top_n(scored, n, order, by=source_keys)
