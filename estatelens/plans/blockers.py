"""Blocker inventory: objects that stand in the way of a move, counted and sampled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions import concat_text
from estatelens.operators import exclude_keys, order_by_band, sampled_inventory
from estatelens.plans.seeds import BAND_ORDER, EXCLUDED_OWNERS, OTHER_BAND_RANK, SAMPLES_PER_BLOCKER


@dataclass(frozen=True)
class Detector:
    """Rows of one view that count as one kind of blocker.

    ``where`` maps a column to its wanted values. ``sample`` columns make the label, joined by
    ``separators``, and its sort order.
    """

    blocker_name: str
    view: str
    band: str
    sample: tuple[str, ...]
    where: tuple[tuple[str, tuple[str, ...]], ...] = ()
    separators: tuple[str, ...] = (".", ".")

    def matches(self) -> Column:
        tests = [F.col(column).isin(*values) for column, values in self.where]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def label(self) -> Column:
        parts: list[Column | str] = [F.col(self.sample[0])]
        for separator, column in zip(self.separators, self.sample[1:]):
            parts += [separator, F.col(column)]
        return concat_text(*parts)


# Names, views, predicates, sample columns and bands of the detectors.
DETECTORS = (
    Detector(
        "Java in Database",
        "dba_objects",
        "HIGH",
        ("owner", "object_name"),
        (("object_type", ("JAVA SOURCE", "JAVA CLASS", "JAVA RESOURCE")),),
    ),
    Detector(
        "Spatial / SDO_GEOMETRY columns",
        "dba_tab_columns",
        "HIGH",
        ("owner", "table_name", "column_name"),
        (("data_type", ("SDO_GEOMETRY",)),),
    ),
    Detector(
        "XMLType columns",
        "dba_tab_columns",
        "MEDIUM",
        ("owner", "table_name", "column_name"),
        (("data_type", ("XMLTYPE",)),),
    ),
    Detector(
        "User-defined object/collection types in app schemas",
        "dba_types",
        "MEDIUM",
        ("owner", "type_name"),
        (("predefined", ("NO",)),),
    ),
    Detector("Database links (outgoing)", "dba_db_links", "MEDIUM", ("owner", "db_link")),
    Detector("Materialized views (refresh chains)", "dba_mviews", "MEDIUM", ("owner", "mview_name")),
    Detector("External tables", "dba_external_tables", "MEDIUM", ("owner", "table_name")),
    Detector("Advanced Queuing queues", "dba_queues", "MEDIUM", ("owner", "name")),
    Detector(
        "Code referencing UTL_FILE / UTL_HTTP / UTL_SMTP / DBMS_PIPE",
        "dba_dependencies",
        "MEDIUM",
        ("owner", "name", "referenced_name"),
        (
            ("referenced_name", ("UTL_FILE", "UTL_HTTP", "UTL_SMTP", "UTL_TCP", "DBMS_PIPE")),
            ("referenced_owner", ("SYS",)),
        ),
        (".", ":"),
    ),
)


def _hits(rows: DataFrame, detectors: Sequence[Detector], width: int, source_keys: Sequence[str]) -> DataFrame:
    """The rows of one view each detector picks, tagged; the view is scanned once for all."""
    wanted = rows.where(reduce(lambda a, b: a | b, [d.matches() for d in detectors]))
    tagged = []
    for d in detectors:
        order = [F.col(c) for c in d.sample] + [F.lit(None).cast("string")] * (width - len(d.sample))
        hit = F.struct(
            F.lit(d.blocker_name).alias("blocker_name"),
            F.lit(d.band).alias("band"),
            d.label().alias("label"),
            *[c.alias(f"sort_{i}") for i, c in enumerate(order)],
        )
        tagged.append(hit if len(detectors) == 1 else F.when(d.matches(), hit))
    if len(tagged) == 1:
        return wanted.select(*source_keys, tagged[0].alias("hit")).select(*source_keys, "hit.*")
    exploded = wanted.select(*source_keys, F.explode(F.array_compact(F.array(*tagged))).alias("hit"))
    return exploded.select(*source_keys, "hit.*")


def _all_hits(
    catalog: Mapping[str, DataFrame],
    detectors: Sequence[Detector],
    excluded_owners: DataFrame | Sequence[str],
    source_keys: Sequence[str],
) -> tuple[DataFrame, int]:
    """The objects of all blockers, and how many columns they are sorted by."""
    width = max(len(d.sample) for d in detectors)
    views: dict[str, list[Detector]] = {}
    for d in detectors:
        views.setdefault(d.view, []).append(d)
    hits = [
        _hits(exclude_keys(catalog[view], "owner", excluded_owners), group, width, source_keys)
        for view, group in views.items()
    ]
    return reduce(DataFrame.unionByName, hits), width


def blocker_counts(
    catalog: Mapping[str, DataFrame],
    detectors: Sequence[Detector] = DETECTORS,
    excluded_owners: DataFrame | Sequence[str] = EXCLUDED_OWNERS,
    source_keys: Sequence[str] = (),
) -> DataFrame:
    """``blocker_name, object_count, band`` of each blocker found, without samples."""
    hits, _ = _all_hits(catalog, detectors, excluded_owners, source_keys)
    counted = hits.groupBy(*source_keys, "blocker_name", "band").agg(F.count("*").alias("object_count"))
    return counted.select(*source_keys, "blocker_name", "object_count", "band")


def blocker_inventory(
    catalog: Mapping[str, DataFrame],
    detectors: Sequence[Detector] = DETECTORS,
    excluded_owners: DataFrame | Sequence[str] = EXCLUDED_OWNERS,
    source_keys: Sequence[str] = (),
    k: int = SAMPLES_PER_BLOCKER,
) -> DataFrame:
    """Count of each blocker outside the excluded schemas, with its first ``k`` objects by name."""
    hits, width = _all_hits(catalog, detectors, excluded_owners, source_keys)
    inventory = sampled_inventory(
        hits,
        F.col("label"),
        order_by=[f"sort_{i}" for i in range(width)],
        keys=[*source_keys, "blocker_name", "band"],
        k=k,
    ).select(*source_keys, "blocker_name", "object_count", "sample_objects", "band")
    return order_by_band(
        inventory, "band", BAND_ORDER, then=["blocker_name"], by=source_keys, otherwise=OTHER_BAND_RANK
    )
