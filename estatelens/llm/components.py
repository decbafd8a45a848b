"""Connected components of a large set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rounds double the reach of a label, so this is never met by finite data.
MAX_ROUNDS = 64


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def component_labels(links: DataFrame, rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, label`` for each node of ``src, dst``; the label is the component's smallest node.

    Each round links every larger neighbour of a node to the node's smallest one, then every smaller
    neighbour likewise, until links form stars. Each round is written to the checkpoint folder, which cuts
    the lineage; only counts reach the driver. Links that are no stars after ``rounds`` are an error.
    """
    links = links.where("src <> dst")
    seen = None
    for _ in range(rounds):
        near = _both_ways(links).groupBy("src").agg(F.min("dst").alias("least"))
        near = near.select(F.col("src").alias("node"), F.least("src", "least").alias("least"))
        large = (
            _both_ways(links)
            .where("dst > src")
            .join(near.withColumnRenamed("node", "src"), "src")
            .select(F.col("dst").alias("src"), F.col("least").alias("dst"))
            .where("src <> dst")
            .distinct()
        )
        down = large.groupBy("src").agg(F.min("dst").alias("least"))
        small = (
            large.join(down, "src")
            .select(F.explode(F.array("src", "dst")).alias("src"), F.col("least").alias("dst"))
            .where("src <> dst")
            .distinct()
        )
        links = small.checkpoint()
        mark = links.agg(
            F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        ).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components are not complete after {rounds} rounds")
    tops = links.select(F.col("dst").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return links.select(F.col("src").alias("node"), F.col("dst").alias("label")).unionByName(tops)
