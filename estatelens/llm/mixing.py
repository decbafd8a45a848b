"""Mixing sources by a curriculum whose weights change over training.

Each source has a target of words. How its share of the stream changes is a schedule, a piecewise linear
weight over training from 0 to 1. The schedule's integral is the share of the target that is due by then;
a document's position is the time at which the words before it in its source are due, and the mix is the
range sort by position: what is taken of a document are its copies in the sorted mix, and where they stand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.resampling import ranked

#: Weights by place of the source, the share of all words to take, copies at most.
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MOST_COPIES = 2

#: Weight at the start and at the end of training, by place of the source: early, late, even.
SCHEDULES = ((3.0, 1.0), (1.0, 3.0), (1.0, 1.0))

#: Hexadecimal digits of a source's parts; running sums are taken within parts, then over parts.
PART_DIGITS = 3

SALTS = 64


def word_count(text: Column) -> Column:
    """Words between white space; null has none."""
    clean = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, r"[\x20\x09-\x0D]+"))).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = TOTAL_PERCENT,
    copies: int = MOST_COPIES,
) -> DataFrame:
    """``source, place, source_size, target`` from ``source, size``.

    Sources, by code point with null last, take the weights in turn. A target stops at ``copies`` times
    its source; what is over is shared again by weight. In the order in which sources reach their stop, the
    ones before a source are stopped if the level they leave is above its own.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int"))
    rows = one.withColumn("place", place).withColumn("weight", weight).withColumn("stop", F.col("source_size") * copies)
    full = Window.orderBy((F.col("stop") / F.col("weight")), "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumn("stopped", F.coalesce(F.sum("stop").over(before), F.lit(0)))
    rows = rows.withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("total", F.sum("source_size").over(whole) * percent)
    # The level, words per weight, if this source and all after it are not stopped.
    level = (F.col("total") - F.col("stopped") * 100) / (F.col("open") * 100)
    rows = rows.withColumn("level", level).withColumn("over", F.col("level") * F.col("weight") >= F.col("stop"))
    # The first open source's level; any after it, as if that one were stopped, are lower.
    settled = F.max(F.when(~F.col("over"), F.col("level"))).over(whole)
    target = F.when(F.col("over"), F.col("stop").cast("double")).otherwise(settled * F.col("weight"))
    return rows.select("source", "place", "source_size", target.cast("double").alias("target"))


def due_time(share: Column, start: Column, end: Column) -> Column:
    """When a share of the target is due: the inverse of the schedule's integral.

    The weight goes from ``start`` to ``end``; its integral to ``t`` over its whole is
    ``(start t + (end - start) t^2 / 2) / ((start + end) / 2)``.
    """
    area = share * (start + end) / 2
    slope = end - start
    # The root in a form that holds for an even schedule as well.
    return 2 * area / (start + F.sqrt(F.greatest(start * start + 2 * slope * area, F.lit(0.0))))


def _sized(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Rows with ``size`` and the ``part`` of their source.

    Parts are dealt by the hash of the id and are in its order. Rows without an id share one hash, so
    they are parts of their own, by the hash of the text that tells them apart.
    """
    draw = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text_draw = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried") if carry else F.lit(None).alias("carried"),
        "doc_id",
        "source",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_name"),
        draw.alias("draw"),
        text_draw.alias("text_draw"),
        word_count(F.col("text")).alias("size"),
    )
    nobody = F.md5(F.lit("").cast("binary"))
    without_id = F.concat(F.lit("1"), F.substring("text_draw", 1, PART_DIGITS))
    place = F.when(F.col("doc_id").isNull(), without_id).when(F.col("draw") < nobody, "0").otherwise("2")
    return rows.withColumn("part", F.concat(F.substring("draw", 1, PART_DIGITS), place))


def _parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("no_source", "source_name", "source", "part").agg(F.sum("size").alias("part_size"))


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with ``ahead``, the words before them in their source.

    Sums run within parts of a source, dealt by hash, and then over parts, so a source that holds most
    rows is many small windows.
    """
    key = ["no_source", "source_name", "part"]
    over_parts = Window.partitionBy("no_source", "source_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(over_parts), F.lit(0)))
    within = Window.partitionBy(*key).orderBy("draw", "doc_id", "text_draw", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(within), F.lit(0))
    return (
        rows.withColumn("within", ahead)
        .join(parts.select(*key, "part_start"), key)
        .select("carried", "doc_id", "source", "size", (F.col("part_start") + F.col("within")).alias("ahead"))
    )


def _scheduled(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    percent: int = TOTAL_PERCENT,
    copies: int = MOST_COPIES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``carried`` (if any), ``doc_id, source, size, source_size, target`` and ``due``, the position of each copy to take."""
    rows = _sized(docs, carry)
    if not carry:
        # Without texts rows are narrow: they are kept, and the texts are read once.
        rows = rows.checkpoint()
    parts = _parts(rows).checkpoint()
    sizes = parts.select("source", F.col("part_size").alias("size"))
    pairs = F.array(*[F.struct(F.lit(float(a)).alias("first"), F.lit(float(b)).alias("last")) for a, b in schedules])
    named = source_targets(sizes, weights, percent, copies).select(
        F.col("source").alias("named_source"),
        "source_size",
        "target",
        F.get(pairs, (F.col("place") % len(schedules)).cast("int")).alias("schedule"),
        # One row per source; each is there once per salt, so a source with most rows is spread.
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    placed = _placed(rows, parts).withColumn("salt", F.pmod(F.xxhash64("doc_id", "ahead"), F.lit(SALTS)).cast("int"))
    rows = placed.join(named, placed["source"].eqNullSafe(named["named_source"]) & (placed["salt"] == named["salt"]))
    rounds = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("bigint")
    rest = F.col("target") - rounds * F.col("source_size")
    last = (F.col("ahead") * 2 + F.col("size") <= rest * 2).cast("bigint")
    times = F.when(F.col("size") == 0, F.lit(0).cast("bigint")).otherwise(F.least(rounds + last, F.lit(copies)))

    def due(copy: Column) -> Column:
        # A source without words has target 0, and nothing of it is due.
        share = F.least(F.try_divide(F.col("ahead") + copy * F.col("source_size"), F.col("target")), F.lit(1.0))
        return due_time(share, F.col("schedule.first"), F.col("schedule.last"))

    every = F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), due)
    return rows.select(
        *(["carried"] if carry else []),
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.slice(every, F.lit(1), times.cast("int")).alias("due"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    percent: int = TOTAL_PERCENT,
    copies: int = MOST_COPIES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken, positions, places`` of each row of ``docs``.

    Within a source, rows are in the order of a hash of their id (ties by id, then by a hash of the text;
    rows equal in all of these are told apart by nothing that shows). The mix goes through that order in rounds until the target's words
    are taken: whole rounds, and a last one up to the document whose middle is the end. So the words taken
    are within one document of the target, and no document is taken more than ``copies`` times.
    ``positions``, between 0 and 1, say when each copy is due. All copies are range-sorted by position, in the
    order of ``mixed_documents`` (ties by source and size); ``places``, from 1, say where they stand in the whole mix,
    and ``copies`` and ``taken`` count what is there. ``carry`` names columns kept in ``carried``.

    Null and empty texts have size 0 and are not taken. A null source is a source; a source without words
    has target 0. Reruns agree.
    """
    rows = _scheduled(docs, weights, schedules, percent, copies, carry)
    # Written, so that a row keeps its number whatever is computed again.
    rows = rows.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    stream = rows.select("row", "doc_id", "source", "size", F.posexplode("due").alias("copy", "position"))
    order = [F.col("position"), F.xxhash64("doc_id"), *map(F.col, ("doc_id", "copy", "source", "size", "row"))]
    mix = ranked(stream, order, "place").groupBy("row").agg(
        F.sum("size").alias("taken"), F.sort_array(F.collect_list(F.struct("copy", "position", "place"))).alias("in_mix")
    )
    there = F.coalesce("in_mix", F.array().cast("array<struct<copy:int,position:double,place:bigint>>"))
    return rows.join(mix, "row", "left").select(
        *(["carried"] if carry else []),
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.size(there).cast("bigint").alias("copies"),
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        F.transform(there, lambda c: c["position"]).alias("positions"),
        F.transform(there, lambda c: c["place"]).alias("places"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs`` with ``mix_copy`` (from 0) and ``mix_position``, range-sorted by it.

    Each row is there as often as it is taken. Rows that have a column of one of these names are refused. Options are those of ``mix_sources``.
    """
    columns = docs.columns
    if taken_names := {"mix_copy", "mix_position"} & set(columns):
        raise ValueError(f"columns of the mix are there already: {sorted(taken_names)}")
    taken = _scheduled(docs, carry=columns, **options)
    rows = taken.select("carried", F.posexplode("due").alias("mix_copy", "mix_position"))
    rows = rows.select(*[F.col("carried").getField(c).alias(c) for c in columns], "mix_copy", "mix_position")
    return rows.orderBy("mix_position", F.xxhash64("doc_id"), "doc_id", "mix_copy")
