"""Resampling documents towards a target by hashed n-gram features.

Texts are cut into lines. A line's features are found once, however often it occurs, and count as often as
it occurs; runs of words that go over a line's end are found per text and added. Whatever its size, a corpus
comes down to one count for each bucket, and a line to one sum of gains.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.words import ALNUM_BYTES, ALNUM_WORD, Words, ascii_lower, pieces, text_bytes
from estatelens.session import shared_folder

#: Fixed values of the production query.
BUCKETS = 10_000
MOST_WORDS = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

#: A line that makes up more than one of so many lines is frequent; there are fewer than so many of them.
FREQUENT = 1000

_KEY = ["doc_id", "text_key", "part"]


def feature_buckets(words: Column, most_words: int, buckets: int) -> Column:
    """The bucket of every run of 1 to ``most_words`` of ``words``."""

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        runs = words if n == 1 else F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        hashed = F.transform(runs, lambda run: (F.crc32(run.cast("binary")) % buckets).cast("int"))
        return F.when(F.size(words) >= n, hashed).otherwise(F.array().cast("array<int>"))

    lists = [of_length(n) for n in range(1, most_words + 1)]
    return lists[0] if most_words == 1 else F.concat(*lists)


def _crossing(docs: DataFrame, most_words: int, buckets: int) -> DataFrame:
    """For each text the buckets of runs of words that begin in one line and end in another."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                line = np.cumsum(found.buffer == 10)[found.starts] if len(found) else np.zeros(0, np.int64)
                of_text = found.of_text()
                owners, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for n in range(2, most_words + 1):
                    starts = found.gram_starts(n)
                    starts = starts[line[starts] != line[starts + n - 1]]
                    owners.append(of_text[starts])
                    runs = (b" ".join(found.words(i, i + n)) for i in starts.tolist())
                    values.append(np.fromiter((zlib.crc32(run) % buckets for run in runs), np.int64, len(starts)))
                owner, value = np.concatenate(owners), np.concatenate(values)
                order = np.argsort(owner, kind="stable")
                counts = np.bincount(owner, minlength=piece.num_rows)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in _KEY), lists], [*_KEY, "buckets"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_KEY, "text").mapInArrow(emit, f"doc_id {kind}, text_key binary, part int, buckets array<int>")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows equal in id and text share a key within an input partition, so no key outgrows one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), _digest(text).alias("text_key"), F.spark_partition_id().alias("part"))


def line_features(keyed: DataFrame, most_words: int, buckets: int) -> DataFrame:
    """``line_key, occurrences, n_words, buckets`` of each distinct line."""
    lines = keyed.select(F.explode(F.split("text", "\n")).alias("line"))
    counted = lines.groupBy("line").agg(F.count("*").alias("occurrences"))
    words = counted.select(
        _digest(F.col("line")).alias("line_key"),
        "occurrences",
        F.regexp_extract_all(ascii_lower(F.col("line")), F.lit(ALNUM_WORD), F.lit(0)).alias("words"),
    )
    return words.select(
        "line_key",
        "occurrences",
        F.size("words").alias("n_words"),
        feature_buckets(F.col("words"), most_words, buckets).alias("buckets"),
    )


def bucket_counts(lines: DataFrame, crossing: DataFrame | None) -> DataFrame:
    """``bucket, n`` over all texts; a line's features count as often as the line occurs."""
    each = lines.select(F.explode("buckets").alias("bucket"), "occurrences")
    if crossing is not None:
        each = each.unionByName(crossing.select(F.explode("buckets").alias("bucket"), F.lit(1).alias("occurrences")))
    return each.groupBy("bucket").agg(F.sum("occurrences").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of each bucket, from both counts: ``buckets`` numbers, whatever the corpus."""

    def counts(rows: DataFrame) -> DataFrame:
        return rows.select("bucket", "n")

    spark = source.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (
        every.join(counts(source).withColumnRenamed("n", "s"), "bucket", "left")
        .join(counts(target).withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
        .toPandas()
        .sort_values("bucket")
    )
    s, t = both["s"].tolist(), both["t"].tolist()
    all_s, all_t = sum(s), sum(t)
    return [
        math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)
    ]


def _gain(buckets: Column, gains: Column) -> Column:
    return F.aggregate(buckets, F.lit(0).cast("bigint"), lambda total, b: total + F.get(gains, b))


def document_weights(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight``, one row per row of ``docs``; see ``importance_resample``."""
    shared_folder(docs.sparkSession)
    keyed = _keyed(docs)
    # Written once: both the counts over the corpus and every document's sum go back to a line's features.
    lines = line_features(keyed, most_words, buckets).checkpoint()
    wanted = _keyed(target.select(F.lit(0).alias("doc_id"), "text"))
    over_ends = _crossing(keyed, most_words, buckets) if most_words > 1 else None
    wanted_over_ends = _crossing(wanted, most_words, buckets) if most_words > 1 else None
    gains = bucket_gains(
        bucket_counts(lines, over_ends), bucket_counts(line_features(wanted, most_words, buckets), wanted_over_ends), buckets
    )
    table = F.lit(np.array(gains, np.int64))
    values = lines.select(
        "line_key", "n_words", F.size("buckets").alias("n_features"), _gain(F.col("buckets"), table).alias("gain")
    )
    # Frequent lines are fewer than FREQUENT, so a broadcast of their keys is bounded. The rows that hold one look
    # it up here and take a key of their own into the join, which spreads them; the others meet their line there.
    total = lines.agg(F.sum("occurrences")).scalar()
    often = lines.where(F.col("occurrences") * FREQUENT > total).select(
        "line_key",
        F.struct("n_words", F.size("buckets").alias("n_features"), _gain(F.col("buckets"), table).alias("gain")).alias("often"),
    )
    placed = keyed.select(*_KEY, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    own = F.unhex(F.md5(F.concat_ws(":", F.hex("text_key"), "part", "place", "doc_id").cast("binary")))
    placed = placed.select(
        *_KEY, (F.col("place") == 0).cast("bigint").alias("rows"), _digest(F.col("line")).alias("line_key"), own.alias("own")
    )
    placed = placed.join(F.broadcast(often), "line_key", "left").withColumn(
        "line_key", F.when(F.col("often").isNull(), F.col("line_key")).otherwise(F.col("own"))
    )
    rare = values.select("line_key", F.struct("n_words", "n_features", "gain").alias("rare"))
    found = placed.join(rare, "line_key", "left").select(*_KEY, "rows", F.coalesce("often", "rare").alias("line"))
    sums = found.select(*_KEY, "rows", "line.*")
    if over_ends is not None:
        crossing = over_ends.select(
            *_KEY,
            F.lit(0).cast("bigint").alias("rows"),
            F.lit(0).alias("n_words"),
            F.size("buckets").alias("n_features"),
            _gain(F.col("buckets"), table).alias("gain"),
        )
        sums = sums.unionByName(crossing)
    texts = sums.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("rows", "n_words", "n_features", "gain")])
    # Equal rows of a partition were added up.
    each = [F.expr(f"{c} div rows").alias(c) for c in ("n_words", "n_features", "gain")]
    one = texts.select("doc_id", "rows", *each)
    weight = F.expr("(gain - pmod(gain, nullif(n_features, 0))) div nullif(n_features, 0)")
    return one.select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("copy"),
        "doc_id",
        "n_words",
        "n_features",
        F.coalesce(weight, F.lit(0)).cast("bigint").alias("weight"),
    ).drop("copy")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add each row's place, from 1, in the order of the whole table; no task sorts more than its range.

    Rows are dealt into ranges and written with the number of their range; ranges are counted, one number
    each, and a row's place is that of its range and its place in it.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each of the ranges, whose number is a setting.
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.withColumn("_within", within).join(F.broadcast(starts), "_range")
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_range", "_within", "_start")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    most_words: int = MOST_WORDS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of ``docs``.

    Features are runs of 1 to ``most_words`` words, in ``buckets`` by CRC-32. A bucket's gain compares its
    share of ``target``'s features with its share of ``docs``'s; ``weight`` is the floored mean over a
    document, and ``score`` adds Gumbel noise drawn from seed and id. Of the documents with ``least_words``
    words, ``percent`` of a hundred are drawn by score, ties to the smaller id (null last, then fewer features);
    ``rank`` is null for all others.

    A null or empty text has no features and weight 0; a null id draws as an empty one; equal rows count and
    are drawn one by one; with no rows, or no target, counts are 0. Columns other than ``doc_id`` and ``text`` are
    not read, whatever their names.
    """
    weighted = document_weights(docs, target, buckets, most_words)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    scored = weighted.withColumn("score", F.col("weight") + noise).checkpoint()
    able = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc()]
    places = ranked(scored.where(able), order)
    drawn = F.floor(F.lit(percent) * scored.where(able).agg(F.count("*")).scalar() / 100)
    placed = places.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.unionByName(others)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with all their columns; rows without an id stay out.

    Rows of one id go together if one of them is drawn. Options are those of ``importance_resample``.
    """
    found = importance_resample(docs, target, **options).where("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
