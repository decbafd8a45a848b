"""Score text against a rubric of substrings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.text import contains_text
from estatelens.operators.keys import attach_one

_GRAM = 3

#: Bits of Spark's bitmaps, of the rubric's gram set here; more grams than that let more of a text's grams through.
GRAM_BITS = 1 << 15


def rubric_join(
    df: DataFrame,
    text: str,
    rubric: DataFrame,
    pattern: str,
    default: Mapping[str, str],
    texts: DataFrame | None = None,
) -> DataFrame:
    """Add the rubric columns of every pattern found in ``text``, ignoring case.

    A row with several matches is repeated; a row without one, and a NULL score, takes ``default``.

    A text that matches a pattern contains its longest piece without wildcards, hence the first
    three characters of that piece. Each pattern is looked up under that one gram by an equi join, so a
    pair meets once; the full test follows. Patterns of nothing but wildcards ask for a length alone:
    they are one array beside the texts. Distinct texts are matched, then joined back.

    ``texts``, one column that holds at least the texts of ``df``, saves computing ``df`` a second time to list them.

    The rubric's grams are one scalar of bits, of fixed size at any rubric, which a text's grams pass before they
    become rows: what the join gets is a text's possible matches, not its characters.
    """
    longest = F.reduce(
        F.split(F.upper(F.col(pattern)), "[%_]"),
        F.lit(""),
        lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a),
    )
    scored = rubric.where(F.col(pattern).isNotNull()).select(
        F.col(pattern).alias("_pattern"), F.struct(*default).alias("_score"), longest.alias("_piece")
    )
    keyed = scored.where("_piece <> ''").withColumn("_gram", F.substring("_piece", 1, _GRAM))
    every = df.select(text) if texts is None else texts
    texts = every.toDF("_text").where(F.col("_text").isNotNull()).distinct()
    beside = attach_one(texts, _summary(scored))
    probes = beside.select("_text", F.explode(_possible_grams(F.upper("_text"))).alias("_gram"))
    hits = probes.join(keyed, "_gram").where(contains_text(F.col("_text"), F.col("_pattern"))).select("_text", "_score")
    fitting = F.filter("_open", lambda p: p["least"] <= F.length("_text"))
    open_hits = beside.select("_text", F.explode(fitting).alias("_p")).select("_text", "_p._score")
    joined = df.join(hits.unionByName(open_hits), F.col(text) == F.col("_text"), "left")
    filled = {c: F.coalesce(F.col(f"_score.{c}"), F.lit(value)) for c, value in default.items()}
    return joined.withColumns(filled).select(*df.columns, *default)


def _summary(scored: DataFrame) -> DataFrame:
    """One row on a rubric: the bits and the lengths of its grams, and its patterns of nothing but wildcards."""
    gram = F.when(F.col("_piece") != "", F.substring("_piece", 1, _GRAM))
    least = F.length(F.regexp_replace("_pattern", "%", ""))
    return scored.agg(
        F.bitmap_construct_agg(F.when(gram.isNotNull(), F.pmod(F.hash(gram), F.lit(GRAM_BITS)))).alias("_bits"),
        F.array_sort(F.collect_set(F.length(gram))).alias("_lengths"),
        F.collect_list(F.when(gram.isNull(), F.struct(least.alias("least"), "_score"))).alias("_open"),
    )


def _possible_grams(text: Column) -> Column:
    """Distinct substrings of ``text`` that may be grams of the rubric: of their lengths, and with their bits set."""

    def known(gram: Column) -> Column:
        at = F.pmod(F.hash(gram), F.lit(GRAM_BITS))
        byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at % 8) == 1

    def of_length(n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.filter(F.transform(starts, lambda i: F.substring(text, i, n)), known)

    return F.array_distinct(F.flatten(F.transform("_lengths", of_length)))
