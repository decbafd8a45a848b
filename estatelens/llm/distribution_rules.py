"""Quality rules by divergence from language references, with built-in functions only.

Each text gives two histograms, of classes of characters and of its language's common words, which are those
that most of the language's texts hold. The histograms of a language's texts, added up, are the language's
reference. A text far from its reference, by Jensen-Shannon distance, is not kept; a short text says too little
and is not judged so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_WORDS = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

#: Texts with fewer words are not compared with a reference.
CLASS_WORDS = 30
COMMON_WORDS = 60

#: Distances, between 0 and 1, from which a text is too far from its language.
CLASS_DISTANCE = 0.33
COMMON_DISTANCE = 0.305

#: Common words of a language, and texts that each of them has to be in; a language without so many has no
#: reference of its own.
LISTED_WORDS = 16
LEAST_TEXTS = 20

#: Languages whose word lists and references are broadcast, some 1 KB each; more of them are met by shuffles.
BROADCAST_LANGUAGES = 4096

_SPACES = " \t\n\x0b\x0c\r"
_SPLIT = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
_CLASSES = {"upper": r"[A-Z]+", "digit": r"[0-9]+", "mark": r"[!?]+", "stop": r"""[.,;:'"()-]+"""}
#: Most of a text, and in none of the counted classes: taken off first, so that they are counted in the little that is left.
_PLAIN = r"[a-z \n]+"

#: One character for each place in a list of common words, after that of all other words.
_CODES = "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _without(text: Column, pattern: str) -> Column:
    """How many characters the pattern takes."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def sorted_windows(grams: Column) -> Column:
    """The windows' hashes with their places, by hash; only for a text with equal hashes, else empty."""
    placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), placed).otherwise(none)


def repeated_words(placed: Column, size: int = WINDOW_WORDS) -> Column:
    """Words inside windows that occur twice or more, from ``sorted_windows``.

    Windows next to an equal hash are repeated, and each covers words up to the next one's start.
    """
    none = F.array(F.lit(None).cast("struct<h:bigint,at:int>"))
    before = F.concat(none, F.slice(placed, 1, F.size(placed) - 1))
    after = F.concat(F.slice(placed, 2, F.size(placed)), none)
    around = F.arrays_zip(placed.alias("x"), before.alias("b"), after.alias("a"))
    repeated = F.filter(around, lambda z: (z["x"]["h"] == z["b"]["h"]) | (z["x"]["h"] == z["a"]["h"]))
    starts = F.sort_array(F.transform(repeated, lambda z: z["x"]["at"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda done, at: F.struct(
            (at + size).alias("end"), (done["n"] + at + size - F.greatest(done["end"], at)).alias("n")
        ),
        lambda done: done["n"],
    )
    return F.when(F.size(placed) > 0, covered).otherwise(0).cast("bigint")


def _words(text: Column) -> Column:
    clean = F.btrim(text, F.lit(_SPACES))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, _SPLIT))


def _with_windows(rows: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``rows`` with ``grams``, a hash of every window of ``words``: made of hashes of its halves, each made once."""
    rows = rows.withColumn("grams", F.transform("words", lambda w: F.xxhash64(w))).withColumn("one", F.col("grams"))
    span = 1
    while span < size:
        step, other = (span, "grams") if 2 * span <= size else (1, "one")
        shifted = F.slice(other, span + 1, F.size(other))
        rows = rows.withColumn("grams", F.zip_with("grams", shifted, lambda a, b: F.xxhash64(a, b)))
        span += step
    whole = F.slice("grams", F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(0)))
    return rows.withColumn("grams", whole).drop("one")


def common_words(docs: DataFrame, listed_words: int = LISTED_WORDS, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """``language, listed``: the words of letters that most texts of a language hold, the most frequent first, then by word.

    A language has them only if each is in ``least_texts`` texts. Null is no language.
    """
    words = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").alias("language"), F.explode(F.array_distinct(_words(F.lower("text")))).alias("word")
    )
    counted = words.groupBy("language", "word").agg(F.count("*").alias("n"))
    counted = counted.where((F.col("n") >= least_texts) & ~F.col("word").rlike(r"[\x00-\x60\x7B-\x7F]"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word"))
    first = counted.withColumn("place", place).where(F.col("place") <= listed_words)
    lists = first.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("listed"))
    return lists.where(F.size("listed") == listed_words).select("language", F.col("listed.word").alias("listed"))


def measures(docs: DataFrame, lists: DataFrame, listed_words: int = LISTED_WORDS) -> DataFrame:
    """Counts of each row's text and its two histograms, ``classes`` and ``common``; ``language`` is null without a list."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), "lang").join(lists, F.col("lang") == F.col("language"), "left")
    # No listed word has a comma, and a word with one is not found in the list.
    listed = F.array_join("listed", ",").alias("listed")
    rows = _with_windows(rows.select("doc_id", "text", "language", listed, _words(F.col("text")).alias("words")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != "")

    def code(word: Column) -> Column:
        return F.substring(F.lit(_CODES), F.find_in_set(F.lower(word), "listed") + 1, F.lit(1))

    # One character per word, so that each word is looked up once.
    codes = F.when(F.col("listed").isNotNull(), F.array_join(F.transform("words", code), ""))
    rows = rows.select(
        "doc_id",
        "text",
        "language",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "grams",
        lines.alias("lines"),
        codes.alias("codes"),
        F.regexp_replace("text", _PLAIN, "").alias("classed"),
    )
    rows = rows.select(
        "*",
        _without(F.col("classed"), _SYMBOLS).alias("n_symbols"),
        *[_without(F.col("classed"), p).alias(name) for name, p in _CLASSES.items()],
    )

    def seen(one: str) -> Column:
        return (F.char_length("codes") - F.char_length(F.replace("codes", F.lit(one), F.lit("")))).cast("double")

    found = F.array(*map(seen, (*_CODES[1 : listed_words + 1], _CODES[0])))
    alone = F.array(F.col("n_words").cast("double"))
    space = F.char_length("text") - F.col("word_chars")
    named = [space, F.col("n_symbols"), *map(F.col, _CLASSES)]
    letters = F.char_length("text") - sum(named[1:], named[0])
    return rows.select("*", sorted_windows(F.col("grams")).alias("placed")).select(
        "doc_id",
        "language",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("placed")).alias("n_repeat_words"),
        F.array(*[x.cast("double") for x in (*named, letters)]).alias("classes"),
        F.when(F.col("codes").isNotNull(), found).otherwise(alone).alias("common"),
    )


def jensen_shannon(a: Column, b: Column) -> Column:
    """Distance, 0 to 1, of two histograms; nothing is as far from nothing as from itself."""

    def share(x: Column) -> Column:
        total = F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
        both = F.arrays_zip(x.alias("v"), F.array_repeat(total, F.size(x)).alias("t"))
        return F.transform(both, lambda z: F.coalesce(F.try_divide(z["v"], z["t"]), F.lit(0.0)))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(share(a), share(b), lambda p, q: (part(p, q) + part(q, p)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, v: s + v), F.lit(0.0)))


def quality_rules(
    docs: DataFrame,
    class_distance: float = CLASS_DISTANCE,
    common_distance: float = COMMON_DISTANCE,
    listed_words: int = LISTED_WORDS,
    least_texts: int = LEAST_TEXTS,
    broadcast_languages: int = BROADCAST_LANGUAGES,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, lang``): counts, distances, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Common words and references come from all rows, so a row
    repeated counts as often as it is there. Languages with fewer than ``listed_words`` (62 at most) words that
    ``least_texts`` texts hold share one reference, compared by characters alone; null is one of them. Equally
    frequent words are taken by word. Other columns are not read. Above ``broadcast_languages`` languages,
    lists and references are joined by shuffles, with the same results.
    """
    if not 1 <= listed_words < len(_CODES):
        raise ValueError(f"listed_words must be 1 to {len(_CODES) - 1}")
    lists = common_words(docs, listed_words, least_texts).checkpoint()
    few = lists.count() <= broadcast_languages
    rows = measures(docs, F.broadcast(lists) if few else lists.hint("merge"), listed_words).checkpoint()

    def added(column: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)])

    reference = rows.groupBy(F.col("language").alias("of")).agg(
        added("classes", 2 + len(_CLASSES) + 1).alias("class_reference"),
        added("common", listed_words + 1).alias("common_reference"),
    )
    judged = rows.join(
        F.broadcast(reference) if few else reference.hint("merge"), F.col("language").eqNullSafe(F.col("of"))
    )
    same_size = F.slice("common_reference", 1, F.size("common"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    far = ((F.col("n_words") >= CLASS_WORDS) & (F.col("class_js") > class_distance)) | (
        (F.col("n_words") >= COMMON_WORDS) & (F.col("common_js") > common_distance)
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        jensen_shannon(F.col("classes"), F.col("class_reference")).alias("class_js"),
        jensen_shannon(F.col("common"), same_size).alias("common_js"),
    ).withColumn("kept", ~F.col("base_failed") & ~far)
