"""Toxicity by class-conditional Kneser-Ney models of characters.

Two models, of toxic and of ordinary text, predict each byte from the four before it. They share all
backoff counts: the continuation counts of shorter contexts are pooled over both classes, so an
expression that one class has never shown costs both the same but for the weight of backing off. Two more models, of the
texts that words are in, tell whole words apart. The length-normalised difference of the log-likelihoods, over
the text and over its words, and the evidence of its words are calibrated on labelled rows that were not counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.logistic import SAMPLE_ROWS, sample_and_fit
from estatelens.llm.words import ALNUM_BYTES, PIECE_BYTES, Words, held_out, mix, pieces, text_bytes

#: Bytes of a gram: one predicted, the others its context.
ORDER = 5

#: What is taken off each count of a class; a gram it has shown no more often is left to the shared counts.
DISCOUNT = 2.0
#: What is taken off each continuation count.
SHARED_DISCOUNT = 0.75

#: Score of a document from which it is called toxic.
THRESHOLD = 0.3

#: Grams of one table that tasks get, besides as many contexts at most. A corpus of more grams is dealt into
#: several tables, of which a task holds one at a time.
TABLE_GRAMS = 1 << 21

#: Bytes of text that are looked up at once where there are several tables, as each is read again for them.
_TABLES_BYTES = 4 << 20

#: Grams combined in one task before they are handed on.
_HELD_GRAMS = 4_000_000

_CHARACTERS = ["mean_ratio", "top_ratio", "toxic_share"]
_WORDS = ["word_best", "word_sum", "word_strong", "word_sure", "word_number"]
_FEATURES = _CHARACTERS + _WORDS

#: Toxic texts that have to show a word before it is evidence, and its least log ratio.
EVIDENCE_TEXTS = 2
EVIDENCE_RATIO = 1.0
#: Log ratios from which evidence counts as strong, and as sure.
_STRONG, _SURE = 2.0, 3.0

#: Bits by which tasks see that a word is no evidence: of fixed size; the join decides on the others.
_SIEVE_BITS = 1 << 24
_SIEVE_PART = 1 << 15

#: Parts of the rows of one word in the join with the evidence.
_SALTS = 16

#: A word's log ratio from which it counts as toxic: twenty times likelier.
_WORD_RATIO = 3.0


class _Line:
    """Words of some texts, joined by single spaces: bytes, the end of each word, the text of each word."""

    def __init__(self, texts: list[bytes]):
        found = Words([b" " + t for t in texts], ALNUM_BYTES, lower=True)
        inside = np.zeros(len(found.buffer) + 1, bool)
        inside[:-1] = ALNUM_BYTES[found.buffer]
        # One separator before each word, as a space, stays.
        inside[found.starts - 1] = True
        kept = np.flatnonzero(inside[:-1])
        self.bytes = np.where(ALNUM_BYTES[found.buffer[kept]], found.buffer[kept], 0x20).astype(np.uint8)
        self.word_of_byte = np.cumsum(self.bytes == 0x20) - 1
        self.found = found
        self.text_of_word = found.of_text()

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Each byte with the four before it in its text, as an integer, and its place; zeros stand before a text."""
        grams = np.zeros(len(self.bytes), np.uint64)
        text = self.text_of_word[self.word_of_byte] if len(self.bytes) else np.zeros(0, np.int64)
        for back in range(ORDER - 1, -1, -1):
            part = np.zeros(len(self.bytes), np.uint64)
            if back < len(self.bytes):
                part[back:] = np.where(text[back:] == text[: len(text) - back], self.bytes[: len(self.bytes) - back], 0)
            grams = grams << np.uint64(8) | part
        return grams, text


def gram_counts(rows: DataFrame) -> DataFrame:
    """``gram, n_toxic, n_plain`` over ``text, toxic``; combined in each task, then summed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            toxic = (grams & np.uint64(1)).astype(bool)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array((grams >> np.uint64(1)).astype(np.int64)),
                    pa.array(np.where(toxic, counts, 0)),
                    pa.array(np.where(toxic, 0, counts)),
                ],
                ["gram", "n_toxic", "n_plain"],
            )

        for batch in batches:
            for piece in pieces(batch):
                grams, text = _Line(text_bytes(piece.column("text"))).grams()
                toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.uint64)
                held.append(grams << np.uint64(1) | toxic[text])
                size += len(grams)
                if size > _HELD_GRAMS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counted = rows.select("text", "toxic").mapInArrow(emit, "gram bigint, n_toxic bigint, n_plain bigint")
    return counted.groupBy("gram").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_plain").alias("n_plain"))


def _shared_backoff(grams: DataFrame, order: int = ORDER - 1) -> DataFrame:
    """``tail, shared``: the pooled probability of each ``order``-byte gram's last byte, from continuation counts."""
    levels = []
    seen = grams.select(F.col("gram").alias("tail"))
    for n in range(order, 0, -1):
        mask = (1 << 8 * n) - 1
        # In how many longer grams this one is the end.
        seen = seen.select(F.col("tail").bitwiseAND(F.lit(mask)).alias("tail")).groupBy("tail").agg(F.count("*").alias("ends"))
        levels.append(seen)
    shared = None
    for n, level in zip(range(1, order + 1), reversed(levels)):
        head = F.shiftright("tail", 8)
        totals = level.groupBy(head.alias("head")).agg(F.sum("ends").alias("total"), F.count("*").alias("kinds"))
        here = level.withColumn("head", head).join(totals, "head")
        if shared is None:
            lower, lower_value = here, F.lit(1 / 256)
        else:
            below = shared.select(F.col("tail").alias("shorter"), F.col("shared").alias("below"))
            here = here.withColumn("shorter", F.col("tail").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)))
            lower, lower_value = here.join(below, "shorter"), F.col("below")
        shared = lower.select(
            "tail",
            ((F.col("ends") - SHARED_DISCOUNT + SHARED_DISCOUNT * F.col("kinds") * lower_value) / F.col("total")).alias("shared"),
        )
    return shared


def log_ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``gram, ratio`` of seen grams; ``context, ratio`` for grams unseen after a seen context."""
    context = F.shiftright("gram", 8)
    contexts = grams.groupBy(context.alias("context")).agg(
        *[F.sum(f"n_{c}").alias(f"all_{c}") for c in ("toxic", "plain")],
        *[F.sum(F.least(F.col(f"n_{c}"), F.lit(DISCOUNT))).alias(f"freed_{c}") for c in ("toxic", "plain")],
    )

    def backed_off(c: str) -> Column:
        """The weight of the shared counts."""
        return F.when(F.col(f"all_{c}") > 0, F.col(f"freed_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    def probability(c: str) -> Column:
        own = F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"all_{c}"), F.lit(1))
        return own + backed_off(c) * F.col("shared")

    tail = F.col("gram").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1))
    seen = grams.withColumn("context", context).join(contexts, "context")
    seen = seen.withColumn("tail", tail).join(_shared_backoff(grams), "tail")
    ratio = F.ln(probability("toxic") / probability("plain"))
    unseen = contexts.select("context", F.ln(backed_off("toxic") / backed_off("plain")).alias("ratio"))
    return seen.select("gram", ratio.alias("ratio")), unseen


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, n_toxic, n_plain``: in how many of ``text, toxic`` each word is; a word is its 64-bit hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        size = 0

        def flush() -> pa.RecordBatch:
            found = [np.unique(np.concatenate(x or [np.zeros(0, np.uint64)]), return_counts=True) for x in held]
            words = np.concatenate([found[0][0], found[1][0]]).view(np.int64)
            counts = [np.concatenate([f[1] * (i == k) for i, f in enumerate(found)]) for k in (1, 0)]
            return pa.RecordBatch.from_arrays([pa.array(words), *map(pa.array, counts)], ["word", "n_toxic", "n_plain"])

        for batch in batches:
            for piece in pieces(batch):
                words, text = _words_of_texts(Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True))
                toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(bool)[text]
                held[0].append(words[~toxic])
                held[1].append(words[toxic])
                size += len(words)
                if size > _HELD_GRAMS:
                    yield flush()
                    held, size = ([], []), 0
        if size:
            yield flush()

    counted = rows.select("text", "toxic").mapInArrow(emit, "word bigint, n_toxic bigint, n_plain bigint")
    return counted.groupBy("word").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_plain").alias("n_plain"))


def _words_of_texts(found: Words, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each text, as hashes, and their texts; of those that ``wanted`` bits do not rule out."""
    words, text = found.hashes(), found.of_text()
    if wanted is not None:
        place = (words % np.uint64(_SIEVE_BITS)).astype(np.int64)
        kept = np.flatnonzero(wanted[place >> 3] >> (place & 7).astype(np.uint8) & 1)
        words, text = words[kept], text[kept]
    order = np.lexsort((words, text))
    words, text = words[order], text[order]
    first = np.ones(len(words), bool)
    first[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    return words[first], text[first]


def word_evidence(counts: DataFrame) -> DataFrame:
    """``word, ratio`` of the words that speak for toxic text.

    Each class gives up a discount of its counts, estimated from how many words it has shown once and twice, to the
    shared counts, so a word that few texts show has nearly the ratio that any word has.
    """

    def once_and_twice(c: str) -> list[Column]:
        return [F.sum(c), *[F.count_if(F.col(c) == n) for n in (1, 2)], F.count_if(F.col(c) > 0)]

    sums = counts.agg(*once_and_twice("n_toxic"), *once_and_twice("n_plain")).first()

    def probability(c: str, total, once, twice, kinds) -> Column:
        discount = once / (once + 2 * twice) if once else 0.5
        shared = (F.col("n_toxic") + F.col("n_plain")) / float((sums[0] or 0) + (sums[4] or 0) or 1)
        own = F.greatest(F.col(c) - discount, F.lit(0.0)) / float(total or 1)
        return own + discount * kinds / float(total or 1) * shared

    ratio = F.ln(probability("n_toxic", *sums[:4]) / probability("n_plain", *sums[4:]))
    # Without texts of both classes, no word tells them apart.
    known = F.lit(bool(sums[0] and sums[4]))
    found = counts.where(known & (F.col("n_toxic") >= EVIDENCE_TEXTS)).select("word", ratio.alias("ratio"))
    return found.where(F.col("ratio") > EVIDENCE_RATIO)


def _sieve(evidence: DataFrame) -> np.ndarray:
    """Bits of the evidence's words: ``_SIEVE_BITS`` of them, however many words there are."""
    place = F.pmod("word", F.lit(_SIEVE_BITS))
    part = F.floor(place / _SIEVE_PART).cast("int")
    rows = evidence.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(place % _SIEVE_PART).alias("bits")).collect()
    bits = np.zeros((_SIEVE_BITS // _SIEVE_PART, _SIEVE_PART // 8), np.uint8)
    for r in rows:
        bits[r["part"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits.ravel()


def _with_words(features: DataFrame, evidence: DataFrame) -> DataFrame:
    """The features of texts with those of their words: by a join of the words that may be evidence."""
    salted = evidence.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    maybe = features.select("row", F.explode("words").alias("word"))
    maybe = maybe.withColumn("salt", F.pmod(F.hash("row"), F.lit(_SALTS)))
    found = maybe.join(salted, ["word", "salt"]).groupBy("row").agg(
        F.max("ratio").alias("best"),
        F.sum("ratio").alias("sum"),
        F.count_if(F.col("ratio") > _STRONG).alias("strong"),
        F.count_if(F.col("ratio") > _SURE).alias("sure"),
    )
    best, total, strong, sure = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("best", "sum", "strong", "sure"))
    length = F.sqrt(F.greatest("n_words", F.lit(1)))
    return features.join(found, "row", "left").select(
        "doc_id",
        *_CHARACTERS,
        best.alias("word_best"),
        (total / length).alias("word_sum"),
        (strong / length).alias("word_strong"),
        sure.alias("word_sure"),
        F.log1p("n_words").alias("word_number"),
    )


class RatioTable:
    """Log ratios by exact key. ``mix`` maps keys one to one, so equal mixed keys are equal keys."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray):
        mixed = mix(keys)
        order = np.argsort(mixed)
        self.mixed, self.ratios = mixed[order], ratios[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        bounds = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.mixed, bounds), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ratio of each key, NaN where it has none."""
        out = np.full(len(keys), np.nan, np.float32)
        mixed = mix(keys)
        slots = (mixed >> self.shift).astype(np.int64)
        at, ends = self.first[slots], self.first[slots + 1]
        left = np.flatnonzero(at < ends)
        while len(left):
            same = self.mixed[at[left]] == mixed[left]
            out[left[same]] = self.ratios[at[left[same]]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < ends[left]]
        return out


def _deal(contexts: np.ndarray, tables: int) -> np.ndarray:
    """The table of each context, and of all grams after it."""
    return (mix(contexts ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(tables)).astype(np.int32)


def ratio_tables(grams: DataFrame, table_grams: int = TABLE_GRAMS) -> list[Broadcast]:
    """Tables of seen grams and of their contexts, each broadcast, as many as the grams of the corpus need.

    One table at a time reaches the driver.
    """
    tables = max(1, -(-grams.count() // table_grams))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            seen = batch.column("seen").to_numpy(zero_copy_only=False)
            dealt = _deal(np.where(seen, keys >> np.uint64(8), keys), tables)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt), *[batch.column(x) for x in ("seen", "key", "ratio")]], ["dealt", "seen", "key", "ratio"]
            )

    seen, unseen = log_ratios(grams)
    rows = seen.select(F.lit(True).alias("seen"), F.col("gram").alias("key"), F.col("ratio").cast("float").alias("ratio")).unionByName(
        unseen.select(F.lit(False).alias("seen"), F.col("context").alias("key"), F.col("ratio").cast("float").alias("ratio"))
    )
    rows = rows.mapInArrow(emit, "dealt int, seen boolean, key bigint, ratio float")
    if tables > 1:
        rows = rows.checkpoint()
    out = []
    for i in range(tables):
        part = rows.where(F.col("dealt") == i).select("seen", "key", "ratio").toArrow()
        kind = part.column("seen").to_numpy()
        keys, ratios = part.column("key").to_numpy().view(np.uint64), part.column("ratio").to_numpy()
        pair = RatioTable(keys[kind], ratios[kind]), RatioTable(keys[~kind], ratios[~kind])
        out.append(grams.sparkSession.sparkContext.broadcast(pair))
    return out


def gram_ratios(grams: np.ndarray, tables: list[Broadcast]) -> np.ndarray:
    """The log ratio of each gram; that of its context where the gram was not seen, 0 where neither was."""

    def look_up(keys: np.ndarray, pair: tuple[RatioTable, RatioTable]) -> np.ndarray:
        seen, unseen = pair
        found = seen.find(keys)
        missing = np.flatnonzero(np.isnan(found))
        found[missing] = np.nan_to_num(unseen.find(keys[missing] >> np.uint64(8)))
        return found

    if len(tables) == 1:
        return look_up(grams, tables[0].value)
    keys, places = np.unique(grams, return_inverse=True)
    dealt = _deal(keys >> np.uint64(8), len(tables))
    ratios = np.zeros(len(keys), np.float32)
    for i, table in enumerate(tables):
        here = np.flatnonzero(dealt == i)
        if len(here):
            ratios[here] = look_up(keys[here], table.value)
            # Read again for the next texts, so that one table is held at a time.
            if getattr(table, "_path", None):
                vars(table).pop("_value", None)
    return ratios[places]


def score_features(docs: DataFrame, tables: list[Broadcast], sieve: Broadcast) -> DataFrame:
    """``row, doc_id``, the length-normalised log ratios of each whole text (zeros without words), ``n_words``, and
    the ``words`` that may be evidence."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, size=PIECE_BYTES if len(tables) == 1 else _TABLES_BYTES):
                line = _Line(text_bytes(piece.column("text")))
                grams, text = line.grams()
                ratio = gram_ratios(grams, tables)
                n = piece.num_rows
                words = line.found.counts
                size = np.maximum(np.bincount(text, minlength=n), 1)
                mean = np.bincount(text, ratio, minlength=n) / size
                of_word = np.bincount(line.word_of_byte, ratio, minlength=len(line.found))
                toxic = np.bincount(line.text_of_word, of_word >= _WORD_RATIO, minlength=n) / np.maximum(words, 1)
                top = np.zeros(n)
                full = np.flatnonzero(words)
                if len(full):
                    top[full] = np.maximum.reduceat(of_word, line.found.first[full])
                maybe, owner = _words_of_texts(line.found, sieve.value)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(maybe.view(np.int64)))
                columns = [piece.column("row"), piece.column("doc_id"), *map(pa.array, (mean, top, toxic, words)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", *_CHARACTERS, "n_words", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, {', '.join(f'{x} double' for x in _CHARACTERS)}, n_words bigint, words array<bigint>"
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(emit, schema)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    table_grams: int = TABLE_GRAMS,
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``, with the features of the score.

    Rows with a remainder (crc32 of the id, modulo 4) of 0 or 1 and a label are counted, those of 3
    calibrate (a sample of ``sample_rows`` of them), those of 2 are never learned from. Ids with several
    labels count as the highest. Null ids have no label. A null or empty text scores like a text without
    any evidence; equal rows score alike, and columns other than ``doc_id`` and ``text`` are not read. Every gram keeps its own log ratio; ``table_grams`` only says how many one table holds, and
    scores are the same for any number of tables. Without labels of both classes the score is the share of toxic ones, or a half.
    """
    marks = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    texts = docs.select("doc_id", "text")
    # Labels grow with the texts, so they are never broadcast, whatever their size.
    counted = texts.where(remainder < 2).join(marks.hint("merge"), "doc_id")
    grams = gram_counts(counted).checkpoint()
    evidence = word_evidence(word_counts(counted).checkpoint()).checkpoint()
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(evidence))
    # Written, so that a row keeps its number whatever is computed again.
    features = _with_words(score_features(texts, ratio_tables(grams, table_grams), sieve).checkpoint(), evidence)
    calibrate = features.where(remainder == 3).join(marks.hint("merge"), "doc_id")
    model = sample_and_fit(calibrate, _FEATURES, "toxic", sample_rows)
    score = model.column([F.col(x) for x in _FEATURES])
    return features.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        *_FEATURES,
    )
