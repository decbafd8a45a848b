"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the byte n-grams (n from 1 to 4) that two texts share. A sample of
texts per language are landmarks; Nystroem features against them are regressed one language
against the rest. The kernel is linear in the presence of n-grams, so the landmarks' weights add up to
one weight per n-gram and language, and a batch is scored by the product of its presence matrix with these.
N-grams are told apart exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.words import held_out, mix, text_bytes

GRAM_BYTES = (1, 2, 3, 4)

#: Labelled texts to fit on and landmarks among them, over all languages.
SAMPLE_TEXTS = 2_400
LANDMARKS = 600
RIDGE = 1e-4

#: N-grams of one landmark; texts of some 100 KB have no more.
LANDMARK_GRAMS = 1 << 16

#: Rows of the table of languages that are broadcast; there are some seven thousand languages.
BROADCAST_LANGUAGES = 10_000

#: Rows scored at once.
_BATCH = 128

#: N-grams whose weights are looked up, or made, at once.
_BLOCK = 1 << 15

#: Partitions of the sample.
_SAMPLE_PARTS = 32

UNKNOWN = "und"

#: ASCII letters and all bytes of other characters stay, the rest is space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def gram_ids(text: bytes) -> np.ndarray:
    """The distinct n-grams of a text, sorted. Folded bytes are never 0, so the bytes of an n-gram are its id."""
    raw = np.frombuffer(text, np.uint8)
    step = 1 << 19
    found = np.zeros(0, np.uint32)
    for at in range(0, len(raw), step):
        part = _FOLD[raw[at : at + step + max(GRAM_BYTES) - 1]]
        # Runs of spaces are one.
        part = part[np.concatenate([[True], (part[1:] != 0x20) | (part[:-1] != 0x20)])].astype(np.uint32)
        gram = np.zeros(len(part), np.uint32)
        grams = [found]
        for n in range(1, max(GRAM_BYTES) + 1):
            size = len(part) - n + 1
            if size <= 0:
                break
            gram = gram[:size] << np.uint32(8) | part[n - 1 :]
            if n in GRAM_BYTES:
                grams.append(gram)
        found = np.unique(np.concatenate(grams))
    return found


def _norm(size: int) -> float:
    return max(1.0, float(np.sqrt(size)))


class Landmarks:
    """The n-grams of some texts, and which of the texts hold each: ``owners[first[i]:first[i + 1]]``."""

    def __init__(self, ids: list[np.ndarray]):
        joined = np.concatenate([np.zeros(0, np.uint32), *ids])
        owners = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
        order = np.argsort(joined, kind="stable")
        self.owners = owners[order]
        self.vocabulary, first = np.unique(joined[order], return_index=True)
        self.first = np.append(first, len(joined))
        self.norms = np.array([_norm(len(x)) for x in ids])

    def owned(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts that hold each of the n-grams, one after another, and how many each n-gram has."""
        n = self.first[places + 1] - self.first[places]
        return self.owners[np.repeat(self.first[places] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n

    def kernel(self, ids: np.ndarray) -> np.ndarray:
        """Shared n-grams over the geometric mean of both counts, for each landmark."""
        shared = np.zeros(len(self.norms))
        places = known_places(self.vocabulary, ids)
        for at in range(0, len(places), _BLOCK):
            shared += np.bincount(self.owned(places[at : at + _BLOCK])[0], minlength=len(shared))
        return shared / _norm(len(ids)) / self.norms

    def weights(self, alpha: np.ndarray) -> np.ndarray:
        """The weight of each n-gram and language, of the landmarks' weights."""
        scaled = alpha / self.norms[:, None]
        out = np.zeros((len(self.vocabulary), alpha.shape[1]), np.float32)
        for at in range(0, len(out), _BLOCK):
            owners, n = self.owned(np.arange(at, min(at + _BLOCK, len(out))))
            rows = np.repeat(np.arange(len(n)), n)
            for k in range(alpha.shape[1]):
                out[at : at + len(n), k] = np.bincount(rows, scaled[owners, k], minlength=len(n))
        return out


def known_places(vocabulary: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where the ids that the vocabulary has stand in it."""
    if not len(vocabulary):
        return np.zeros(0, np.int64)
    places = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
    return places[vocabulary[places] == ids]


def regressions(vocabulary: np.ndarray, weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """The regression of each language for whole texts: the presence matrix of the batch times the weights.

    The matrix has a column for each n-gram of the vocabulary that is in the batch, and is made in blocks of these.
    """
    ids = [gram_ids(t) for t in texts]
    places = [known_places(vocabulary, x) for x in ids]
    owners = np.repeat(np.arange(len(texts)), [len(x) for x in places])
    joined = np.concatenate([np.zeros(0, np.int64), *places])
    present = np.zeros(len(vocabulary), bool)
    present[joined] = True
    columns = np.flatnonzero(present)
    column_of = np.cumsum(present) - 1
    at = column_of[joined] if len(joined) else joined
    order = np.argsort(at // _BLOCK, kind="stable")
    ends = np.searchsorted(at[order] // _BLOCK, np.arange(-(-len(columns) // _BLOCK) + 1))
    found = np.zeros((len(texts), weights.shape[1]), np.float32)
    for block, (low, high) in enumerate(zip(ends, ends[1:])):
        own = columns[block * _BLOCK : (block + 1) * _BLOCK]
        matrix = np.zeros((len(texts), len(own)), np.float32)
        matrix[owners[order[low:high]], at[order[low:high]] - block * _BLOCK] = 1
        found += matrix @ weights[own]
    return found / np.array([_norm(len(x)) for x in ids])[:, None]


def chosen_landmarks(langs: list[str], landmarks: int) -> list[int]:
    """The first rows of every language, an equal number of each."""
    places: dict[str, list[int]] = {name: [] for name in sorted(set(langs))}
    for i, name in enumerate(langs):
        places[name].append(i)
    share = max(1, landmarks // max(1, len(places)))
    return [i for found in places.values() for i in found[:share]]


def fit_languages(across: np.ndarray, langs: list[str], chosen: list[int], ridge: float = RIDGE):
    """``(languages, weight of each landmark and language)`` by ridge regression on the landmarks' kernel.

    ``across`` is the kernel of every row with the landmarks, which are the ``chosen`` rows.
    """
    names = sorted(set(langs))
    wanted = np.array([[1.0 if x == name else -1.0 for name in names] for x in langs])
    # Every language weighs the same.
    of_name = Counter(langs)
    weight = np.array([len(langs) / len(names) / of_name[x] for x in langs])
    among = across[chosen]
    normal = (across * weight[:, None]).T @ across + ridge * len(langs) * among + 1e-6 * np.eye(len(chosen))
    return names, np.linalg.solve(normal, (across * weight[:, None]).T @ wanted)


def _sample(docs: DataFrame, sample_texts: int) -> DataFrame:
    """``draw, lang, key, text`` of at most ``sample_texts`` labelled rows, as many of each language, at least one.

    A language's rows are those with the smallest hashes of id and text, whether they have ids or not. Rows with
    hashes far beyond the wanted number are passed over where they lie, so the ranking sees a bounded number.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    total = counts.agg(F.count("*")).first()[0]
    each = max(1, sample_texts // max(1, total))
    # One row per language; a column with more values than there are languages is joined by shuffle.
    counts = F.broadcast(counts) if total <= BROADCAST_LANGUAGES else counts
    near = F.col("draw") / F.lit(2.0**64) + 0.5 < F.lit(2.0 * each + 20) / F.col("n")
    # Where copies take the places below, a language keeps the row with the smallest hash.
    least = known.groupBy("lang").agg(F.min("draw").alias("least"))
    least = F.broadcast(least) if total <= BROADCAST_LANGUAGES else least
    drawn = known.join(counts, "lang").join(least, "lang").where(near | (F.col("draw") == F.col("least")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", F.xxhash64("text")))
    drawn = drawn.select("draw", "lang", F.xxhash64("text").alias("key"), "text", place.alias("place"))
    return drawn.where(F.col("place") <= each).drop("place")


def sketched(ids: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of the n-grams, those with the smallest hashes, sorted."""
    if len(ids) <= most:
        return ids
    return np.sort(ids[np.argpartition(mix(ids), most)[:most]])


def _fit(docs: DataFrame, sample_texts: int, landmarks: int, landmark_grams: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the landmarks' n-grams, and the weight of each n-gram and language.

    Only the landmarks' n-grams reach the driver, at most ``landmark_grams`` of each; the kernel of the sample is made
    in tasks.
    """

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sketched(gram_ids(t), landmark_grams).tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, pa.large_binary()).cast(pa.binary())], ["row", "ids"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.kernel(gram_ids(t)).tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, pa.binary())], ["row", "kernel"])

    spark = docs.sparkSession
    # Rows are numbered in the sample's order; it has a bounded number of rows.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("draw", "lang", "key")) - 1
    sample = _sample(docs, sample_texts).withColumn("row", place).repartition(_SAMPLE_PARTS, "row").persist()
    try:
        langs = [r["lang"] for r in sample.select("row", "lang").orderBy("row").collect()]
        if not langs:
            return [], np.zeros(0, np.uint32), np.zeros((0, 0), np.float32)
        chosen = chosen_landmarks(langs, landmarks)
        wanted = F.broadcast(spark.createDataFrame([(i,) for i in chosen], "row int"))
        found = sample.join(wanted, "row").select("row", "text").mapInArrow(ids, "row int, ids binary").collect()
        of_row = {r["row"]: np.frombuffer(r["ids"], np.uint32) for r in found}
        marks = Landmarks([of_row[i] for i in chosen])
        shared = spark.sparkContext.broadcast(marks)
        rows = sample.select("row", "text").mapInArrow(kernel, "row int, kernel binary").orderBy("row").collect()
    finally:
        sample.unpersist()
    names, alpha = fit_languages(np.stack([np.frombuffer(r["kernel"]) for r in rows]), langs, chosen)
    return names, marks.vocabulary, marks.weights(alpha)


def identify_language(
    docs: DataFrame,
    sample_texts: int = SAMPLE_TEXTS,
    landmarks: int = LANDMARKS,
    landmark_grams: int = LANDMARK_GRAMS,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` (``doc_id, text, lang``).

    Fits on at most ``sample_texts`` rows with a language that are not held out, as many of each language and at least
    one; a landmark of more than ``landmark_grams`` n-grams is known by those with the smallest hashes. A null id is
    not held out; equal rows get equal answers, languages with equal regressions go by name, and other columns
    are not read, whatever their names.
    ``score`` is the share of the best language in a softmax of the regressions. A text that is null or
    has no letter is ``und`` with score 0, and so is every text where nothing could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_fit(docs, sample_texts, landmarks, landmark_grams))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vocabulary, weights = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                rows = batch.slice(start, _BATCH)
                texts = text_bytes(rows.column("text"))
                known = [bool(names) and has_letter(t.decode()) for t in texts]
                pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if any(known):
                    found = regressions(vocabulary, weights, texts)
                    odds = np.exp(4 * (found - found.max(1, keepdims=True)))
                    best = found.argmax(1)
                    pred = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]
                    score = np.where(known, odds.max(1) / odds.sum(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(emit, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
