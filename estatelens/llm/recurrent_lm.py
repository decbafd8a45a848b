"""Whole-document log-likelihoods from a gated recurrent language model.

All training documents give the counts of their tokens. The most frequent words are symbols of their own to
the network, the others are read and predicted as one of some classes by how they end, and in their class by
their counts. All tokens of all training documents train the network, once: in rounds, each task trains the last
round's network on its part of the round's documents, and their weighted mean goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.gated_units import END, Shape, first_parameters, log_likelihoods, trained
from estatelens.llm.words import SPACED_BYTES, Words, mix, pieces, signed, text_bytes
from estatelens.session import shared_folder

#: The remainder of the id's CRC-32 by which rows are held out.
HELD_MODULUS, HELD_REMAINDER = 7, 2

#: The network: words it tells apart, words of a class, classes of rarer words, numbers in a state.
NETWORK_WORDS = 1024
CLASS_WORDS = 32
RARE_CLASSES = 64
WIDTH = 32

#: Training: one of so many documents (1: all), in so many rounds; lanes and steps of a window; Adam's first rate.
TRAIN_ONE_OF = 1
ROUNDS = 8
LANES = 512
WINDOW = 32
RATE = 0.04

#: Tokens of one task of a round, and tasks of a round; more tokens than both allow make longer tasks.
TASK_TOKENS = 262_144
MOST_TASKS = 4_096

#: Words whose counts every task gets; those of all others are met by a join.
LOOKUP_WORDS = 1 << 17

_HELD_WORDS = 2_000_000
_BLOCK_TOKENS = 1 << 20
_CHUNK = 1024
_SCORE_BYTES = 8 << 20

#: Leading bits of a hash by which known words are looked up.
_LEADING_BITS = 20

#: The end's place among the hashes of words.
_END_HASH = 0
_NO_CLASS = -1


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a row without an id is learned from."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % HELD_MODULUS
    return F.coalesce(remainder == HELD_REMAINDER, F.lit(False))


def endings(words: Words, classes: int) -> np.ndarray:
    """The class of each word as a rare one: by its last two bytes."""
    last = words.buffer[words.ends - 1].astype(np.uint64)
    other = np.where(words.ends - words.starts > 1, words.buffer[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(256) + other) % np.uint64(classes)).astype(np.int64)


def token_counts(docs: DataFrame, rare_classes: int) -> DataFrame:
    """``word, class, n`` of every token of ``docs``; a word is its 64-bit hash, the end is 0 with class -1.

    Tasks combine what they hold before they hand it on.
    """

    def combined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        word, kind, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        found, firsts = np.unique(word[order], return_index=True)
        return found, kind[order][firsts], np.add.reduceat(n[order], firsts) if len(found) else n

    def batch_of(part) -> pa.RecordBatch:
        word, kind, n = part
        return pa.RecordBatch.from_arrays(
            [signed(word), pa.array(kind.astype(np.int32)), pa.array(n)], ["word", "class", "n"]
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, ends = [], 0, 0
        for batch in batches:
            for piece in pieces(batch):
                ends += piece.num_rows
                words = Words(text_bytes(piece.column("text")), SPACED_BYTES, lower=True)
                found, firsts, n = np.unique(words.hashes(), return_index=True, return_counts=True)
                parts.append((found, endings(words, rare_classes)[firsts], n.astype(np.int64)))
                held += len(found)
                if held > _HELD_WORDS:
                    parts = [combined(parts)]
                    held = len(parts[0][0])
                    if held > _HELD_WORDS // 2:
                        yield batch_of(parts[0])
                        parts, held = [], 0
        if parts:
            yield batch_of(combined(parts))
        if ends:
            yield batch_of((np.array([_END_HASH], np.uint64), np.array([_NO_CLASS]), np.array([ends], np.int64)))

    each = docs.select("text").mapInArrow(emit, "word bigint, class int, n bigint")
    return each.groupBy("word").agg(F.max("class").alias("class"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """What tasks know of the counts: bounded by ``LOOKUP_WORDS`` and the number of classes.

    ``hashes`` are in order, with the ``counts`` and network ``symbols`` of their words (-1: none); ``scale`` is
    the log10 of what each rare class's counts are divided by.
    """

    tokens: int
    distinct: int
    ends: int
    shape: Shape
    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    symbol_counts: np.ndarray
    scale: np.ndarray

    @cached_property
    def _firsts(self) -> np.ndarray:
        """Of each value of a hash's leading bits: the place of the first known word with it or a higher one."""
        leading = (self.hashes >> np.uint64(64 - _LEADING_BITS)).astype(np.int64)
        sizes = np.bincount(leading, minlength=1 << _LEADING_BITS)
        return (np.cumsum(sizes) - sizes).astype(np.int32)

    @cached_property
    def _bounded(self) -> np.ndarray:
        """The hashes and the largest number, beyond which no search goes."""
        return np.append(self.hashes, np.uint64(2**64 - 1))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word among ``hashes``; -1 for others."""
        known = self._bounded
        at = self._firsts[(hashes >> np.uint64(64 - _LEADING_BITS)).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(known[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[known[at[behind]] < hashes[behind]]
        return np.where((known[at] == hashes) & (at < len(self.hashes)), at, -1)

    def read(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its hash, its place among the known ones, its symbol and its class as a rare one."""
        hashes, kinds = words.hashes(), endings(words, self.shape.rare)
        place = self.find(hashes)
        symbol = np.full(len(hashes), -1)
        symbol[place >= 0] = self.symbols[place[place >= 0]]
        return hashes, place, np.where(symbol >= 0, symbol, self.shape.words + kinds), kinds

    def stream(self, words: Words, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of whole texts with the end of each, one after another, and their lengths."""
        lengths = words.counts + 1
        out = np.full(int(lengths.sum()), END, np.int64)
        out[np.arange(len(words)) + words.of_text()] = symbols
        return out, lengths


def known_words(
    counts: DataFrame, network_words: int, class_words: int, rare_classes: int, width: int, lookup: int
) -> Vocabulary:
    """The vocabulary of ``token_counts``.

    The words that tasks get are those of a count from which on there are at most ``lookup``: a histogram says
    which, so no task or driver sorts the words. Counts of rare classes are sums over all words.
    """
    words = counts.where(F.col("class") >= 0)
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("class") < 0, F.col("n"))), F.lit(0))
    ).first()
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["level"]: r["count"] for r in words.groupBy(level.alias("level")).count().collect()}
    least, taken = None, 0
    for at in sorted(sizes, reverse=True):
        if taken + sizes[at] > lookup:
            break
        least, taken = at, taken + sizes[at]
    known = words.where(level >= least) if least is not None else words.limit(0)
    table = known.select("word", "class", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])
    hashes = table["word"].to_numpy(np.int64).view(np.uint64)
    n, kinds = table["n"].to_numpy(np.int64), table["class"].to_numpy(np.int64)
    own = min(network_words - 1, len(table))
    shape = Shape(own + 1, class_words, rare_classes, width)
    by_class = {r["class"]: r for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    total_n, total_v = (np.array([by_class[k][x] if k in by_class else 0 for k in range(rare_classes)]) for x in ("n", "v"))
    rare_n = total_n - np.bincount(kinds[:own], n[:own], rare_classes).astype(np.int64)
    rare_v = total_v - np.bincount(kinds[:own], minlength=rare_classes)
    order = np.argsort(hashes)
    symbols = np.where(np.arange(len(table)) < own, np.arange(len(table)) + 1, -1)
    return Vocabulary(
        int(totals[0]),
        int(totals[1]),
        int(totals[2]),
        shape,
        hashes[order],
        n[order],
        symbols[order],
        np.concatenate([[int(totals[2])], n[:own], rare_n]),
        np.log10(rare_n + rare_v + 1),
    )


def symbol_type(shape: Shape) -> str:
    """Of the numbers in a stream."""
    return "<u2" if shape.symbols <= 1 << 16 else "<i4"


def _streams(read: DataFrame, rounds: int) -> DataFrame:
    """``turn, stream``: the symbols of each document that trains, and its round."""
    return read.where(F.col("turn") < rounds).select("turn", "stream")


def _trained_round(streams: DataFrame, turn: int, tasks: int, shape: Shape, flat: np.ndarray, rate: float) -> np.ndarray:
    """The mean of the tasks' networks after one round, weighted by their tokens."""
    start = streams.sparkSession.sparkContext.broadcast(flat)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, block, held = start.value, 0, [], 0
        for batch in batches:
            for stream in batch.column("stream").to_pylist():
                block.append(np.frombuffer(stream, symbol_type(shape)))
                held += len(block[-1])
                if held >= _BLOCK_TOKENS:
                    own, seen = trained(shape, own, np.concatenate(block), LANES, WINDOW, rate), seen + held
                    block, held = [], 0
        if held:
            own, seen = trained(shape, own, np.concatenate(block), LANES, WINDOW, rate), seen + held
        if seen:
            chunks = [own[at : at + _CHUNK] for at in range(0, len(own), _CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(chunks)), pa.int32()),
                    pa.array([float(seen)] * len(chunks)),
                    pa.array(chunks, pa.list_(pa.float32())),
                ],
                ["chunk", "weight", "values"],
            )

    networks = streams.where(F.col("turn") == turn).coalesce(tasks).mapInArrow(
        train, "chunk int, weight double, values array<float>"
    )
    each = networks.select("chunk", "weight", F.posexplode("values").alias("place", "value"))
    mean = F.sum(F.col("value") * F.col("weight")) / F.sum("weight")
    rows = each.groupBy((F.col("chunk") * _CHUNK + F.col("place")).alias("place")).agg(mean.alias("value")).toArrow()
    start.unpersist()
    out = flat.copy()
    out[rows.column("place").to_numpy()] = rows.column("value").to_numpy()
    return out


def trained_network(
    read: DataFrame, vocabulary: Vocabulary, one_of: int = TRAIN_ONE_OF, rounds: int = ROUNDS, rate: float = RATE
) -> np.ndarray:
    """The network's parameters after all rounds over documents as ``_read`` has them: each is in one round.

    ``turn`` says in which; those whose turn is null or beyond the rounds do not train.
    """
    streams = _streams(read, rounds)
    expected = vocabulary.tokens / one_of / rounds
    tasks = int(np.clip(expected / TASK_TOKENS, 1, MOST_TASKS))
    flat = first_parameters(vocabulary.shape, vocabulary.symbol_counts)
    for turn in range(rounds):
        flat = _trained_round(streams, turn, tasks, vocabulary.shape, flat, rate * (1 - 0.7 * turn / rounds))
    return flat


_READ = (
    "row bigint, doc_id {}, held_out boolean, turn int, n_tokens bigint, n_known bigint, count_logs double, "
    "rare_logs double, words array<bigint>, times array<int>, stream binary"
)
_SCORED = "row bigint, doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, count_logs double, model_logs double"


def _lists(owner: np.ndarray, values: pa.Array, texts: int) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _binaries(values: np.ndarray, lengths: np.ndarray) -> pa.BinaryArray:
    """The bytes of ``values`` in runs of the given lengths."""
    offsets = (np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _read_piece(piece: pa.RecordBatch, known: Vocabulary) -> pa.RecordBatch:
    """What tasks can say of each document before there is a network, its symbols, and the words whose counts they do
    not have."""
    words = Words(text_bytes(piece.column("text")), SPACED_BYTES, lower=True)
    texts = piece.num_rows
    hashes, place, symbols, kinds = known.read(words)
    owner = words.of_text()
    rare, found = symbols >= known.shape.words, place >= 0
    log_count = np.zeros(len(words))
    log_count[found] = np.log10(known.counts[place[found]] + 1.0)
    stream, lengths = known.stream(words, symbols)
    within = np.where(rare, log_count - known.scale[kinds], 0.0)
    pair = np.lexsort((hashes[~found], owner[~found]))
    who, what = owner[~found][pair], hashes[~found][pair]
    opens = np.concatenate([[True], (who[1:] != who[:-1]) | (what[1:] != what[:-1])]) if len(who) else np.zeros(0, bool)
    firsts = np.flatnonzero(opens)
    times = np.diff(np.concatenate([firsts, [len(who)]])).astype(np.int32)
    known_tokens = np.bincount(owner[found], minlength=texts) + (known.ends > 0)
    return pa.RecordBatch.from_arrays(
        [
            piece.column("row"),
            piece.column("doc_id"),
            piece.column("held_out"),
            piece.column("turn"),
            pa.array(lengths.astype(np.int64)),
            pa.array(known_tokens.astype(np.int64)),
            pa.array(np.bincount(owner, log_count, texts) + np.log10(known.ends + 1.0)),
            pa.array(np.bincount(owner, within, texts)),
            _lists(who[firsts], signed(what[firsts]), texts),
            _lists(who[firsts], pa.array(times), texts),
            _binaries(stream.astype(symbol_type(known.shape)), lengths),
        ],
        ["row", "doc_id", "held_out", "turn", "n_tokens", "n_known", "count_logs", "rare_logs", "words", "times", "stream"],
    )


def _read(docs: DataFrame, shared) -> DataFrame:
    """Each row of ``row, doc_id, held_out, turn, text`` as ``_READ``: texts are cut into words once, for training
    and scoring. ``shared`` is the vocabulary as broadcast."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield _read_piece(piece, shared.value)

    return docs.mapInArrow(emit, _READ.format(docs.schema["doc_id"].dataType.simpleString()))


def _scored_piece(piece: pa.RecordBatch, shape: Shape, flat: np.ndarray) -> pa.RecordBatch:
    """The documents' log10 probabilities by the network, with those of rare words in their classes."""
    symbols = np.frombuffer(b"".join(piece.column("stream").to_pylist()), symbol_type(shape)).astype(np.int64)
    network = log_likelihoods(shape, flat, symbols, piece.column("n_tokens").to_numpy()) / np.log(10)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "count_logs"]
    return pa.RecordBatch.from_arrays(
        [*(piece.column(x) for x in names), pa.array(network + piece.column("rare_logs").to_numpy())],
        [*names, "model_logs"],
    )


def score_documents(
    docs: DataFrame,
    network_words: int = NETWORK_WORDS,
    class_words: int = CLASS_WORDS,
    rare_classes: int = RARE_CLASSES,
    width: int = WIDTH,
    lookup: int = LOOKUP_WORDS,
    one_of: int = TRAIN_ONE_OF,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs``.

    Tokens are the words between white space, A-Z in lower case, and one end. ``base_score`` is the log10
    probability of the tokens by their counts plus one; ``score`` is the model's. The network's state goes from a
    document's first token to its last. A rare word's probability is that of its class, by the network, times
    its count plus one over the class's; all words that training has not shown share one place in their class.

    A null or empty text is one end; a row with a null id is learned from; equal rows give equal rows, and there
    are no ties to break; without rows to learn from, all tokens are unknown. Columns other than ``doc_id`` and
    ``text`` are not read, whatever their names. Words are known by hashes of 64 bits.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    given = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    counts = token_counts(given.where(~F.col("held_out")), rare_classes).checkpoint()
    vocabulary = known_words(counts, network_words, class_words, rare_classes, width, lookup)
    # In which round a document trains, a hash of id and text says; with one_of, those beyond the rounds do not train.
    turn = F.when(~F.col("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_of * rounds)).cast("int"))
    numbered = given.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", turn.alias("turn"), "text")
    # Written, so that a row keeps its number whatever is computed again.
    read = _read(numbered, spark.sparkContext.broadcast(vocabulary)).checkpoint()
    network = spark.sparkContext.broadcast(trained_network(read, vocabulary, one_of, rounds))
    shape = vocabulary.shape

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "stream", _SCORE_BYTES):
                yield _scored_piece(piece, shape, network.value)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = read.drop("turn", "words", "times").mapInArrow(score, _SCORED.format(kind)).checkpoint()
    left = read.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.*")
    met = left.join(counts.select(F.col("word").alias("words"), "n"), "words")
    more = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"), F.sum("times").alias("known")
    )
    logs, known = (F.coalesce(c, F.lit(0)) for c in ("logs", "known"))
    floor = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return scored.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("count_logs") + logs - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model_logs") + logs).alias("score"),
    )
