"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are counts of its characters and words, and those of the lines
before and after it; a 2 x 2 table scores neighbouring labels. Forward and backward sums give each line's
marginal, and marginals weighted by length make the quality of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.logistic import Logistic, fit_logistic
from estatelens.llm.sampling import hash_sample
from estatelens.llm.words import SPACED_BYTES, Words, held_out, packed, pieces, text_bytes, unpacked

THRESHOLD = 0.7

#: Labelled documents to fit on, and the lines and characters such a document may have at most (longer ones
#: are not drawn). Together they bound what the driver holds; scores read every text whole.
SAMPLE_DOCUMENTS = 4_000
SAMPLE_LINES = 200
SAMPLE_CHARACTERS = 60_000
ROUNDS = 60
RIDGE = 1e-4

_OWN = 13
_WIDTH = 3 * _OWN + 1


def _table(text: bytes) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[list(text)] = 1
    return table


_LOWER = _table(bytes(range(0x61, 0x7B)))
_UPPER = _table(bytes(range(0x41, 0x5B)))
_DIGIT = _table(b"0123456789")
_SYMBOL = _table(b"#*$%&|<>")
_MARK = _table(b"!?")
_STOP = _table(b".,;:")
_FAR = _table(bytes(range(0x80, 0x100)))


class Lines:
    """The lines of some texts: features, lengths in bytes, and the range of each text's lines."""

    def __init__(self, texts: list[bytes]):
        self.count = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        joined = b"\n".join(texts)
        buffer = np.frombuffer(joined + b"\n", np.uint8)
        ends = np.flatnonzero(buffer == 0x0A)
        starts = np.concatenate([[0], ends[:-1] + 1])
        self.size = (ends - starts).astype(np.float64)
        total = np.maximum(self.size, 1)

        def share(table: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum(table[buffer])])
            return (sums[ends] - sums[starts]) / total

        words = Words([joined], SPACED_BYTES, lower=True)
        first = np.searchsorted(words.starts, starts)
        last = np.searchsorted(words.starts, ends)
        n_words = (last - first).astype(np.float64)
        hashes = words.hashes()
        line_of = np.searchsorted(ends, words.starts)
        again = np.zeros(len(words) + 1)
        if len(words) > 1:
            again[1:-1] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
        repeats = np.concatenate([[0.0], np.cumsum(again[:-1])]) if len(words) else np.zeros(1)
        order = np.lexsort((hashes, line_of)) if len(words) else np.zeros(0, np.int64)
        fresh = np.ones(len(words), bool)
        if len(words) > 1:
            fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
        distinct = np.bincount(line_of[order], fresh, minlength=len(ends)) if len(words) else np.zeros(len(ends))
        # The line's words as one number, to find lines that repeat in their text.
        keys = np.zeros(len(ends), np.uint64)
        if len(words):
            np.add.at(keys, line_of, hashes * (np.arange(len(words), dtype=np.uint64) - first[line_of].astype(np.uint64) + np.uint64(1)))
        text_of = np.repeat(np.arange(len(texts)), self.count)
        _, place, copies = np.unique(
            np.stack([text_of.astype(np.uint64), keys], 1), axis=0, return_inverse=True, return_counts=True
        )
        repeated = (copies[place.ravel()] > 1) & (n_words > 0)
        per_word = np.maximum(n_words, 1)
        own = np.column_stack(
            [
                share(_LOWER),
                share(_UPPER),
                share(_DIGIT),
                share(_SYMBOL) * 5,
                share(_MARK) * 5,
                share(_STOP) * 5,
                share(_FAR),
                np.log1p(self.size) / 5,
                np.log1p(n_words) / 4,
                np.minimum(self.size / per_word, 30) / 10,
                distinct / per_word,
                (repeats[last] - repeats[first]) / per_word * 2,
                repeated.astype(np.float64),
            ]
        )
        edge = np.zeros((1, _OWN))
        before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
        before[self.first[:-1]] = 0
        after[self.first[1:] - 1] = 0
        self.features = np.hstack([own, before, after, np.ones((len(own), 1))])


#: Bytes of texts whose lines are described at once.
_PIECE_BYTES = 1 << 19


def _text_pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece, size = [], 0
    for text in texts:
        if piece and size + len(text) > _PIECE_BYTES:
            yield piece
            piece, size = [], 0
        piece.append(text)
        size += len(text)
    if piece:
        yield piece


@dataclass(frozen=True)
class Chain:
    """Line weights (one per feature, for good against bad) and scores of neighbouring labels."""

    weights: np.ndarray
    moves: np.ndarray


def marginals(chain: Chain, features: np.ndarray, count: np.ndarray, first: np.ndarray):
    """``(marginal of good per line, expected neighbouring labels, log of the sum over labelings)``.

    All texts take a step together; texts are sorted by length, so a step holds those that still go on.
    """
    half = features @ chain.weights / 2
    local = np.stack([-half, half], 1)
    order = np.argsort(-count, kind="stable")
    count, first = count[order], first[order]
    forward, backward = np.empty_like(local), np.zeros_like(local)
    steps = int(count[0]) if len(count) else 0
    going = np.searchsorted(-count, -np.arange(1, steps + 1), "right")
    for t in range(steps):
        at = first[: going[t]] + t
        if t:
            forward[at] = local[at] + np.logaddexp.reduce(forward[at - 1][:, :, None] + chain.moves[None], axis=1)
        else:
            forward[at] = local[at]
    for t in range(steps - 2, -1, -1):
        at = first[: going[t + 1]] + t
        ahead = local[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp.reduce(chain.moves[None] + ahead[:, None, :], axis=2)
    whole = np.logaddexp.reduce(forward[first + count - 1], axis=1) if steps else np.zeros(0)
    of_line = np.empty(len(features))
    for_text = np.repeat(whole, count)
    lines = np.concatenate([np.arange(a, a + n) for a, n in zip(first.tolist(), count.tolist())]) if steps else np.zeros(0, int)
    of_line[lines] = for_text
    good = np.exp(forward[:, 1] + backward[:, 1] - of_line)
    inner = np.ones(len(features), bool)
    inner[first + count - 1] = False
    a = np.flatnonzero(inner)
    pairs = forward[a][:, :, None] + chain.moves[None] + (local[a + 1] + backward[a + 1])[:, None, :]
    expected = np.exp(pairs - of_line[a][:, None, None]).sum(0) if len(a) else np.zeros((2, 2))
    return good, expected, float(whole.sum())


def fit_chain(texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, ridge: float = RIDGE) -> Chain:
    """Gradient ascent (with step sizes adapted per weight) on the likelihood; a line has its document's label."""
    described = [Lines(piece) for piece in _text_pieces(texts)]
    features = np.concatenate([x.features for x in described])
    count = np.concatenate([x.count for x in described])
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    wanted = np.repeat(labels.astype(np.float64), count)
    total = len(wanted)
    chain = Chain(np.zeros(_WIDTH), np.zeros((2, 2)))
    inner = (count - 1).astype(np.float64)
    seen = np.diag([float(inner[labels == 0].sum()), float(inner[labels == 1].sum())])
    theta = np.zeros(_WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        chain = Chain(theta[:_WIDTH], theta[_WIDTH:].reshape(2, 2))
        good, expected, _ = marginals(chain, features, count, first)
        gradient = np.concatenate([features.T @ (wanted - good), (seen - expected).ravel()]) / total
        gradient -= ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Chain(theta[:_WIDTH], theta[_WIDTH:].reshape(2, 2))


def document_quality(chain: Chain, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(share of good bytes, lines)``; a text without bytes weighs its one empty line."""
    lines = Lines(texts)
    good, _, _ = marginals(chain, lines.features, lines.count, lines.first[:-1])
    weight = lines.size + (lines.size.sum() == 0)
    text_of = np.repeat(np.arange(len(texts)), lines.count)
    weight = np.where(np.bincount(text_of, lines.size, minlength=len(texts))[text_of] == 0, 1.0, weight)
    total = np.bincount(text_of, weight, minlength=len(texts))
    return np.bincount(text_of, good * weight, minlength=len(texts)) / total, lines.count


def _fitted(docs: DataFrame, labels: DataFrame, sample: int):
    """The chain and the calibration of its document scores."""
    marks = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .where(~held_out(F.col("doc_id")))
    )
    # The ids are drawn first, so only their texts are moved.
    drawn = hash_sample(marks, sample, "doc_id")
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    short = (F.size(F.split("text", "\n")) <= SAMPLE_LINES) & (F.char_length("text") <= SAMPLE_CHARACTERS)
    rows = texts.where(F.col("text").isNull() | short).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).collect()
    if not rows:
        return Chain(np.zeros(_WIDTH), np.zeros((2, 2))), fit_logistic(np.zeros((0, 1)), np.zeros(0))
    raw = [(r["text"] or "").encode() for r in rows]
    quality = np.array([r["quality"] for r in rows])
    chain = fit_chain(raw, quality)
    share = np.concatenate([document_quality(chain, piece)[0] for piece in _text_pieces(raw)])
    return chain, fit_logistic(_odds(share)[:, None], quality.astype(np.float64))


def _odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def _scores(chain: Chain, model: Logistic, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(score, share of good bytes, lines)`` of each text."""
    share, lines = document_quality(chain, texts)
    total = (_odds(share) - model.means[0]) / model.scales[0] * model.weights[0] + model.bias
    return 1 / (1 + np.exp(-np.clip(total, -30, 30))), share, lines


def score_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted, good_share, n_lines`` for each row of ``docs``.

    Fits on ``sample`` labelled documents, drawn by a hash of the id, of which one with more than
    ``SAMPLE_LINES`` lines or ``SAMPLE_CHARACTERS`` characters is passed over; held-out rows are never drawn. Ids with several labels count as
    the lowest. A null or empty text is one empty line. ``good_share`` is the marginals' mean weighted by
    bytes; ``score`` calibrates it. Without labels of both classes the score is the share of good ones,
    or a half. Equal rows score alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, sample))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, model = shared.value
        for batch in batches:
            for piece in pieces(batch, size=_PIECE_BYTES):
                score, share, lines = _scores(chain, model, text_bytes(piece.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(score), pa.array(share), pa.array(lines)],
                    ["doc_id", "score", "good_share", "n_lines"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        emit, f"doc_id {kind}, score double, good_share double, n_lines bigint"
    )
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "good_share",
        "n_lines",
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not called bad, with their columns, whatever their names; rows are judged where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, sample))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, model = shared.value
        for batch in batches:
            for piece in pieces(batch, size=_PIECE_BYTES):
                score, _, _ = _scores(chain, model, text_bytes(piece.column("text")))
                yield piece.filter(pa.array(score >= threshold))

    rows = packed(docs)
    return rows.mapInArrow(emit, rows.schema).select(*unpacked(docs, F.col("text")))
