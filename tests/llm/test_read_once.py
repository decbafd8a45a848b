"""The language model cuts texts into words once for counts and once for training and scoring; cheaper steps agree."""

from __future__ import annotations

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from estatelens.llm import gated_units, recurrent_lm


def test_texts_are_read_twice(spark, small):
    """For the counts of those that are learned from, and once more for all else."""
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    docs = small.select("doc_id", F.udf(counted, StringType()).asNondeterministic()("text").alias("text"))
    held = small.where(recurrent_lm.held_out(F.col("doc_id"))).count()
    found = recurrent_lm.score_documents(docs, network_words=50, class_words=8, rare_classes=6, width=6, rounds=2).collect()
    assert len(found) == small.count()
    # The counts may read held-out texts before they leave them out.
    assert seen.value <= 2 * len(found)
    assert seen.value >= 2 * len(found) - held


@pytest.mark.parametrize("known", [0, 1, 3000])
def test_known_words_are_found(known):
    """Also where hashes share their leading bits, and at both ends of them."""
    draw = np.random.default_rng(6)
    ends = np.array([0, 1, 2**64 - 2, 2**64 - 1], np.uint64)
    near = np.uint64(7 << 50) + np.arange(known // 2, dtype=np.uint64)
    far = draw.integers(0, 2**64, known // 2, np.uint64, endpoint=False)
    hashes = np.unique(np.concatenate([near, far, ends[1::2]])) if known > 1 else ends[2 : 2 + known]
    shape = gated_units.Shape(2, 2, 2, 2)
    nothing = np.zeros(0)
    vocabulary = recurrent_lm.Vocabulary(0, 0, 0, shape, hashes, nothing, nothing, nothing, nothing)
    asked = np.concatenate([hashes, hashes + np.uint64(1), ends, draw.integers(0, 2**64, 500, np.uint64, endpoint=False)])
    places = {h: i for i, h in enumerate(hashes.tolist())}
    assert vocabulary.find(asked).tolist() == [places.get(h, -1) for h in asked.tolist()]


@pytest.mark.parametrize("scale", [0.5, 20.0, 500.0])
def test_steps(scale):
    """Against sigmoids and tanh in doubles, also far out, without a warning from the scores."""
    draw, shape = np.random.default_rng(7), gated_units.Shape(9, 3, 3, 5)
    flat = (draw.normal(size=shape.size()) * scale).astype(np.float32)
    at, w = shape.views(flat.astype(np.float64)), shape.width
    read, state = draw.integers(0, 12, 40), draw.uniform(-1, 1, (40, w)).astype(np.float32)
    inward = at["embed"][read] @ at["inward"] + at["inward_bias"]
    pre = inward[:, : 2 * w] + state @ at["gates"]
    keep, reset = 0.5 + 0.5 * np.tanh(pre[:, :w] / 2), 0.5 + 0.5 * np.tanh(pre[:, w:] / 2)
    proposed = np.tanh(inward[:, 2 * w :] + (reset * state) @ at["recall"])
    units = gated_units._Recurrence.of(shape.views(flat))
    with np.errstate(over="ignore"):
        found = units.step(units.table.take(read, 1), state)
    for a, b in zip(found, (keep, reset, proposed, keep * state + (1 - keep) * proposed)):
        assert a == pytest.approx(b, abs=1e-5 * max(1, scale))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        logs = gated_units.log_likelihoods(shape, flat, read, np.array([30, 10]))
    assert np.isfinite(logs).all()


def test_rows_taken_at_once_do_not_matter(monkeypatch):
    draw, shape = np.random.default_rng(8), gated_units.Shape(9, 3, 3, 5)
    flat = gated_units.first_parameters(shape, np.ones(12)) * 3
    lengths = draw.integers(0, 60, 50)
    symbols = draw.integers(1, 12, lengths.sum())
    together = gated_units.log_likelihoods(shape, flat, symbols, lengths)
    monkeypatch.setattr(gated_units, "_STEP_ROWS", 7)
    assert gated_units.log_likelihoods(shape, flat, symbols, lengths) == pytest.approx(together, rel=1e-5)
