"""The network learns from every token of every document that is not held out."""

from __future__ import annotations

import numpy as np
import pytest

from estatelens.llm import gated_units, queries, recurrent_lm
from tests.llm.conftest import SF


def test_all_tokens_train(spark, monkeypatch):
    """What the rounds read is the symbols that the counts are of, token by token."""
    kept, streams, train = {}, recurrent_lm._streams, recurrent_lm.trained_network

    def seen(docs, *rest):
        kept["streams"] = streams(docs, *rest).checkpoint()
        return kept["streams"]

    def remembered(learned, vocabulary, *rest):
        kept["vocabulary"] = vocabulary
        return train(learned, vocabulary, *rest)

    monkeypatch.setattr(recurrent_lm, "_streams", seen)
    monkeypatch.setattr(recurrent_lm, "trained_network", remembered)
    queries.op11_language_model(spark, SF)
    vocabulary, rows = kept["vocabulary"], kept["streams"].collect()
    symbols = np.concatenate([np.frombuffer(r["stream"], recurrent_lm.symbol_type(vocabulary.shape)) for r in rows])
    assert np.bincount(symbols, minlength=vocabulary.shape.symbols).tolist() == vocabulary.symbol_counts.tolist()
    assert {r["turn"] for r in rows} == set(range(recurrent_lm.ROUNDS))


def test_no_token_of_a_stream_is_left_out():
    """The last tokens count, also where the lanes do not divide the stream."""
    draw, shape = np.random.default_rng(4), gated_units.Shape(7, 3, 2, 4)
    flat = gated_units.first_parameters(shape, np.ones(9))
    stream = draw.integers(0, 9, 4 * 50 + 3)
    other = stream.copy()
    other[-1] = (stream[-1] + 1) % 9
    one, two = (gated_units.trained(shape, flat, s, 4, 10, 0.01, 5) for s in (stream, other))
    assert np.abs(one - two).max() > 1e-6


def test_places_without_a_token_add_nothing():
    draw, shape = np.random.default_rng(5), gated_units.Shape(7, 3, 2, 4)
    flat = (draw.normal(size=shape.size()) * 0.5).astype(np.float32)
    read, wanted = draw.integers(0, 9, (6, 2)), draw.integers(0, 9, (6, 2))
    state = draw.normal(size=(2, 4)).astype(np.float32)
    real = np.ones((6, 2))
    real[4:, 1] = 0
    loss, slope, _ = gated_units.gradients(shape, flat, read, wanted, state, real)
    a = gated_units.gradients(shape, flat, read[:, :1], wanted[:, :1], state[:1])
    b = gated_units.gradients(shape, flat, read[:4, 1:], wanted[:4, 1:], state[1:])
    assert loss == pytest.approx((6 * a[0] + 4 * b[0]) / 10, rel=1e-5)
    assert slope == pytest.approx((6 * a[1] + 4 * b[1]) / 10, abs=1e-5)


def test_far_apart_logits():
    """Rows far below others keep their probabilities."""
    logits = np.array([[500.0, 499.0], [-500.0, -501.0], [0.0, -900.0]], np.float32)
    found, _ = gated_units._exponentials(logits, np.array([1, 1, 1]))
    assert found == pytest.approx([-1.3132617, -1.3132617, -900.0], rel=1e-5)
