"""The recurrent language model: counts and scores against plain versions, gradients, held-out gain."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from estatelens.llm import gated_units, queries, recurrent_lm
from estatelens.llm.words import SPACED_BYTES, Words
from tests.llm import brute
from tests.llm.conftest import pairs


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    return [*brute.spaced_words((text or "").translate(brute.LOWER)), None]


@pytest.fixture(params=["edge", "small", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


def plain_scores(rows, vocabulary, flat, counts):
    """``base_score, score`` of each text, token by token, from exact counts and the network's arrays."""
    shape, at = vocabulary.shape, vocabulary.shape.views(flat.astype(np.float64))
    everything, distinct = sum(counts.values()), len(counts)

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def log_softmax(x):
        return x - np.log(np.exp(x).sum())

    out = []
    for _, text in rows:
        state, read, base, score = np.zeros(shape.width), gated_units.END, 0.0, 0.0
        for token in tokens(text):
            c = counts.get(token, 0)
            base += math.log10((c + 1) / (everything + distinct + 1))
            w = shape.width
            inward = at["embed"][read] @ at["inward"] + at["inward_bias"]
            keep = sigmoid(inward[:w] + (state @ at["gates"])[:w])
            reset = sigmoid(inward[w : 2 * w] + (state @ at["gates"])[w:])
            proposed = np.tanh(inward[2 * w :] + (reset * state) @ at["recall"])
            state = keep * state + (1 - keep) * proposed
            if token is None:
                read, kind = gated_units.END, None
            else:
                words = Words([token.encode()], SPACED_BYTES)
                place = vocabulary.find(words.hashes())[0]
                symbol = vocabulary.symbols[place] if place >= 0 else -1
                kind = int(recurrent_lm.endings(words, shape.rare)[0])
                read = int(symbol) if symbol >= 0 else shape.words + kind
            group = int(shape.class_of(np.array([read]))[0])
            score += log_softmax(state @ at["class_out"] + at["class_bias"])[group] / math.log(10)
            if read < shape.words:
                low = group * shape.class_words
                high = min(low + shape.class_words, shape.words)
                inside = at["word_out"][low:high] @ state + at["word_bias"][low:high]
                score += log_softmax(inside)[read - low] / math.log(10)
            else:
                score += math.log10(c + 1) - vocabulary.scale[kind]
        out.append((base, score))
    return out


@pytest.mark.parametrize("lookup", [1 << 17, 300])
def test_scores(docs, monkeypatch, lookup):
    """Against the plain version; with a small lookup, most words are met by the join."""
    kept = {}
    train = recurrent_lm.trained_network

    def remembered(learned, vocabulary, *rest):
        kept["vocabulary"] = vocabulary
        kept["flat"] = train(learned, vocabulary, *rest)
        return kept["flat"]

    monkeypatch.setattr(recurrent_lm, "trained_network", remembered)
    small = dict(network_words=50, class_words=8, rare_classes=6, width=6, one_of=2, rounds=2)
    rows = pairs(docs)
    got = recurrent_lm.score_documents(docs, lookup=lookup, **small).collect()
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    plain = plain_scores(rows, kept["vocabulary"], kept["flat"], counts)
    wanted = [
        (i, held(i), len(tokens(t)), sum(x in counts for x in tokens(t)), sum(counts.values()), *plain[k])
        for k, (i, t) in enumerate(rows)
    ]

    def in_order(found):
        return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[5], 4)))

    assert len(got) == len(wanted)
    for a, b in zip(in_order(map(tuple, got)), in_order(wanted)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-6)
        assert a[6] == pytest.approx(b[6], rel=1e-4, abs=1e-3)


def test_probabilities_sum_to_one(small):
    """Over classes, words of a class, and a rare class's words with one place for all unknown ones."""
    learned = small.limit(50)
    counts = recurrent_lm.token_counts(learned, 6).collect()
    vocabulary = recurrent_lm.known_words(recurrent_lm.token_counts(learned, 6), 40, 8, 6, 5, 1000)
    shape = vocabulary.shape
    flat = gated_units.first_parameters(shape, vocabulary.symbol_counts)
    states = np.random.default_rng(1).normal(size=(3, 5)).astype(np.float32)
    every = np.arange(shape.symbols)
    for state in states:
        logs = gated_units.next_log_probabilities(shape, shape.views(flat), np.tile(state, (len(every), 1)), every)
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    own = set(vocabulary.hashes[vocabulary.symbols >= 0].view(np.int64).tolist())
    for kind in range(6):
        inside = [r["n"] for r in counts if r["class"] == kind and r["word"] not in own]
        assert sum(n + 1 for n in inside) + 1 == pytest.approx(10 ** vocabulary.scale[kind])


def test_gradients():
    draw, shape = np.random.default_rng(2), gated_units.Shape(7, 3, 2, 4)
    flat = draw.normal(size=shape.size()) * 0.5
    read, wanted = draw.integers(0, 9, (6, 3)), draw.integers(0, 9, (6, 3))
    state = draw.normal(size=(3, 4)).astype(np.float32)

    def loss(x):
        return gated_units.gradients(shape, x.astype(np.float32), read, wanted, state)[0]

    slope = gated_units.gradients(shape, flat.astype(np.float32), read, wanted, state)[1]
    for i in range(shape.size()):
        step = np.zeros_like(flat)
        step[i] = 1e-3
        assert (loss(flat + step) - loss(flat - step)) / 2e-3 == pytest.approx(slope[i], abs=2e-3)


def test_state_goes_through_windows():
    """A long document scores alike whether outputs are taken at once or in many windows, alone or beside others."""
    draw, shape = np.random.default_rng(3), gated_units.Shape(9, 3, 3, 5)
    flat = gated_units.first_parameters(shape, np.ones(12)) * 3
    lengths = np.array([700, 1, 0, 40])
    symbols = draw.integers(1, 12, lengths.sum())
    together = gated_units.log_likelihoods(shape, flat, symbols, lengths)
    for rows in (1, 7):
        assert gated_units.log_likelihoods(shape, flat, symbols, lengths, rows) == pytest.approx(together, rel=1e-4)
    alone = [gated_units.log_likelihoods(shape, flat, s, np.array([len(s)]))[0] for s in np.split(symbols, np.cumsum(lengths)[:-1])]
    assert together == pytest.approx(np.array(alone), rel=1e-4)


def test_held_out_gain(spark):
    """Held-out documents are far likelier than by counts alone."""
    found = queries.op11_language_model(spark, "/root/testdata/sf0.1").where("held_out").toPandas()
    assert found.score.sum() / found.n_tokens.sum() >= found.base_score.sum() / found.n_tokens.sum() + 0.2
    assert (found.score > found.base_score).mean() >= 0.95
