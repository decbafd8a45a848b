"""Held-out accuracy of the learned operators, their defined results at the edges, and the pipeline."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from estatelens.llm import language, line_crf, queries, toxicity
from estatelens.llm.boosting import fit_boosted
from estatelens.llm.logistic import fit_logistic
from tests.llm import brute

LARGER = "/root/testdata/sf0.1"


def test_toxicity_held_out(spark):
    found = queries.op2_toxicity(spark, LARGER)
    marks = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(marks, "doc_id").where("held_out").select("predicted", "toxic").toPandas()
    hits = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert hits >= 0.9 * rows.toxic.sum() and hits >= 0.9 * rows.predicted.sum()


def test_quality_held_out(spark):
    found = queries.op10_line_quality(spark, LARGER)
    marks = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "quality")
    rows = found.join(marks, "doc_id").where("held_out").select("predicted", "quality").toPandas()
    assert (rows.predicted == rows.quality).mean() >= 0.97


def test_language_held_out(spark):
    found = queries.op4_language(spark, LARGER)
    langs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(langs, "doc_id").where("held_out").select("lang_pred", "lang").toPandas()
    assert (rows.lang_pred == rows.lang).mean() >= 0.97


def test_edges(edge, nothing, labels):
    for docs in (edge, nothing):
        n = docs.count()
        for found in (toxicity.score_toxicity(docs, labels), line_crf.score_quality(docs, labels)):
            rows = found.collect()
            assert len(rows) == n
            assert all(0 <= r["score"] <= 1 and r["held_out"] == brute.held_out(r["doc_id"]) for r in rows)
        rows = language.identify_language(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
        for r in rows:
            assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or "")))


def test_nothing_to_learn_from(edge, labels, spark):
    none = labels.where("false")
    assert {r["score"] for r in toxicity.score_toxicity(edge, none).collect()} == {0.5}
    assert {r["score"] for r in line_crf.score_quality(edge, none).collect()} == {0.5}
    unknown = language.identify_language(edge.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}


def test_gram_counts(spark):
    rows = spark.createDataFrame([("Ab, ab!", 1), ("ab", 0), (None, 0)], "text string, toxic int")
    got = {r["gram"].to_bytes(5, "big").lstrip(b"\0"): (r["n_toxic"], r["n_plain"]) for r in toxicity.gram_counts(rows).collect()}
    assert got == {b" ": (1, 1), b" a": (1, 1), b" ab": (1, 1), b" ab ": (1, 0), b" ab a": (1, 0), b"ab ab": (1, 0)}


def test_backoff_sums_to_one(spark, small):
    grams = toxicity.gram_counts(small.select("text", F.lit(0).alias("toxic")))
    shared = toxicity._shared_backoff(grams)
    seen = shared.groupBy(F.shiftright("tail", 8).alias("head")).agg(F.sum("shared").alias("s"))
    low, high = seen.agg(F.min("s"), F.max("s")).first()
    assert 0 < low and high <= 1 + 1e-9


def test_marginals_by_enumeration():
    from itertools import product

    draw = np.random.default_rng(3)
    features, chain = draw.normal(size=(4, 3)), line_crf.Chain(draw.normal(size=3), draw.normal(size=(2, 2)))
    good, expected, total = line_crf.marginals(chain, features, np.array([4]), np.array([0]))
    half, weights = features @ chain.weights / 2, {}
    for labels in product((0, 1), repeat=4):
        score = sum(half[i] if x else -half[i] for i, x in enumerate(labels))
        weights[labels] = np.exp(score + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:])))
    whole = sum(weights.values())
    assert total == pytest.approx(np.log(whole))
    assert good == pytest.approx([sum(w for x, w in weights.items() if x[i]) / whole for i in range(4)])
    assert expected.sum() == pytest.approx(3)


def test_boosting_and_logistic():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 5, (500, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 1)).astype(float)
    assert ((fit_boosted(x, y).scores(x) > 0.5) == y).mean() > 0.97
    assert fit_logistic(x, (x[:, 0] > 2).astype(float)).weights[0] > 1
    assert fit_logistic(np.zeros((0, 1)), np.zeros(0)).bias == 0


def test_pipeline(spark):
    """Each stage's decisions, from the operators' own rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    folder = "/root/testdata/sf0.01"
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_dedup", "benchmark_decontamination", "personal_data", "source_mix"
    ]
    (_, good), (_, dedup), (_, clean), (_, redact), (_, mix) = corpus_pipeline.STAGES
    kept = good(spark, docs, folder).checkpoint()
    scores = queries.op10_line_quality(spark, folder).where("predicted = 1").select("doc_id")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in scores.collect())
    single = dedup(spark, kept, folder).checkpoint()
    pairs = [(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()]
    assert {r["doc_id"] for r in single.collect()} == {c for _, _, c in brute.near_duplicates(pairs)}
    left = clean(spark, single, folder).checkpoint()
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    pairs = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert {r["doc_id"] for r in left.collect()} == {x[0] for x in brute.contamination(pairs, bench) if not x[-1]}
    hidden = redact(spark, left, folder).checkpoint()
    assert hidden.columns == docs.columns and hidden.count() == left.count()
    assert not any(sum(brute.personal(r["text"])[0].values()) for r in hidden.select("text").collect())
    mixed = mix(spark, hidden, folder)
    assert mixed.count() == corpus_pipeline.run(spark, folder).count() > 0
