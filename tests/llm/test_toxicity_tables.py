"""Every gram is scored by its own log ratio, however many there are."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import toxicity

FEATURES = ["mean_ratio", "top_ratio", "toxic_share"]


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode())


def plain_grams(text):
    padded = bytes(4) + b"".join(b" " + w for w in plain_words(text))
    return [int.from_bytes(padded[i : i + 5], "big") for i in range(len(padded) - 4)]


def plain_features(text, seen, unseen):
    words = plain_words(text)
    ratios = [seen.get(g, unseen.get(g >> 8, 0.0)) for g in plain_grams(text)]
    of_word, at = [], 0
    for w in words:
        of_word.append(sum(ratios[at : at + len(w) + 1]))
        at += len(w) + 1
    return sum(ratios) / max(len(ratios), 1), max(of_word, default=0.0), sum(x >= 3 for x in of_word) / max(len(words), 1)


def test_more_grams_than_a_table_holds(spark):
    """Random words of 36 letters: some five million grams, against 2**22 slots that were averages once."""
    draw = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789 ", np.uint8)
    texts = [letters[draw.integers(0, len(letters), 20_000)].tobytes().decode() for _ in range(560)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(8)
    marks = spark.createDataFrame([(i, int(i % 40 == 0)) for i in range(len(texts))], "doc_id bigint, toxic int")
    docs = docs.unionByName(spark.createDataFrame([(10_000 + i, t[:500]) for i, t in enumerate(texts[:20])], docs.schema))
    found = {r["doc_id"]: [r[x] for x in FEATURES] for r in toxicity.score_toxicity(docs, marks).where("doc_id >= 10000").collect()}
    counted = docs.join(marks, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 < 2)
    grams = toxicity.gram_counts(counted).checkpoint()
    assert grams.count() > 1 << 22
    asked = {g for t in texts[:20] for g in plain_grams(t[:500])}
    wanted = spark.createDataFrame([(g,) for g in sorted(asked)], "gram bigint")
    seen, unseen = toxicity.log_ratios(grams)
    seen = {r["gram"]: r["ratio"] for r in seen.join(F.broadcast(wanted), "gram").collect()}
    contexts = wanted.select(F.shiftright("gram", 8).alias("context")).distinct()
    unseen = {r["context"]: r["ratio"] for r in unseen.join(F.broadcast(contexts), "context").collect()}
    for i in range(20):
        assert found[10_000 + i] == pytest.approx(plain_features(texts[i][:500], seen, unseen), abs=1e-4)


def test_any_number_of_tables(spark, small, labels):
    one = toxicity.score_toxicity(small, labels).select("doc_id", "score", *FEATURES).orderBy("doc_id").collect()
    many = toxicity.score_toxicity(small, labels, table_grams=3000).select("doc_id", "score", *FEATURES).orderBy("doc_id").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in many]


def test_table_finds_exact_keys():
    draw = np.random.default_rng(6)
    keys = np.unique(draw.integers(0, 1 << 40, 50_000).astype(np.uint64))
    table = toxicity.RatioTable(keys, keys.astype(np.float64) % 97)
    assert (table.find(keys) == keys.astype(np.float64) % 97).all()
    assert np.isnan(table.find(np.setdiff1d(keys + np.uint64(1), keys))).all()
    assert np.isnan(toxicity.RatioTable(keys[:0], np.zeros(0)).find(keys[:5])).all()
