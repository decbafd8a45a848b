"""N-grams are told apart exactly, also in long texts and in texts mixed with blocks of other letters."""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import functions as F

from estatelens.llm import language

LARGER = "/root/testdata/sf0.1"


def plain_ids(text):
    folded = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x61 and b < 0x7B or b >= 0x80 else 0x20 for b in text)
    while b"  " in folded:
        folded = folded.replace(b"  ", b" ")
    return {folded[i : i + n] for n in (1, 2, 3, 4) for i in range(len(folded) - n + 1)}


def test_grams_are_exact():
    draw = np.random.default_rng(1)
    for size in (0, 1, 3, 50, 40_000):
        text = draw.integers(0, 256, size).astype(np.uint8).tobytes()
        assert {int(x).to_bytes(4, "big").lstrip(b"\0") for x in language.gram_ids(text)} == plain_ids(text)


def test_kernel_and_weights():
    texts = [b"the cat sat", b"le chat dort", b"the dog", b""]
    marks = language.Landmarks([language.gram_ids(t) for t in texts])
    sets = [plain_ids(t) for t in texts]
    batch = [b"the cat", b"xyz", b"le dog", b""]
    alpha = np.arange(8.0).reshape(4, 2)
    together = language.regressions(marks.vocabulary, marks.weights(alpha), batch)
    for row, text in enumerate(batch):
        own = plain_ids(text)
        plain = [len(own & s) / max(1, len(own)) ** 0.5 / max(1, len(s)) ** 0.5 for s in sets]
        assert np.allclose(marks.kernel(language.gram_ids(text)), plain)
        assert np.allclose(together[row], plain @ alpha, atol=1e-5)


def test_long_and_mixed_texts(spark):
    """20 KB of base64 behind a text: 0.48 of the languages were found with 2**15 shared slots."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang")
    draw = np.random.default_rng(2)
    taken = docs.where("doc_id % 4 = 1 and lang is not null and length(text) > 100").orderBy(F.xxhash64("doc_id")).limit(200).collect()
    rows = []
    for i, r in enumerate(taken):
        block = base64.b64encode(draw.integers(0, 256, 15_000).astype(np.uint8).tobytes()).decode()
        rows.append((-3 * i - 1, f"{r['text']} {block}", None, r["lang"]))
    more = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, wanted string")
    found = language.identify_language(docs.unionByName(more.drop("wanted")))
    hits = found.join(more.select("doc_id", "wanted"), "doc_id").select((F.col("lang_pred") == F.col("wanted")).alias("hit")).collect()
    assert len(hits) == 200 and np.mean([r["hit"] for r in hits]) >= 0.88


def test_blocks_of_columns(monkeypatch):
    draw = np.random.default_rng(4)
    texts = [draw.integers(97, 123, n).astype(np.uint8).tobytes() for n in (500, 0, 3, 900)]
    marks = language.Landmarks([language.gram_ids(t) for t in texts])
    weights = draw.normal(size=(len(marks.vocabulary), 3)).astype(np.float32)
    whole = language.regressions(marks.vocabulary, weights, texts)
    monkeypatch.setattr(language, "_BLOCK", 7)
    assert np.allclose(language.regressions(marks.vocabulary, weights, texts), whole, atol=1e-4)


def test_sketch():
    ids = np.arange(1000, dtype=np.uint32)
    assert (language.sketched(ids, 1000) == ids).all()
    assert len(language.sketched(ids, 50)) == 50 and set(language.sketched(ids, 50)) <= set(language.sketched(ids, 60))


def test_rows_without_ids(spark):
    """They are learned from like others, and every language is."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.lit(None).cast("bigint"))
    found = language.identify_language(docs.select("doc_id", "text", "lang", F.lit(1).alias("draw"), F.lit(2).alias("n")))
    assert found.count() == docs.count()
    wanted = {r["lang"]: r["count"] for r in docs.where("text rlike '[A-Za-z]'").groupBy("lang").count().collect()}
    got = {r["lang_pred"]: r["count"] for r in found.groupBy("lang_pred").count().collect()}
    assert all(abs(got[lang] - n) <= 0.05 * n + 5 for lang, n in wanted.items() if lang)


def test_every_language_is_learned(spark):
    """More languages than sample texts, and a text that a language holds a thousand times."""
    rows = [(i, f"w{i % 40:02d}x", f"l{i % 40:02d}") for i in range(4000)] + [(None, "copy", "l00")] * 1000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language._sample(docs, 20).groupBy("lang").count().collect()
    assert len(sample) == 40 and {r["count"] for r in sample} == {1}


def test_whole_query(small):
    """Kernel, ridge regression and softmax over sets of n-grams."""
    sample = language._sample(small, 80).orderBy("draw", "lang", "key").collect()
    langs, sets = [r["lang"] for r in sample], [plain_ids(r["text"].encode()) for r in sample]
    chosen = language.chosen_landmarks(langs, 20)
    names = sorted(set(langs))

    def kernel(a, b):
        return len(a & b) / max(1, len(a)) ** 0.5 / max(1, len(b)) ** 0.5

    across = np.array([[kernel(a, sets[j]) for j in chosen] for a in sets])
    wanted = np.array([[1.0 if x == n else -1.0 for n in names] for x in langs])
    weight = np.array([len(langs) / len(names) / langs.count(x) for x in langs])[:, None]
    normal = (across * weight).T @ across + language.RIDGE * len(langs) * across[chosen] + 1e-6 * np.eye(len(chosen))
    alpha = np.linalg.solve(normal, (across * weight).T @ wanted)
    got = {r["doc_id"]: r for r in language.identify_language(small, 80, 20).collect()}
    for r in small.collect():
        own = plain_ids((r["text"] or "").encode())
        values = np.array([kernel(own, sets[j]) for j in chosen]) @ alpha
        odds = np.exp(4 * (values - values.max()))
        if language.has_letter(r["text"]):
            assert got[r["doc_id"]]["lang_pred"] == names[int(values.argmax())]
            assert abs(got[r["doc_id"]]["score"] - odds.max() / odds.sum()) < 1e-3
        else:
            assert got[r["doc_id"]]["lang_pred"] == "und"
