"""Word evidence against plain counts, and the whole of a score against a plain version."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from estatelens.llm import toxicity
from estatelens.llm.words import ALNUM_BYTES, Words
from tests.llm import brute


def plain_evidence(rows):
    """``{word: ratio}`` over ``(text, toxic)``."""
    toxic, plain = Counter(), Counter()
    for text, label in rows:
        (toxic if label else plain).update(set(brute.alnum_words(text)))

    def discount(counts):
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        return once / (once + 2 * twice) if once else 0.5

    every = sum(toxic.values()) + sum(plain.values())
    found = {}
    for word, n in toxic.items():
        shared = (n + plain[word]) / every
        each = []
        for counts in (toxic, plain):
            total, d = sum(counts.values()), discount(counts)
            each.append(max(counts[word] - d, 0) / total + d * len(counts) / total * shared)
        ratio = math.log(each[0] / each[1])
        if n >= 2 and ratio > 1:
            found[word] = ratio
    return found


@pytest.fixture(scope="module")
def counted(small, labels):
    rows = small.join(labels, "doc_id").select("doc_id", "text", "toxic")
    extra = [(i, f"you are vile scum number {i}", 1) for i in range(9)] + [(i, f"a plain text of number {i}", 0) for i in range(9)]
    return rows.unionByName(small.sparkSession.createDataFrame([*extra, (90, None, 1), (91, "", 0)], "doc_id bigint, text string, toxic bigint"))


def test_evidence(counted):
    rows = [(r["text"], r["toxic"]) for r in counted.collect()]
    wanted = plain_evidence(rows)
    got = {r["word"]: r["ratio"] for r in toxicity.word_evidence(toxicity.word_counts(counted)).collect()}
    hashes = {w: int(Words([w.encode()], ALNUM_BYTES).hashes().view("int64")[0]) for w in wanted}
    assert set(got) == set(hashes.values()) and {"vile", "scum"} <= set(wanted)
    for word, ratio in wanted.items():
        assert got[hashes[word]] == pytest.approx(ratio)


def test_no_evidence_from_one_class(counted):
    for label in (0, 1):
        assert toxicity.word_evidence(toxicity.word_counts(counted.where(F.col("toxic") == label))).count() == 0


def test_word_features(counted, monkeypatch):
    """By the join, with a sieve that lets through nearly nothing, and one that lets through everything."""
    evidence = toxicity.word_evidence(toxicity.word_counts(counted)).checkpoint()
    plain = plain_evidence([(r["text"], r["toxic"]) for r in counted.collect()])
    spark = counted.sparkSession
    tables = toxicity.ratio_tables(toxicity.gram_counts(counted).checkpoint())
    right = toxicity._sieve(evidence)
    for bits in (right, right * 0 + 255):
        scored = toxicity.score_features(counted, tables, spark.sparkContext.broadcast(bits)).checkpoint()
        got = [tuple(r) for r in toxicity._with_words(scored, evidence).select("doc_id", *toxicity._WORDS).collect()]
        wanted = []
        for r in counted.collect():
            words = brute.alnum_words(r["text"])
            found = [plain[w] for w in set(words) if w in plain]
            root = math.sqrt(max(len(words), 1))
            strong, sure = (sum(x > k for x in found) for k in (2, 3))
            wanted.append((r["doc_id"], max(found, default=0), sum(found) / root, strong / root, sure, math.log1p(len(words))))
        for a, b in zip(sorted(got), sorted(wanted)):
            assert a == pytest.approx(b)


def test_plain_probabilities(counted):
    """Every gram's log ratio from counts of strings, level by level."""
    rows = [(r["text"], r["toxic"]) for r in counted.where("doc_id < 60").collect()]
    grams = {0: Counter(), 1: Counter()}
    for text, label in rows:
        line = "".join(" " + w for w in brute.alnum_words(text)).encode()
        padded = b"\0" * 4 + line
        grams[label].update(padded[i : i + 5] for i in range(len(line)))
    every = set(grams[0]) | set(grams[1])
    level = every
    ends = {}
    for n in (4, 3, 2, 1):
        ends[n] = Counter(g[-n:] for g in level)
        level = set(ends[n])

    def shared(tail):
        if not tail:
            return 1 / 256
        mates = [c for t, c in ends[len(tail)].items() if t[:-1] == tail[:-1]]
        below = shared(tail[1:])
        return (ends[len(tail)][tail] - 0.75 + 0.75 * len(mates) * below) / sum(mates)

    by_context = {}
    for label in (0, 1):
        for g, c in grams[label].items():
            total, freed = by_context.get((label, g[:4]), (0, 0))
            by_context[label, g[:4]] = total + c, freed + min(c, toxicity.DISCOUNT)

    def probability(label, g):
        total, freed = by_context.get((label, g[:4]), (0, 0))
        back = freed / total if total else 1.0
        return max(grams[label][g] - toxicity.DISCOUNT, 0) / max(total, 1) + back * shared(g[1:])

    found, _ = toxicity.log_ratios(toxicity.gram_counts(counted.where("doc_id < 60")))
    got = {r["gram"].to_bytes(5, "big"): r["ratio"] for r in found.collect()}
    assert set(got) == every
    for g in sorted(every)[:: max(1, len(every) // 400)]:
        assert got[g] == pytest.approx(math.log(probability(1, g) / probability(0, g)))
