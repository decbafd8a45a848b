"""Common words and references that come from the texts of each language."""

from __future__ import annotations

import math

import pytest

from estatelens.llm import distribution_rules as rules
from tests.llm.conftest import bag


@pytest.fixture(scope="module")
def invented(spark):
    """A language of its own with 30 texts, junk in it, one language with few texts, and texts without one."""
    plain = ["bo ra mi tel bo sun", "ra bo lup mi ko bo", "mi bo ra vin sa Bo"]
    rows = [(i, " ".join([plain[i % 3]] * 12), "qq") for i in range(30)]
    rows += [(100, "xq zz wv kk " * 20, "qq"), (101, None, "qq"), (102, "", "qq"), (103, "||| 77 " * 40, "qq")]
    rows += [(200 + i, "na ne no nu " * 20, "rr") for i in range(3)]
    rows += [(None, "bo ra mi " * 30, None), (300, "bo ra mi " * 30, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_common_words_are_those_of_most_texts(invented):
    lists = {r["language"]: r["listed"] for r in rules.common_words(invented, listed_words=3, least_texts=20).collect()}
    assert lists == {"qq": ["bo", "mi", "ra"]}
    # Three texts hold each word of the other one.
    few = {r["language"]: r["listed"] for r in rules.common_words(invented, listed_words=3, least_texts=3).collect()}
    assert few["rr"] == ["na", "ne", "no"]
    # No list is shorter than asked for.
    assert rules.common_words(invented, listed_words=9, least_texts=20).count() == 0


def test_counts_and_distances_by_hand(invented):
    listed = {"qq": ["bo", "mi", "ra"]}
    bins: dict[int, list[int]] = {}
    for i, r in enumerate(invented.collect()):
        words = (r["text"] or "").lower().split()
        found = [words.count(w) for w in listed.get(r["lang"], [])]
        bins[i] = [*found, len(words) - sum(found)]
    rows = invented.collect()

    def distance(i: int) -> float:
        group = [bins[k] for k, r in enumerate(rows) if (r["lang"] in listed and r["lang"]) == (rows[i]["lang"] in listed and rows[i]["lang"])]
        sums = [sum(x) for x in zip(*group)]
        p, q = ([v / (sum(x) or 1) for v in x] for x in (bins[i], sums))
        terms = [(a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)]
        return math.sqrt(max(0, sum(terms) / 2))

    got = rules.quality_rules(invented, listed_words=3, least_texts=20).select("doc_id", "n_words", "common_js").collect()
    wanted = [(r["doc_id"], sum(bins[i]), round(distance(i), 9)) for i, r in enumerate(rows)]
    assert bag((r[0], r[1], round(r[2], 9)) for r in got) == bag(wanted)


def test_junk_of_an_unlisted_language_goes(invented):
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(
        invented, listed_words=3, least_texts=20, common_distance=0.4
    ).collect() if not r["base_failed"]}
    far = {r["doc_id"] for r in rules.quality_rules(invented, listed_words=3, least_texts=20).where("common_js > 0.4").collect()}
    assert {100, 103} <= far and not far & set(range(30))
    assert all(kept.get(i, True) for i in range(30))


def test_shuffled_lists_give_the_same(invented, edge, nothing):
    for docs in (invented, edge, nothing):
        two = [
            bag(rules.quality_rules(docs, listed_words=2, least_texts=2, broadcast_languages=n).collect()) for n in (4096, 0)
        ]
        assert two[0] == two[1] and len(two[0]) == docs.count()


def test_list_length_is_bounded(invented):
    for size in (0, 63):
        with pytest.raises(ValueError):
            rules.quality_rules(invented, listed_words=size)
