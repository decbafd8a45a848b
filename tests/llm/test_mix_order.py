"""The query's rows come from the range-sorted mix: places over the whole mix, in the order of its positions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from estatelens.llm import mixing


@pytest.fixture(params=["edge", "small", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_places_are_those_of_the_sorted_mix(docs):
    rows = mixing.mix_sources(docs).withColumn("hash", F.xxhash64("doc_id")).collect()
    mix = [
        (position, r["hash"], r["doc_id"] is not None, r["doc_id"] or 0, copy, place, r["size"])
        for r in rows
        for copy, (position, place) in enumerate(zip(r["positions"], r["places"], strict=True))
    ]
    assert sorted(x[5] for x in mix) == list(range(1, len(mix) + 1))
    by_place = sorted(mix, key=lambda x: x[5])
    assert [x[:5] for x in by_place] == sorted(x[:5] for x in mix)
    stream = mixing.mixed_documents(docs).select("doc_id", "mix_copy", "mix_position").collect()
    assert [(r["mix_position"], r["doc_id"], r["mix_copy"]) for r in stream] == [
        (x[0], x[3] if x[2] else None, x[4]) for x in by_place
    ]
    assert sum(r["taken"] for r in rows) == sum(x[6] for x in mix)


def test_rows_come_from_a_range_sort(spark, small, monkeypatch):
    """What the sorted mix does not hold is not taken."""
    real = mixing.ranked
    monkeypatch.setattr(mixing, "ranked", lambda rows, *rest: real(rows, *rest).where(F.col("place") <= 10))
    first = mixing.mix_sources(small)
    assert first.agg(F.sum("copies")).first()[0] == 10 and first.count() == small.count()
    assert sorted(p for r in first.select("places").collect() for p in r["places"]) == list(range(1, 11))
