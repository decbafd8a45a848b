"""Importance resampling against the plain version, for single words and for longer runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from estatelens.llm import resampling
from tests.llm import brute
from tests.llm.conftest import SF, bag, pairs


@pytest.fixture(params=["edge", "small", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


@pytest.fixture
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.mark.parametrize("most_words", [1, 3])
def test_weights_and_ranks(docs, benchmark, most_words):
    found = resampling.importance_resample(docs, benchmark, most_words=most_words, least_words=5, percent=30)
    got = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    targets = [r["text"] for r in benchmark.select("text").collect()]
    assert bag(got) == bag(brute.resampling(pairs(docs), targets, most_words=most_words, least_words=5, percent=30))


def test_copies_without_ids(spark, benchmark):
    """A frequent line in every row, many equal rows without an id, in several partitions."""
    rows = [(None, "same line here\nof two lines")] * 700 + [(i, f"same line here\nand {i} more") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = resampling.importance_resample(docs, benchmark, least_words=1).select("doc_id", "n_features", "weight", "score", "rank")
    targets = [r["text"] for r in benchmark.select("text").collect()]
    assert bag(got.collect()) == bag(brute.resampling(rows, targets, least_words=1))


def test_no_target(docs, nothing):
    found = resampling.importance_resample(docs, nothing.select("text", "doc_id"))
    got = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert bag(got) == bag(brute.resampling(pairs(docs), []))


def test_drawn_rows_keep_their_columns(edge, benchmark):
    drawn = resampling.drawn_documents(edge, benchmark, least_words=3, percent=50)
    ids = {r["doc_id"] for r in resampling.importance_resample(edge, benchmark, least_words=3, percent=50).where("rank > 0").collect()}
    assert drawn.columns == edge.columns
    assert bag(drawn.collect()) == bag(r for r in edge.collect() if r["doc_id"] in ids - {None})


def test_ranges_have_no_gaps(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    got = resampling.ranked(rows, [F.col("a").desc(), F.col("b").asc()]).orderBy("rank").collect()
    wanted = sorted(((x % 7, x) for x in range(5000)), key=lambda r: (-r[0], r[1]))
    assert [(r["a"], r["b"], r["rank"]) for r in got] == [(*r, i) for i, r in enumerate(wanted, 1)]
