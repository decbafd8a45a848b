"""The labels of the license scan: one license each, and all of them against the plain version."""

from __future__ import annotations

import random

import pytest

from estatelens.llm import licenses, queries
from tests.llm import brute
from tests.llm.conftest import SF, bag, pairs

STATEMENTS = {
    "Licensed under the GNU General Public License version 3.": "gpl,gpl-3.0",
    "licensed under the GNU General Public License, version 2 or later": "gpl,gpl-2.0",
    "Licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "released under the Apache license": "",
    "Released under the MIT license": "mit",
    "licensed under CC BY 4.0": "cc-by,cc-by-4.0",
    "licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
    "licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
    "licensed under CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa",
    "Licensed under a x under the y the mit z mit license": "",
    "licensed under the terms of the MIT license": "mit",
    "Released under the MIT license. Licensed under the Apache License, Version 2.0": "apache-2.0,mit",
    "licensed under the " * 300 + "moon": "",
    "licensed under the " * 300 + "mit license": "mit",
    "all rights reserved": "reserved",
    "": "",
}


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    found = licenses.scan_licenses(docs).collect()
    return {r["doc_id"]: ",".join(sorted({s["label"] for s in r["spans"]})) for r in found}


def test_statements(spark):
    got = labels(spark, STATEMENTS)
    assert {t: got[i] for i, t in enumerate(STATEMENTS)} == STATEMENTS


@pytest.mark.parametrize("rows", ["edge", "small", "nothing"])
def test_all_labels(spark, request, monkeypatch, rows):
    docs = request.getfixturevalue(rows)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.op1_license_scan(spark, SF).select("doc_id", "labels").collect()
    assert bag(got) == bag((i, brute.license_labels(t, licenses.TEMPLATES)) for i, t in pairs(docs))


def test_damaged_statements(spark):
    """Words left out, put in and repeated, statements side by side and in one another."""
    draw = random.Random(9)
    texts = []
    for _ in range(400):
        words = []
        for _ in range(draw.choice((1, 1, 2, 3))):
            words += draw.choice(licenses.TEMPLATES).text.split()
        for _ in range(draw.randrange(6)):
            at = draw.randrange(len(words) + 1)
            if draw.random() < 0.5:
                words.insert(at, draw.choice(("x", "the", "license", "under", "mit", "2", "3", "by")))
            else:
                words[at : at + draw.choice((1, 1, 2))] = []
        texts.append(" ".join(words))
    got = labels(spark, texts)
    assert {i: brute.license_labels(t, licenses.TEMPLATES) for i, t in enumerate(texts)} == got
