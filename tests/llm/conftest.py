from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

#: Null and empty texts, white space, repeated rows, null ids, long tokens, other scripts, near misses.
EDGE_TEXTS = [
    (1, "Licensed under CC BY 4.0. All rights reserved. all  RIGHTS-reserved"),
    (1, "Licensed under CC BY 4.0. All rights reserved. all  RIGHTS-reserved"),
    (2, None),
    (3, ""),
    (4, " \t\n\r\x0b\x0c "),
    (None, "GNU General Public License cc by cc by"),
    (None, None),
    (6, "a@b a@b.c_x@d.e mail x@y@z.com, 1.2.3.4.5.6.7.8 256.1.1.1 10.0.0.255 0000255.1.1.1"),
    (7, "+1 (386) 555-3733 4111 1111 1111 1111 4111-1111-1111-1112 +12 34567890123456789 4539578763621486"),
    (8, "token=secret: abcdefghijklmnop Password = 'abcdefghijkl' api_key:\"AAAAAAAAAAAA\" AKIAABCDEFGHIJKLMN AKIAKIAAKIA"),
    (9, "0123456789abcdef0 deadbeefdeadbee ABCDEF0123456789abcdef api-key=xxxxxxxxxxxxxxxx"),
    (10, "w " * 3000),
    (11, "1" * 5000 + " " + "x" * 20000 + "@" + " " + "1 " * 3000),
    (12, "一 二 三 четыре пять шесть 𝒳𝒴 é a@b.cd token=𝒳 token=abcdefghijklmnopq"),
    (13, "one two three four five six\none two three four five six\n\n \nseven"),
    (14, "the cat sat on the mat and the dog sat on the mat and the cat sat on the mat"),
    (15, "same line\nsame line\nsame line \n#*$%&|<>   x"),
    (16, "permission is hereby granted free of any charge to any person obtaining a copy of the software now"),
    (17, "one two three"),
    (18, "One TWO\tthree"),
    (19, "one two"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge texts, with columns whose names the operators might use themselves."""
    rows = [(i, t, None if n % 5 == 0 else ("en", "fr", "xx")[n % 3], f"s{n % 4}" if n % 7 else None, 5, "fp", 1.0) for n, (i, t) in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_words int, fp string, score double"
    ).repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)
