"""Votes for templates of more than 64 places."""

from __future__ import annotations

from estatelens.llm import licenses

MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the software the software is "
    "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
    "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software"
)


def test_full_license_text(spark):
    words = MIT.split()
    assert len(words) - 1 > 128
    changed = words[:50] + ["really"] + words[50:120] + words[121:]
    texts = [f"x y {MIT} z", " ".join(changed), " ".join(words[: len(words) * 2 // 5]), "nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = licenses.scan_licenses(docs, (licenses.Template("mit", MIT), licenses.Template("short", " ".join(words[:90]), 0, True)))
    rows = {r["doc_id"]: [(s["label"], s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    n = len(words)
    assert rows[0] == [("short", 2, 92), ("mit", 2, 2 + n)]
    assert rows[1] == [("mit", 0, n)]
    assert rows[2] == [] and rows[3] == []
