"""License scan by diagonal voting.

Every rolling word k-gram of every text is hashed and joined to the places of the same k-gram in the
license templates. A hit votes for a diagonal, its place in the text minus its place in the template.
Votes are counted by diagonal, neighbouring diagonals (words inserted or left out) are merged, weak
ones fall away, and the others are verified word by word against the text. The words that tell a license from
others have to be there, and of statements that share words only the best counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.words import ALNUM_BYTES, Words, gram_hashes, pieces, signed, text_bytes

#: Words of a k-gram; the shortest template has two.
GRAM_WORDS = 2

#: The share of a template's k-grams that has to vote, and of its words that has to be found.
VOTE_SHARE = 0.5
WORD_SHARE = 0.8

#: Templates are a parameter, a few hundred short texts; more words than this are not broadcast.
BROADCAST_WORDS = 200_000


class Template(NamedTuple):
    """``needs``: words of the text that a match must have. ``slack``: how many words may stand between; none for an
    exact phrase."""

    label: str
    text: str
    slack: int = 2
    base: bool = False
    needs: str = ""


#: The phrases of the contract.
BASE_TEMPLATES = (
    Template("cc-by", "cc by", slack=0, base=True),
    Template("gpl", "general public license", slack=0, base=True),
    Template("reserved", "all rights reserved", slack=0, base=True),
)

#: Statements by which the licenses themselves ask to be named, and what tells each from the others.
LICENSE_TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", needs="apache 2"),
    Template("mit", "released under the mit license", needs="mit license"),
    Template("mit", "licensed under the mit license", needs="mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        needs="permission granted copy",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        needs="redistribution source binary permitted",
    ),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", needs="gnu general public 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", needs="gnu general public 2"),
    Template("lgpl", "licensed under the gnu lesser general public license", needs="lesser general public"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", needs="mozilla 2"),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", needs="cc by nc sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", needs="cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", needs="cc by sa"),
    Template("cc-by-4.0", "licensed under cc by 4 0", needs="cc by 4"),
    Template("cc0", "to the extent possible under law waived all copyright and related rights", needs="waived copyright"),
    Template(
        "proprietary", "unauthorized copying of this file via any medium is strictly prohibited", needs="unauthorized copying prohibited"
    ),
)

TEMPLATES = BASE_TEMPLATES + LICENSE_TEMPLATES

_KEY = ["doc_id", "text_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def template_grams(docs: DataFrame, templates: tuple[Template, ...], k: int) -> DataFrame:
    """The places of each k-gram in the templates: ``template, place, gram``."""
    found = Words([t.text.encode() for t in templates], ALNUM_BYTES, lower=True)
    starts = found.gram_starts(k)
    owner = found.of_text()[starts]
    grams = gram_hashes(found.hashes(), starts, k).view(np.int64)
    rows = list(zip(owner.tolist(), (starts - found.first[owner]).tolist(), grams.tolist()))
    return docs.sparkSession.createDataFrame(rows, "template int, place int, gram bigint")


def text_grams(docs: DataFrame, k: int) -> DataFrame:
    """Every rolling k-gram of every text: ``doc_id, text_key, place, gram``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                starts = found.gram_starts(k)
                owner = found.of_text()[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(owner)),
                        piece.column("text_key").take(pa.array(owner)),
                        pa.array((starts - found.first[owner]).astype(np.int32)),
                        signed(gram_hashes(found.hashes(), starts, k)),
                    ],
                    ["doc_id", "text_key", "place", "gram"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(emit, f"doc_id {kind}, text_key bigint, place int, gram bigint")


def voted_spans(docs: DataFrame, templates: tuple[Template, ...], k: int, vote_share: float) -> DataFrame:
    """Merged diagonals with enough votes: ``doc_id, text_key, template, low, high``.

    Equal rows vote for the same places, so votes count distinct places: as bits, 64 places a part.
    """
    places = template_grams(docs, templates, k)
    words = sum(len(t.text.split()) for t in templates)
    if words <= BROADCAST_WORDS:
        places = F.broadcast(places)
    votes = (
        text_grams(docs, k)
        .withColumnRenamed("place", "at")
        .join(places, "gram")
        .groupBy(
            *_KEY,
            "template",
            (F.col("at") - F.col("place")).alias("diagonal"),
            F.floor(F.col("place") / 64).cast("int").alias("part"),
        )
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)).alias("hit"))
    )
    limits = [
        (i, t.slack, max(1, int(np.ceil((1.0 if t.base else vote_share) * (len(t.text.split()) - k + 1)))))
        for i, t in enumerate(templates)
    ]
    limits = docs.sparkSession.createDataFrame(limits, "template int, slack int, wanted int")
    along = Window.partitionBy(*_KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    merged = (
        votes.join(F.broadcast(limits), "template")
        .withColumn("opens", F.coalesce((apart > F.col("slack")).cast("int"), F.lit(1)))
        .withColumn("span", F.sum("opens").over(along))
        .groupBy(*_KEY, "template", "span", "part")
        .agg(
            F.min("diagonal").alias("low"),
            F.max("diagonal").alias("high"),
            F.bit_count(F.bit_or("hit")).alias("votes"),
            F.first("wanted").alias("wanted"),
        )
        .groupBy(*_KEY, "template", "span")
        .agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("votes").alias("votes"),
            F.first("wanted").alias("wanted"),
        )
    )
    return merged.where("votes >= wanted").select(*_KEY, "template", "low", "high")


_NEEDED = 1 << 20


def _aligned(window: list[bytes], template: list[bytes], weights: list[int]) -> tuple[int, int]:
    """The largest weight of template words found in order, and how many words of the window that takes."""
    best = [0] * (len(template) + 1)
    top, end = 0, 0
    for at, word in enumerate(window, 1):
        before = best[:]
        for i, wanted in enumerate(template, 1):
            hit = before[i - 1] + weights[i - 1] if word == wanted else 0
            best[i] = max(before[i], best[i - 1], hit)
        if best[-1] > top:
            top, end = best[-1], at
    return top, end


def _verified(words: list[bytes], template: list[bytes], needs: set[bytes], low: int, high: int, slack: int, share: float):
    """``(start, end, score)`` of the template near the diagonals, or nothing.

    A match spans no more words than the template and ``slack``; every needed word is in it. The score is the share
    of the template's words, over the span where that is longer: of equal scores the first.
    """
    if not slack:
        same = words[low : low + len(template)] == template
        return (low, low + len(template), 1.0) if same else None
    weights = [1 + _NEEDED * (w in needs) for w in template]
    wanted, known, found = sum(w in needs for w in template), set(template), None
    for start in range(max(0, low - slack), min(len(words), high + slack + 1)):
        if words[start] not in known:
            continue
        weight, length = _aligned(words[start : start + len(template) + slack], template, weights)
        if weight // _NEEDED < wanted or weight % _NEEDED < share * len(template):
            continue
        score = weight % _NEEDED / max(len(template), length)
        if found is None or score > found[2]:
            found = (start, start + length, score)
    return found


def _best(hits: set[tuple[int, int, float, str, bool]]) -> list[tuple[int, int, float, str, bool]]:
    """All exact phrases; of the others that overlap, the one with the best score, then the longest, first, by label."""
    kept = [h for h in hits if h[4]]
    taken: list[tuple[int, int]] = []
    for h in sorted((h for h in hits if not h[4]), key=lambda h: (-h[2], h[0] - h[1], h[0], h[3])):
        if all(h[1] <= a or b <= h[0] for a, b in taken):
            taken.append(h[:2])
            kept.append(h)
    return sorted(kept)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    k: int = GRAM_WORDS,
    vote_share: float = VOTE_SHARE,
    word_share: float = WORD_SHARE,
) -> DataFrame:
    """One row per row of ``docs`` with its license statements.

    Words are alphanumeric and in lower case; places count words from 0. ``spans`` lists
    ``(label, start, end, found, base)`` by start; ``found`` is the share of the template's words, less for words
    between them. Statements other than the base phrases do not overlap; of those that would, the best stays.
    A null or empty text has no words and no spans; equal rows give equal rows; a null ``doc_id`` is
    a key like any other; other columns of ``docs`` are not read. Templates need at least ``k`` words.
    """
    keyed = _keyed(docs)
    spans = voted_spans(keyed, templates, k, vote_share)
    kind = docs.schema["doc_id"].dataType.simpleString()
    per_text = spans.groupBy(*_KEY).agg(F.collect_list(F.struct("template", "low", "high")).alias("spans"))
    right = per_text.select(F.col("doc_id").alias("id_r"), F.col("text_key").alias("key_r"), "spans")
    joined = keyed.join(
        right, F.col("doc_id").eqNullSafe(F.col("id_r")) & (F.col("text_key") == F.col("key_r")), "left"
    ).select("doc_id", "text", "spans")
    wanted = [t.text.encode().split() for t in templates]
    needs = [set(t.needs.encode().split()) for t in templates]
    found_kind = pa.list_(
        pa.struct(
            [
                ("label", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("found", pa.float64()),
                ("base", pa.bool_()),
            ]
        )
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                out = []
                for i, candidates in enumerate(piece.column("spans").to_pylist()):
                    kept = set()
                    words = found.words(found.first[i], found.first[i + 1]) if candidates else []
                    for c in candidates or ():
                        t = templates[c["template"]]
                        i_t = c["template"]
                        hit = _verified(words, wanted[i_t], needs[i_t], c["low"], c["high"], t.slack, word_share)
                        if hit:
                            kept.add((*hit, t.label, t.base))
                    out.append(
                        [
                            {"label": x[3], "start": x[0], "end": x[1], "found": x[2], "base": x[4]}
                            for x in _best(kept)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(found.counts), pa.array(out, found_kind)],
                    ["doc_id", "n_words", "spans"],
                )

    return joined.mapInArrow(
        verify,
        f"doc_id {kind}, n_words bigint, "
        "spans array<struct<label:string,start:bigint,end:bigint,found:double,base:boolean>>",
    )
