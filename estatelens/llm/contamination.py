"""Benchmark decontamination with a broadcast hash set of test n-grams.

Windows of normalised benchmark words are hashed into a set that every task gets; training texts are
scanned window by window, hits are verified word by word, and spans or documents go.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.words import ALNUM_BYTES, Words, gram_hashes, packed, pieces, text_bytes, unpacked

WINDOW_WORDS = 10

#: Windows in one broadcast set. A larger benchmark is scanned for in several sets, one after another.
SET_WINDOWS = 1_000_000

#: A table of bits in front of the set.
_FILTER_BITS = 22

_KEY = ["doc_id", "text_key"]


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``window, length, item_id`` of every window of consecutive words; a shorter item is one window."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                ids = piece.column("item_id").to_pylist()
                windows, lengths, items = [], [], []
                for i, item in enumerate(ids):
                    words = found.words(found.first[i], found.first[i + 1])
                    length = min(size, len(words))
                    for at in range(len(words) - length + 1 if length else 0):
                        windows.append(b" ".join(words[at : at + length]))
                        lengths.append(length)
                        items.append(item)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(windows, pa.binary()), pa.array(lengths, pa.int32()), pa.array(items, pa.string())],
                    ["window", "length", "item_id"],
                )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return rows.mapInArrow(emit, "window binary, length int, item_id string").distinct()


class WindowSet:
    """Windows by hash, for one broadcast."""

    def __init__(self, rows: list):
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for row in rows:
            # A window of an item without an id is known, and names none.
            named = self.items[bytes(row["window"])]
            if row["item_id"] is not None:
                named.append(row["item_id"])
        self.filters: dict[int, np.ndarray] = {}
        self.hashes: dict[int, np.ndarray] = {}
        by_length = defaultdict(list)
        for window in self.items:
            by_length[window.count(b" ") + 1].append(window)
        for length, windows in by_length.items():
            found = Words(windows, ALNUM_BYTES)
            grams = np.unique(gram_hashes(found.hashes(), found.first[:-1], length))
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[grams & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.filters[length], self.hashes[length] = bits, grams

    def hits(self, found: Words) -> list[tuple[int, int, bytes]]:
        """``(first word, length, window)`` of verified occurrences."""
        out = []
        if not self.hashes or not len(found):
            return out
        hashes = found.hashes()
        for length, known in self.hashes.items():
            starts = found.gram_starts(length)
            grams = gram_hashes(hashes, starts, length)
            near = self.filters[length][grams & np.uint64((1 << _FILTER_BITS) - 1)]
            starts, grams = starts[near], grams[near]
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            for start in starts[known[at] == grams].tolist():
                window = b" ".join(found.words(start, start + length))
                if window in self.items:
                    out.append((start, length, window))
        return out


def _scan(docs: DataFrame, windows: WindowSet) -> DataFrame:
    """``doc_id, text_key, n_words, hits, items`` with ``hits`` as merged ``(first, last)`` words."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                hits: list[list[tuple[int, int]]] = [[] for _ in range(piece.num_rows)]
                items: list[set[str]] = [set() for _ in range(piece.num_rows)]
                for start, length, window in sorted(shared.value.hits(found), key=lambda x: x[0]):
                    i = int(np.searchsorted(found.first, start, "right")) - 1
                    items[i].update(shared.value.items[window])
                    a, b = start - int(found.first[i]), start - int(found.first[i]) + length - 1
                    if hits[i] and a <= hits[i][-1][1] + 1:
                        hits[i][-1] = (hits[i][-1][0], max(b, hits[i][-1][1]))
                    else:
                        hits[i].append((a, b))
                ranges = [[{"first": a, "last": b} for a, b in x] for x in hits]
                kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_key"),
                        pa.array(found.counts),
                        pa.array(ranges, kind),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["doc_id", "text_key", "n_words", "hits", "items"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key bigint, n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(emit, schema)


def _without_hits(docs: DataFrame, windows: WindowSet) -> DataFrame:
    """The rows of ``docs`` that hold no window; rows are judged where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Words(text_bytes(piece.column("text")), ALNUM_BYTES, lower=True)
                hits = [start for start, _, _ in shared.value.hits(found)]
                clean = np.ones(piece.num_rows, bool)
                clean[np.searchsorted(found.first, hits, "right") - 1] = False
                yield piece.filter(pa.array(clean))

    rows = packed(docs)
    return rows.mapInArrow(emit, rows.schema).select(*unpacked(docs, F.col("text")))


def merged_ranges(ranges: Column) -> Column:
    """Sorted ranges without overlap."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (x["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1)
        longer = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last")
        )
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.sort_array(ranges), empty, add)


def scan_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, set_windows: int = SET_WINDOWS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_words, n_hit, hits, items``.

    ``hits`` are ranges of words (from 0, both ends included) inside any occurrence of a window; ``items``
    the benchmark items these windows come from, sorted as strings. Null and empty texts have no words.
    Items without words have no windows; those without an id have theirs, and are not in ``items``. A benchmark of more than ``set_windows`` windows is dealt
    by hash into several sets of at most about that size; each scans all of ``docs``, and what they find
    is joined by row. Equal rows give equal rows; other columns are not read.
    """
    windows = benchmark_windows(benchmark, size)
    total = windows.count()
    sets = -(-total // set_windows) if total > set_windows else 1
    if sets == 1:
        found = _scan(docs, WindowSet(windows.collect()))
    else:
        windows = windows.checkpoint()
        deal = F.pmod(F.xxhash64("window"), F.lit(sets))
        scans = [_scan(docs, WindowSet(windows.where(deal == i).collect())) for i in range(sets)]
        found = (
            reduce(DataFrame.unionByName, scans)
            .groupBy(*_KEY)
            .agg(
                F.first("n_words").alias("n_words"),
                F.flatten(F.collect_set("hits")).alias("hits"),
                F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                F.count("*").alias("seen"),
            )
            .withColumn("hits", merged_ranges(F.col("hits")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("seen") / sets).cast("int"))))
        )
    in_ranges = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)
    return found.select(*_KEY, "n_words", in_ranges.alias("n_hit"), "hits", "items")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, spans: bool = False, set_windows: int = SET_WINDOWS
) -> DataFrame:
    """``docs`` without documents that hold a benchmark window; with ``spans``, without the hit words.

    With ``spans`` each run of hit words goes, with what stands between them, and clean documents stay as
    they are. The columns are those of ``docs``; a row without text is clean. Where one set holds all windows,
    documents go where they are read; what several sets find is joined to the rows.
    """
    if not spans:
        windows = benchmark_windows(benchmark, size).limit(set_windows + 1).collect()
        if len(windows) <= set_windows:
            return _without_hits(docs, WindowSet(windows))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = scan_contamination(docs, benchmark, size, set_windows).where("n_hit > 0").select(*_KEY, "hits").distinct()
    found = found.select(F.col("doc_id").alias("id_r"), F.col("text_key").alias("key_r"), F.col("hits").alias("hits_r"))
    rows = packed(docs) if spans else docs
    same = rows["doc_id"].eqNullSafe(found["id_r"]) & (F.xxhash64(rows["text"]) == found["key_r"])
    if not spans:
        return rows.join(found, same, "left_anti").select(*columns)
    joined = rows.join(found, same, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, hits in enumerate(batch.column("hits_r").to_pylist()):
                if hits:
                    raw = texts[i].encode()
                    found = Words([raw], ALNUM_BYTES | _upper())
                    bounds = [(int(found.starts[h["first"]]), int(found.ends[h["last"]])) for h in hits]
                    kept, at = [], 0
                    for a, b in bounds:
                        kept.append(raw[at:a])
                        at = b
                    texts[i] = b"".join([*kept, raw[at:]]).decode()
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type)).drop_columns(["hits_r"])

    wanted = joined.select(*rows.columns, "hits_r")
    return wanted.mapInArrow(cut, rows.schema).select(*unpacked(docs, F.col("text")))


def _upper() -> np.ndarray:
    table = np.zeros(256, bool)
    table[0x41:0x5B] = True
    return table


def items_digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.sort_array(items)), 256)
