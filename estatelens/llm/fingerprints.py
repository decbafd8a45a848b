"""SimHash near duplicates by pivot distance tables.

A fingerprint's Hamming distances to a set of reference fingerprints (pivots) are its coordinates. If
two fingerprints differ in ``r`` bits, no coordinate differs by more than ``r``; so pairs are discarded
by their largest coordinate difference before their bits are compared.

Which pairs are looked at all is decided without loss: cut into six blocks of bits, fingerprints with at
most three differing bits agree on three whole blocks, so each is filed under its twenty triples of
blocks. A file with very many different fingerprints is filed again by the bits it does not share; it
shares 48 then, so no file holds more than 2**16. A file gives links that span it, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.components import component_labels
from estatelens.llm.words import SPACED_BYTES, Words, pieces, signed, text_bytes

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 3
PIVOTS = 24
PIVOT_SEED = 20_011

#: A file with more fingerprints is filed again by more bits; results do not depend on it.
LARGE_FILE = 4_096

_BLOCKS = 6
_MATCHED = _BLOCKS - MAX_BITS

_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def _bits_set(values: np.ndarray) -> np.ndarray:
    parts = np.ascontiguousarray(values).view(np.uint16).reshape(*values.shape, 4)
    return _ONES[parts].sum(-1, dtype=np.int16)


def _fingerprint(normal: bytes, starts: list[int], ends: list[int], k: int) -> int:
    if not starts:
        return 0
    if len(starts) < k:
        hashes = [xxhash.xxh64_intdigest(normal[starts[0] : ends[-1]], HASH_SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(normal[a:b], HASH_SEED) for a, b in zip(starts, ends[k - 1 :])]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp``: the SimHash of each whole text's word shingles, as the 64 bits of a bigint."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = []
                for text in text_bytes(piece.column("text")):
                    normal = b" ".join(text.lower().split())
                    found = Words([normal], SPACED_BYTES)
                    out.append(_fingerprint(normal, found.starts.tolist(), found.ends.tolist(), k))
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c) for c in keys], signed(np.array(out, np.uint64))], [*keys, "fp"]
                )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keys]
    return docs.select(*keys, "text").mapInArrow(emit, ", ".join([*kinds, "fp bigint"]))


def _block_masks(bits: list[int], blocks: int) -> list[int]:
    """The bits dealt to blocks, as masks."""
    return [sum(1 << b for b in part) for part in np.array_split(np.array(bits, object), blocks)]


def _as_signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _filed_masks() -> list[int]:
    """The shared bits of each file: every choice of three of the six blocks."""
    blocks = _block_masks(list(range(64)), _BLOCKS)
    return [sum(chosen) for chosen in combinations(blocks, _MATCHED)]


def _refiled_masks(mask: int) -> list[int]:
    """For a file that shares ``mask``: every choice of three of six blocks of the other bits as well."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(chosen) for chosen in combinations(_block_masks(rest, _BLOCKS), _MATCHED)]


def _files(masks: list[int]) -> Column:
    """Explode to one row per mask: its place, and the fingerprint's bits under it."""
    def row(i: int, mask: int) -> Column:
        return F.struct(F.lit(i).alias("file"), F.col("fp").bitwiseAND(F.lit(_as_signed(mask))).alias("bits"))

    return F.inline(F.array(*[row(i, mask) for i, mask in enumerate(masks)]))


def pivot_fingerprints(pivots: int = PIVOTS, seed: int = PIVOT_SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, pivots, np.uint64) * np.uint64(2) + (
        np.arange(pivots, dtype=np.uint64) & np.uint64(1)
    )


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.stack([_bits_set(fps ^ p) for p in pivots], 1).astype(np.int8)


def spanning_links(fps: np.ndarray, pivots: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that join what is linked within one file, one fewer than each component's fingerprints.

    Fingerprints are sorted by the first coordinate, so each is compared with those at most ``most``
    further along it, in blocks.
    """
    table = pivot_table(fps, pivots)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + most, "right")
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    step = max(1, (1 << 20) // max(1, len(fps)))
    for low in range(0, len(fps), step):
        high = min(low + step, len(fps))
        stop = int(ends[high - 1])
        near = np.ones((high - low, stop - low), bool)
        for j in range(table.shape[1]):
            gap = table[low:high, j, None] - table[None, low:stop, j]
            near &= np.abs(gap) <= most
        left, right = np.nonzero(near)
        left, right = left[left < right] + low, right[left < right] + low
        close = _bits_set(fps[left] ^ fps[right]) <= most
        for a, b in zip(left[close].tolist(), right[close].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[rb] = ra
                links.append((a, b))
    return [(int(fps[a]), int(fps[b])) for a, b in links]


def _links_of_files(filed: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``src, dst`` from ``file, bits, fp``, where every file is small."""
    members = filed.groupBy("file", "bits").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for fps in batch.column("fps"):
                links += spanning_links(np.array(fps.values).astype(np.int64).view(np.uint64), pivots)
            if links:
                pairs = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    return members.select("fps").mapInArrow(emit, "src bigint, dst bigint")


def fingerprint_links(distinct: DataFrame, pivots: np.ndarray | None = None, large: int = LARGE_FILE) -> DataFrame:
    """``src, dst``: links that join all of ``fp`` (distinct) within three bits of each other."""
    pivots = pivot_fingerprints() if pivots is None else pivots
    masks = _filed_masks()
    filed = distinct.select("fp", _files(masks))
    sizes = filed.groupBy("file", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = filed.join(sizes, ["file", "bits"])
    small = _links_of_files(shared.where(F.col("n") <= large), pivots)
    crowded = shared.where(F.col("n") > large).select("file", "fp")
    whens = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for i, mask in enumerate(masks):
        further = [F.col("fp").bitwiseAND(F.lit(_as_signed(m))) for m in _refiled_masks(mask)]
        whens = whens.when(F.col("file") == i, F.array(*further))
    again = crowded.select("file", "fp", F.posexplode(whens).alias("second", "bits"))
    again = again.select((F.col("file") * 100 + F.col("second")).alias("file"), "bits", "fp")
    return small.unionByName(_links_of_files(again, pivots))


def _components(marked: DataFrame, member: Column) -> tuple[DataFrame, DataFrame]:
    """``fp, least, label`` of each fingerprint, ``least`` its smallest ``member``; and ``label, least`` of each component."""
    groups = marked.groupBy("fp").agg(F.min(member).alias("least"))
    links = fingerprint_links(groups.select("fp")).checkpoint()
    labels = component_labels(links)
    by_fp = groups.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    return by_fp, by_fp.groupBy("label").agg(F.min("least").alias("least"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id that links lead to, its own included.

    A null text is an empty one and has fingerprint zero. Rows with equal texts share a fingerprint and
    so a component. A null ``doc_id`` is never the smallest unless all are null. Fingerprints are written
    to the shared folder once; copies are one fingerprint from then on.
    """
    marked = fingerprints(docs, k).checkpoint()
    by_fp, least = _components(marked, F.col("doc_id"))
    wanted = by_fp.select("fp", "label").join(least, "label").select("fp", F.col("least").alias("component_id"))
    return marked.join(wanted, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row, that with the smallest id.

    Null ids come last. If several rows have that id, the one whose text has the smallest hash stays; of rows
    with equal ids and texts, the one whose other columns come first, maps by their JSON. Texts are shuffled once.
    The columns are those of ``docs``, whatever their names.
    """
    text_key = F.xxhash64("text").alias("text_key")
    marked = fingerprints(docs.select("doc_id", "text", text_key), k, ("doc_id", "text_key")).checkpoint()
    # A component's smallest member is a row's id and text, so rows need not be joined to their components.
    _, least = _components(marked, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    keys = ["no_id", "id", "text_key"]

    def keyed(rows: DataFrame, *more: Column) -> DataFrame:
        # Keys without nulls, so that the ranking and the join below need the same partitioning.
        key = (F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key"))
        return rows.select(*[c.alias(k) for k, c in zip(keys, key)], *more)

    kept = keyed(least.select("least.*"))
    others = [f for f in docs.schema if f.name not in ("doc_id", "text")]
    # Maps and the like have no order of their own; their text has.
    order = [F.col("rest").getField(f.name) for f in others]
    order = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for c, f in zip(order, others)]
    order = [c.asc_nulls_last() for c in order]
    rest = F.struct(*[F.col(f"`{f.name}`") for f in others], F.lit(0).alias("one")).alias("rest")
    rows = keyed(docs.select("doc_id", "text", text_key, rest), F.col("doc_id"), F.col("text"), F.col("rest"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)])))
    # Equal rows go before the shuffle, all but one of a task; then rows meet their component where they are.
    rows = rows.withColumn("place", first).where("place = 1").join(kept, keys, "left_semi")
    own = {"doc_id", "text"}
    return rows.select(*[F.col(c) if c in own else F.col("rest").getField(c).alias(c) for c in docs.columns])
