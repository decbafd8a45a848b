"""Matches of regular expressions with their places, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``start`` and ``end`` count code points from 0, the end excluded.
SPAN = "struct<start:int,end:int,value:string>"
KIND_SPAN = "struct<start:int,rank:int,end:int,kind:string>"

#: Items appended one by one to the same array, as a power of two: an array is copied whenever it grows, so
#: long ones are put together from chunks.
CHUNK_BITS = 8


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    """A non-empty array in arrays of ``2**CHUNK_BITS``; appending item by item is done within one of them."""
    last = F.shiftright(F.size(items) - 1, CHUNK_BITS)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * (1 << CHUNK_BITS) + 1, 1 << CHUNK_BITS))


def _running(totals: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each number, from 0, those before it joined."""
    start = F.struct(F.lit(0).alias("so_far"), F.array().cast("array<int>").alias("before"))

    def add(done: Column, x: Column) -> Column:
        return F.struct(
            join(done["so_far"], x).alias("so_far"), F.concat(done["before"], F.array(done["so_far"])).alias("before")
        )

    return F.aggregate(totals, start, add)["before"]


def placed(text: Column, found: Column, pattern: str) -> Column:
    """The matches as an array of ``start, end, value``: lengths of what lies between them, added up."""
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        found,
        F.slice(gaps, 1, F.size(found)),
        lambda m, g: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"), m.alias("value")),
    )

    def add(done: Column, x: Column) -> Column:
        at = done["at"] + x["gap"]
        span = F.struct(at.alias("start"), (at + x["size"]).alias("end"), x["value"].alias("value"))
        return F.struct((at + x["size"]).alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def within(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), none.alias("spans")), add)["spans"]

    def along(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        return F.flatten(F.zip_with(chunks, _running(totals, lambda a, b: a + b), within))

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.size(found) > 0, _bound(_bound(pairs, _chunks), along)).otherwise(none)


def of_kind(spans: Column, kind: str, rank: int) -> Column:
    """Spans as ``start, rank, end, kind``, which is the order they are listed in."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    ).cast(f"array<{KIND_SPAN}>")


def listed(*spans: Column) -> Column:
    return F.sort_array(F.concat(*spans))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def without_overlap(spans: Column) -> Column:
    """Sorted spans as runs of ``start, end, kind`` that do not overlap; the first kind names a run."""
    kind = "struct<start:int,end:int,kind:string,opens:boolean,reach:int>"

    def add(done: Column, s: Column) -> Column:
        reach = F.greatest(done["reach"], s["end"])
        marked = F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            (s["start"] >= done["reach"]).alias("opens"),
            reach.alias("reach"),
        )
        return F.struct(reach.alias("reach"), F.concat(done["marked"], F.array(marked)).alias("marked"))

    def within(chunk: Column, reach: Column) -> Column:
        start = F.struct(reach.alias("reach"), F.array().cast(f"array<{kind}>").alias("marked"))
        return F.aggregate(chunk, start, add)["marked"]

    def mark(chunks: Column) -> Column:
        furthest = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda s: s["end"])))
        return F.flatten(F.zip_with(chunks, _running(furthest, F.greatest), within))

    def runs(marked: Column) -> Column:
        openers = F.filter(marked, lambda s: s["opens"])
        # A run reaches as far as the span before the next opener, the last one as far as any.
        closed = F.zip_with(
            marked,
            F.slice(marked, 2, F.size(marked)),
            lambda s, following: F.struct(s["reach"].alias("reach"), F.coalesce(following["opens"], F.lit(True)).alias("last")),
        )
        closers = F.filter(closed, lambda s: s["last"])
        return F.zip_with(
            openers,
            closers,
            lambda a, z: F.struct(a["start"].alias("start"), z["reach"].alias("end"), a["kind"].alias("kind")),
        )

    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return F.when(F.size(spans) > 0, _bound(_bound(_bound(spans, _chunks), mark), runs)).otherwise(none)


def replaced(text: Column, runs: Column) -> Column:
    """The text with each run replaced by its kind in square brackets."""

    def within(chunk: Column, begin: Column) -> Column:
        until = F.element_at(chunk, -1)["end"]

        def rewrite(part: Column) -> Column:
            def add(done: Column, r: Column) -> Column:
                kept = F.substring(part, done["at"] - begin + 1, r["start"] - done["at"])
                label = F.concat(F.lit("["), F.upper(r["kind"]), F.lit("]"))
                return F.struct(r["end"].alias("at"), F.concat(done["out"], kept, label).alias("out"))

            return F.aggregate(chunk, F.struct(begin.alias("at"), F.lit("").alias("out")), add)["out"]

        return _bound(F.substring(text, begin + 1, until - begin), rewrite)

    def along(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.element_at(c, -1)["end"])
        begins = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
        rest = F.substring(text, F.element_at(ends, -1) + 1, F.char_length(text))
        return F.concat(F.array_join(F.zip_with(chunks, begins, within), ""), rest)

    return F.when(F.size(runs) > 0, _bound(_bound(runs, _chunks), along)).otherwise(text)
