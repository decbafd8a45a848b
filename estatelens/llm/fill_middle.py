"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together in another order.

Batches go through array operations alone: every text becomes a list of units, the lists are flattened
with the index of their text, each unit's ordinal says which part it belongs to, units are filtered by part,
the lists of a part are built again from the counts, and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.words import pieces

#: A unit is a word with the white space before it, or white space that no word follows.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
PLAIN_PERCENT = 50
SPM_PERCENT = 80

#: Ends each unit of a batch; no UTF-8 text holds this byte.
_END = b"\xff"
_DRAWS = ("h1", "h2", "h3", "h4")


def _large(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


def _modulo(values: pa.Array, by: pa.Array | pa.Scalar) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, by), by))


def _part(units: pa.Array, parents: pa.Array, wanted: pa.Array, texts: int) -> pa.Array:
    """The wanted units of each text, joined. Units stay in order, so a text's part is a run of them."""
    counts = np.bincount(pc.filter(parents, wanted).to_numpy(), minlength=texts)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pc.filter(units, wanted))
    return pc.binary_join(lists, _large(b""))


def cut_and_joined(batch: pa.RecordBatch, plain_percent: int, spm_percent: int) -> pa.RecordBatch:
    """``n, form, prefix_chars, middle_chars, output`` for a batch with ``text`` and the four draws."""
    text = pc.fill_null(batch.column("text").cast(pa.large_binary()), _large(b""))
    ended = pc.replace_substring_regex(text, pattern=f"({UNIT})", replacement=rb"\1" + _END)
    lists = pc.split_pattern(ended, _END)
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), pa.scalar(1, pa.int64()))
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = np.concatenate([[0], np.cumsum(n.to_numpy() + 1)])[:-1]
    ordinals = pc.subtract(pa.array(np.arange(len(units))), pc.take(pa.array(first), parents))

    h1, h2, h3, h4 = (batch.column(h).cast(pa.int64()) for h in _DRAWS)
    places = pc.add(n, pa.scalar(1, pa.int64()))
    a, b = _modulo(h1, places), _modulo(h2, places)
    low, high = (pc.take(f(a, b), parents) for f in (pc.min_element_wise, pc.max_element_wise))
    in_prefix, in_suffix = pc.less(ordinals, low), pc.greater_equal(ordinals, high)
    # The empty end of each list falls into the suffix.
    in_middle = pc.and_(pc.invert(in_prefix), pc.invert(in_suffix))
    prefix, middle, suffix = (_part(units, parents, x, len(text)) for x in (in_prefix, in_middle, in_suffix))

    marked = [pc.match_substring(text, m) for m in (PREFIX, SUFFIX, MIDDLE)]
    unfit = pc.or_(pc.or_(marked[0], marked[1]), pc.or_(marked[2], pc.equal(n, pa.scalar(0, pa.int64()))))
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(unfit, pc.greater_equal(_modulo(h3, hundred), pa.scalar(plain_percent, pa.int64())))
    spm = pc.less(_modulo(h4, hundred), pa.scalar(spm_percent, pa.int64()))
    p, s, m = (_large(x.encode()) for x in (PREFIX, SUFFIX, MIDDLE))
    none = _large(b"")
    suffix_first = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    prefix_first = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    output = pc.if_else(plain, text, pc.if_else(spm, suffix_first, prefix_first))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    unknown = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, unknown, pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64())) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), n, form, *chars, output.cast(pa.large_string()).cast(pa.string())],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row of ``docs``.

    ``n`` counts units. Where a text is cut, and in which form it is put together, are draws from the
    SHA-256 of seed and id: ``plain`` (as it was), ``psm`` or ``spm`` with marks before the parts. A text
    that is empty, or holds a mark already, stays plain; then both counts of characters are null.

    A null text is empty; a null id draws as an empty one, so all rows without ids draw alike, as equal
    rows do. There are no ties. Columns other than ``doc_id`` and ``text`` are not read, whatever their names.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(h) for i, h in enumerate(_DRAWS)]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield cut_and_joined(piece, plain_percent, spm_percent)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *groups).mapInArrow(
        transform, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text before ``fill_in_middle``, from its output and form alone.

    No text in another form than plain holds a mark, and no two marks overlap, so the first of each is the cut.
    """

    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.split(F.substr(output, F.lit(len(first) + 1)), second, 2)
        rest = F.split(F.get(head, F.lit(1)), MIDDLE, 2)
        return F.get(head, F.lit(0)), F.get(rest, F.lit(0)), F.get(rest, F.lit(1))

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    late_suffix, late_prefix, late_middle = between(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(output)
    )
