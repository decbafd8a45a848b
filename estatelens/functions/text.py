"""Text expressions with the source database's NULL and LIKE rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_text(*parts: Column | str) -> Column:
    """Concatenate columns and literal text, a NULL column counting as empty text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def contains_text(text: Column, pattern: Column) -> Column:
    """Case-insensitive ``text LIKE '%pattern%'``.

    ``%`` and ``_`` in the pattern stay wildcards; a backslash is an ordinary character. A pattern without
    wildcards is searched for as it is, without an expression compiled for it.
    """
    escaped = F.replace(F.upper(pattern), F.lit("\\"), F.lit("\\\\"))
    like = F.call_function("like", F.upper(text), F.concat(F.lit("%"), escaped, F.lit("%")))
    return F.when(pattern.contains("%") | pattern.contains("_"), like).otherwise(F.upper(text).contains(F.upper(pattern)))


def lookup_type(column: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the keys of ``mapping`` by their values and keep every other value."""
    result = None
    for old, new in mapping.items():
        branch = (column == old, F.lit(new))
        result = F.when(*branch) if result is None else result.when(*branch)
    return column if result is None else result.otherwise(column)
