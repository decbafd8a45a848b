"""JSON documents from rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Shape = Mapping[str, "Column | str | Shape"]


def nested(shape: Shape) -> Column:
    """A struct from a nested mapping of field names to columns, column names or mappings."""
    fields = []
    for name, item in shape.items():
        if isinstance(item, Mapping):
            column = nested(item)
        else:
            column = F.col(item) if isinstance(item, str) else item
        fields.append(column.alias(name))
    return F.struct(*fields)


def json_document(df: DataFrame, shape: Shape, by: Sequence[str] = (), name: str = "document") -> DataFrame:
    """One JSON text per row, NULL fields kept."""
    text = F.to_json(nested(shape), {"ignoreNullFields": "false"})
    return df.select(*by, text.alias(name))
