"""Small constant tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """Rows written in code as a local relation, whose size the optimizer knows; no rows are text."""
    arrays = [pa.array([row[i] for row in rows], None if rows else pa.string()) for i in range(len(columns))]
    return spark.createDataFrame(pa.table(dict(zip(columns, arrays))))
