"""CSV rowsets: comma, quoted fields, one header line with upper-case names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


ROWS_PER_FILE = 1_000_000


def write_rowset(df: DataFrame, path: str) -> None:
    """Write ``df`` as a folder of CSV files; part order is row order for a sorted result.

    Blanks at the edges of a text are kept. A file is read back by one task, so its rows are bounded.
    """
    upper = df.toDF(*[c.upper() for c in df.columns])
    upper.write.option("maxRecordsPerFile", ROWS_PER_FILE).csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_rowset(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a rowset back under the lower-case names of ``schema``; empty text is NULL."""
    upper = StructType()
    for field in schema:
        upper.add(field.name.upper(), field.dataType, True)
    rows = spark.read.csv(path, schema=upper, header=True, escape='"', multiLine=True, enforceSchema=False)
    return rows.toDF(*[field.name for field in schema])
